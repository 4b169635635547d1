"""Quality rules by robust multivariate outliers, in DataFrame expressions only.

Every document has counts over its whole text; those that pass the plain
rules are judged by a vector of transformed statistics.  Per (language,
source) a minimum-covariance-determinant (MCD) estimate is made from
several starts: medians with quartile deviations, and small subsets drawn by
hash.  Each start makes concentration steps (keep the ``SUBSET`` share with
the smallest distances, take its mean and covariance, repeat); the start
whose subset has the least determinant goes on until its determinant no
longer falls.  A document is rejected when its squared Mahalanobis distance
exceeds ``CUTOFF``.  ``GUARDS`` are deviations too small to matter: they keep
a statistic without spread in a group from rejecting the smallest departure.
Groups under ``MIN_GROUP`` documents have too few for a covariance and use
the estimate of their language, and these of all documents.

Each step is two aggregations of moments and quantile sketches over the
table of statistics (no text), so a source with a third of all rows is
summed where its rows lie.

Defined results: null and empty texts have no words and fail the plain
rules; null languages and sources are groups of their own; null ids, ties
and repeated rows are judged like others; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import space_words, write_scratch

#: Share of a group's documents in the MCD subset.
SUBSET = 0.75
#: Drawn starts beside the medians, and steps before the least determinant is chosen.
DRAWS = 4
FIRST_STEPS = 2
#: Further steps of the chosen start, at most.
LAST_STEPS = 6
#: Groups below this size use their language's estimate.
MIN_GROUP = 100
#: chi-square consistency of a 75 % subset in five dimensions.
CONSISTENCY = 1.41
#: Rejected above this squared distance.  Of labelled texts, bad ones start at 196; 99.6 % of good ones lie below.
CUTOFF = 45.0
#: Statistic -> deviation below which a spread counts as none.
GUARDS = {"f_words": 0.4, "f_length": 0.2, "f_symbols": 0.02, "f_dups": 0.1, "f_repeats": 0.1}
NAMES = list(GUARDS)
D = len(NAMES)
GROUP = ["lang", "source"]


# ------------------------------------------------------------------ counts
def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in ``words``."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def spots(s: Column) -> Column:
        same = F.transform(
            s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])
        )
        return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    # transform over a one-element array names an intermediate result once.
    sorted_ = F.transform(F.array(F.array_sort(placed)), spots)
    total = F.get(F.transform(sorted_, covered), F.lit(0))
    return F.when((n < 4) | (F.size(F.array_distinct(hashes)) == n - 2), F.lit(0)).otherwise(total)


def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns with n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*keep, text.alias("_t"), space_words(text).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = base.select(
        *keep, F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))[0].alias("_l"),
        repeated_words(F.col("_w")).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select(
        *keep, "n_words", "word_chars", "n_symbols", (F.col("_l.n") - F.col("_l.d")).cast("long").alias("n_dup_lines"),
        F.col("_l.n").alias("n_lines"), "n_repeat_words", failed.alias("base_failed"),
    )


def statistics(counts: DataFrame) -> DataFrame:
    """The transformed statistics of documents that pass the plain rules."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return counts.withColumns({
        "f_words": F.log(F.greatest(F.col("n_words"), F.lit(1)).cast("double")),
        "f_length": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
        "f_symbols": share("n_symbols", "word_chars"),
        "f_dups": share("n_dup_lines", "n_lines"),
        "f_repeats": share("n_repeat_words", "n_words"),
    })


# --------------------------------------------------------------------- MCD
def _cholesky(cov: dict[tuple[int, int], Column]) -> list[tuple[str, Column]]:
    """Named columns l_i_j of the factor, each in terms of the earlier ones."""
    out = []
    for i in range(D):
        for j in range(i + 1):
            rest = cov[i, j]
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            value = F.sqrt(F.greatest(rest, F.lit(GUARDS[NAMES[i]] ** 2 / 100))) if i == j else rest / F.col(f"l_{j}_{j}")
            out.append((f"l_{i}_{j}", value))
    return out


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and Cholesky factor of the (guarded) covariance per group."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(a).alias(f"m_{i}") for i, a in enumerate(NAMES)]
    aggs += [F.covar_pop(NAMES[i], NAMES[j]).alias(f"c_{i}_{j}") for i in range(D) for j in range(i + 1)]
    out = rows.groupBy(*keys).agg(*aggs)
    cov = {(i, j): F.coalesce(F.col(f"c_{i}_{j}"), F.lit(0.0)) * CONSISTENCY for i in range(D) for j in range(i + 1)}
    for i, a in enumerate(NAMES):
        cov[i, i] = F.greatest(cov[i, i], F.lit(GUARDS[a] ** 2))
    for name, value in _cholesky(cov):
        out = out.withColumn(name, value)
    return out.drop(*[f"c_{i}_{j}" for i in range(D) for j in range(i + 1)])


def _medians(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Start 0: medians and quartile deviations, without correlation."""
    q = [F.percentile_approx(a, [0.25, 0.5, 0.75], 1000).alias(f"q_{i}") for i, a in enumerate(NAMES)]
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *q)
    cols = [F.col(f"q_{i}")[1].alias(f"m_{i}") for i in range(D)]
    for i, a in enumerate(NAMES):
        for j in range(i):
            cols.append(F.lit(0.0).alias(f"l_{i}_{j}"))
        cols.append(F.greatest((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349, F.lit(GUARDS[a])).alias(f"l_{i}_{i}"))
    return out.where("n > 0").select(*keys, F.lit(0).alias("start"), "n", *cols)


def _drawn(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Starts 1 to ``DRAWS``: moments of D + 1 rows each, the least hashes of D + 1 parts of the group.

    Hashes are of the values, so a start does not depend on the layout."""
    draws = rows.withColumn("start", F.explode(F.sequence(F.lit(1), F.lit(DRAWS))))
    hash_ = F.xxhash64("start", *NAMES)
    one = draws.groupBy(*keys, "start", F.pmod(hash_, F.lit(D + 1)).alias("_part")).agg(
        F.min_by(F.struct(*NAMES), hash_).alias("_v")
    )
    return _moments(one.select(*keys, "start", "_v.*"), [*keys, "start"])


def _log_det() -> Column:
    """Logarithm of the determinant whose factor is in the columns."""
    return sum((F.log(f"l_{i}_{i}") for i in range(1, D)), F.log("l_0_0")) * 2


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i, a in enumerate(NAMES):
        v = F.col(a) - F.col(f"m_{i}")
        for j in range(i):
            v = v - F.col(f"l_{i}_{j}") * y[j]
        y.append(v / F.col(f"l_{i}_{i}"))
    total = y[0] * y[0]
    for v in y[1:]:
        total = total + v * v
    return total


def _with(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's model; null keys are groups.  AQE broadcasts the model by its size."""
    if not keys:
        return rows.crossJoin(F.broadcast(model))  # a row per start
    other = model.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(other, on).drop(*[f"_{k}" for k in keys])


def _concentrate(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """One step of every start: the moments of the ``SUBSET`` share nearest to it."""
    each = [*keys, "start"]
    far = _with(rows, model.drop("n"), keys).select(*each, *NAMES, _distance().alias("_d"))
    cut = far.groupBy(*each).agg(F.percentile_approx("_d", SUBSET, 1000).alias("_cut"))
    return _moments(_with(far, cut, each).where(F.col("_d") <= F.col("_cut")), each)


def mcd(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """MCD centre and factor per group of ``keys`` (all rows as one group if empty), with ``n``, ``start``, ``log_det``."""
    model = write_scratch(_medians(rows, keys).unionByName(_drawn(rows, keys)), f"{name}-starts")
    for step in range(FIRST_STEPS):
        model = write_scratch(_concentrate(rows, model, keys).withColumn("log_det", _log_det()), f"{name}-first{step}")
        model = model.drop("log_det") if step + 1 < FIRST_STEPS else model
    best = model.groupBy(*keys).agg(F.min_by(F.struct("*"), F.struct("log_det", "start")).alias("_b"))
    model = best.where("_b is not null").select("_b.*")
    for step in range(LAST_STEPS):
        new = _concentrate(rows, model.drop("log_det"), keys).withColumn("log_det", _log_det())
        before = model.select(*keys, "start", F.col("log_det").alias("_before"))
        new = write_scratch(_with(new, before, [*keys, "start"]), f"{name}-last{step}")
        model = new.drop("_before")
        if new.where("log_det < _before - 1e-6").isEmpty():
            break
    return model


def judge(docs: DataFrame, *keep: str) -> DataFrame:
    """Counts of every document with ``kept``; ``keep`` names further columns to carry."""
    columns = ["doc_id", *GROUP, *keep]
    rows = write_scratch(statistics(text_counts(docs, *columns)), "statistics")
    sound = rows.where(~F.col("base_failed"))
    fits = [F.col(f"m_{i}") for i in range(D)] + [F.col(f"l_{i}_{j}") for i in range(D) for j in range(i + 1)]
    names = [f"m_{i}" for i in range(D)] + [f"l_{i}_{j}" for i in range(D) for j in range(i + 1)]

    def packed(keys: list[str], name: str) -> DataFrame:
        model = mcd(sound.select(*keys, *NAMES), keys, name)
        # ``n`` counts the subset; a group qualifies by its own size.
        model = model.where(F.col("n") >= MIN_GROUP * SUBSET) if keys else model
        return model.select(*keys, F.struct(*[f.alias(c) for f, c in zip(fits, names)]).alias(f"fit_{name}"))

    def left(df: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
        other = model.withColumnsRenamed({k: f"_{k}" for k in keys})
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] or F.lit(True)
        return df.join(other if keys else F.broadcast(other), on, "left").drop(*[f"_{k}" for k in keys])

    out = left(rows, packed(GROUP, "group"), GROUP)
    out = left(out, packed(["lang"], "lang"), ["lang"])
    out = left(out, packed([], "all"), [])
    fit = F.coalesce("fit_group", "fit_lang", "fit_all")
    out = out.withColumn("fit", fit).select(*rows.columns, "fit.*").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return out.withColumn("kept", kept)
