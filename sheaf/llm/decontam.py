"""Benchmark decontamination over a distributed positional inverted index.

Test windows are ``width`` consecutive words of a benchmark item (an item
of fewer words is one window).  Corpus counts of the test terms drop the
windows with a term that never occurs and name each window's two rarest
terms.  Postings (document, position) of those terms are stored, shifted
by the term's offset in the window, and intersected: what is left are
starts at which both rare terms stand in place.  An exact check on the
document's words follows.  With ``slack`` the two lists meet within that
distance instead, and a proximity match needs ``near_terms`` of the
window's distinct terms inside the window widened by ``slack``.

Broadcast sides come from the benchmark, or are ids, and are checked
against ``BROADCAST_ROWS``; beyond it the same joins shuffle.

Defined results: null and empty texts have no words; null item ids match
but are not listed; repeated items count once per id; rows of a document
id with different texts are told apart by a hash of the text, equal rows
get equal results; empty tables give no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import ascii_lower, write_scratch

#: Rows of a benchmark table or of ids (about 100 bytes each) sent to every executor.
BROADCAST_ROWS = 500_000
#: Fixed value: what separates words, after A-Z are in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a written table), broadcast if its size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame, *keep: str) -> DataFrame:
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.hex(F.xxhash64("text")))
    return docs.select("doc_id", "text", key.alias("_key"), *keep)


def test_windows(benchmark: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """(wid, win, n) distinct windows, and (wid, item_id) of the items that have them."""
    words = benchmark.select("item_id", word_list(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(width - 1), F.lit(1)))
    each = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("win")).distinct()
    each = write_scratch(each, "item-windows")
    windows = write_scratch(
        each.select("win").distinct().select(F.monotonically_increasing_id().alias("wid"), "win", F.size("win").alias("n")),
        "windows",
    )
    items = each.where("item_id is not null").join(windows, "win").select("wid", F.col("item_id").cast("string").alias("item_id")).distinct()
    return windows, write_scratch(items, "window-items")


test_windows.__test__ = False  # not a test of pytest's


def _rarest(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(wid, n, t1, o1, t2, o2): the rarest terms of windows all of whose terms occur."""
    terms = windows.select("wid", "n", F.posexplode("win").alias("off", "term"))
    vocabulary = _small(write_scratch(terms.select("term").distinct(), "terms"))
    counts = (
        docs.select(F.explode(word_list(F.col("text"))).alias("term")).join(vocabulary, "term", "left_semi")
        .groupBy("term").agg(F.count(F.lit(1)).alias("c"))
    )
    counts = write_scratch(counts, "term-counts")
    ranked = terms.join(counts, "term").groupBy("wid", "n").agg(
        F.array_sort(F.collect_list(F.struct("c", "off", "term"))).alias("r")
    )
    ranked = ranked.where(F.size("r") == F.col("n"))
    second = F.get(F.col("r"), F.lit(1))
    return write_scratch(
        ranked.select("wid", "n", F.col("r")[0]["term"].alias("t1"), F.col("r")[0]["off"].alias("o1"),
                      second["term"].alias("t2"), second["off"].alias("o2")),
        "rarest",
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (term, _key, pos, n_words) of ``terms`` (column term)."""
    vocabulary = _small(write_scratch(terms.select("term").where("term is not null").distinct(), "index-terms"))
    words = docs.select("_key", word_list(F.col("text")).alias("w"))
    each = words.select("_key", F.size("w").alias("n_words"), F.posexplode("w").alias("pos", "term"))
    return write_scratch(each.join(vocabulary, "term", "left_semi"), "postings")


def _shifted(index: DataFrame, rarest: DataFrame, term: str, off: str) -> DataFrame:
    """Window starts that one term's postings allow."""
    side = _small(write_scratch(rarest.where(F.col(term).isNotNull()).select("wid", "n", F.col(term).alias("term"), F.col(off).alias("off")), "side"))
    start = F.col("pos") - F.col("off")
    return index.join(side, "term").select("wid", "n", "_key", start.alias("start"), "n_words")


def find_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = 0, near_terms: int = 8) -> tuple[DataFrame, DataFrame]:
    """((_key, wid, start, n, kind), (wid, item_id)); kind is ``phrase`` or, with ``slack``, ``proximity``."""
    docs = _keyed(docs)
    windows, items = test_windows(benchmark, width)
    rarest = _rarest(docs, windows)
    index = build_index(docs, rarest.select(F.explode(F.array("t1", "t2")).alias("term")))
    first = _shifted(index, rarest, "t1", "o1")
    second = _shifted(index, rarest, "t2", "o2").select("wid", "_key", F.col("start").alias("start2")).distinct()
    single = first.where("n = 1").select("wid", "n", "_key", "start")
    if slack:
        gap = F.abs(F.col("start") - F.col("start2")) <= slack
        both = first.join(second, ["wid", "_key"]).where(gap)
    else:
        inside = first.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
        both = inside.join(second.withColumnRenamed("start2", "start"), ["wid", "_key", "start"])
    found = both.select("wid", "n", "_key", "start").distinct().unionByName(single.distinct())
    per_doc = write_scratch(
        found.join(_small(windows.select("wid", "win")), "wid")
        .groupBy("_key").agg(F.collect_list(F.struct("wid", "start", "n", F.array_join("win", " ").alias("phrase"))).alias("at")),
        "candidates",
    )
    ids = _small(per_doc.select("_key"))
    words = docs.join(ids, "_key", "left_semi").select("_key", word_list(F.col("text")).alias("w")).dropDuplicates(["_key"])
    met = words.join(per_doc, "_key").select("_key", "w", F.explode("at").alias("m")).select("_key", "w", "m.*")
    here = F.array_join(F.slice("w", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n")), " ")
    exact = (F.col("start") >= 0) & (here == F.col("phrase"))
    kind = F.when(exact, "phrase")
    if slack:
        lo = F.greatest(F.col("start") - slack, F.lit(0))
        around = F.slice("w", lo + 1, F.col("start") + F.col("n") + slack - lo)
        terms = F.array_distinct(F.split("phrase", " "))
        close = F.size(F.array_intersect(around, terms)) >= F.least(F.lit(near_terms), F.size(terms))
        kind = kind.when(close, "proximity")
    out = met.select("_key", "wid", "start", "n", kind.alias("kind")).where("kind is not null")
    return write_scratch(out, "matches"), items


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``."""
    matches, items = find_matches(docs, benchmark, width)
    spots = matches.select("_key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
    hit = spots.groupBy("_key").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = (
        matches.select("_key", "wid").distinct().join(_small(items), "wid").select("_key", "item_id").distinct()
        .groupBy("_key").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
    )
    found = hit.join(listed, "_key", "left")
    rows = _keyed(docs).select("doc_id", "_key", F.size(word_list(F.col("text"))).cast("long").alias("n_words"))
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return rows.join(found, "_key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without a phrase match."""
    matches, _ = find_matches(docs, benchmark, width)
    hit = _small(write_scratch(matches.select(F.col("_key").alias("_hit")).distinct(), "hit-keys"))
    rows = _keyed(docs.select("doc_id", "text", F.struct("*").alias("_row")), "_row")
    return rows.join(hit, F.col("_key") == F.col("_hit"), "left_anti").select("_row.*")
