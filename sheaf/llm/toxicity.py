"""Toxicity by a weighted finite-state grammar over clauses.

Letter-to-letter transducers over word classes are composed into one
machine: a lexicon tags insults, threats, targets, negations and reported
speech; then one transducer marks threats and insults in the scope of a
negation, one marks what follows a verb of saying, one marks those that
follow a target.  The last one then runs over the machine's output from the
clause's end, for those that a target follows ("I will kill you").  Each
marked form of an insult or threat is an event of a clause; a document's
score is a logistic function of its events.

The insult lexicon (whole words and word stems) and the event weights are
fitted on a bounded, hash-drawn sample of labelled texts; the weights have
a prior in favour of plain and targeted forms over negated and reported
ones, so a form the sample lacks still counts.  Scoring reads whole texts;
labels, language, source and id are no inputs.

Defined results: null and empty texts have no events and score as a text
without any; null labels are not learned from; null ids are scored; no
usable labels leave the fixed word lists alone; repeated rows score alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled texts that are learned from, about, by label.
SAMPLE = {0: 12_000, 1: 4_000}
#: A lexicon entry's share of toxic texts over its share of clean ones, at least.
MIN_RATIO = 20.0
#: Chance that a word of the sample becomes an entry although it says nothing, at most.
CHANCE = 1e-6
STEM_LENGTHS = range(4, 9)
THRESHOLD = 0.7

# Closed-class words of the grammar in English, German, French, Spanish.
THREATS = """kill kills killing hurt hurts hurting destroy destroys destroying attack attacks attacking beat beats beating
punish punishes punishing töten töte tötet umbringen schlagen schlage schlägt tuer tue tuerai tuerons frapper frappe frapperai
détruire détruis détruirai matar mato mataré mataremos golpear golpeo golpearé destruir destruyo destruiré""".split()
TARGETS = "you your yourself they them he she him her du dich dir ihr euch sie toi vous ils elles tú usted ustedes ellos ellas".split()
NEGATIONS = "not no never neither nor isn't aren't don't nicht kein keine nie ne pas jamais ni nunca jamás".split()
REPORTS = "said says told claimed wrote quoted reported sagte sagt schrieb behauptete dit écrit déclaré dijo dice escribió".split()

#: Words a negation reaches.
SCOPE = 3
EVENTS = [k + m for k in "IH" for m in ("", "t", "n", "r")]  # plain, targeted, negated, reported
#: Prior mean of each event's weight, and of the constant.
PRIOR = {"I": 6.0, "It": 6.5, "In": 2.0, "Ir": 2.0, "H": 3.0, "Ht": 5.5, "Hn": 0.5, "Hr": 0.5}
PRIOR_CONSTANT, PRIOR_PRECISION = -3.0, 0.5

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")  # in texts whose typographic apostrophes are made plain
CLAUSE_END = re.compile(r"[.!?;:\n]+")


# ------------------------------------------------------------- transducers
@dataclass
class Fst:
    """Deterministic letter transducer; a symbol without an arc passes unchanged and steps by ``default``."""

    start: int = 0
    arcs: dict[tuple[int, str], tuple[int, str]] = field(default_factory=dict)
    default: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol)) or (self.default.get(state, state), symbol)

    def states(self) -> set[int]:
        out = {self.start, *self.default, *self.default.values()}
        return out | {s for s, _ in self.arcs} | {s for s, _ in self.arcs.values()}


def compose(first: Fst, second: Fst, alphabet: set[str]) -> Fst:
    """One machine for ``second`` after ``first`` over ``alphabet``, reachable states only."""
    number = {(first.start, second.start): 0}
    out, todo = Fst(), [(first.start, second.start)]
    while todo:
        pair = todo.pop()
        for symbol in alphabet:
            a, middle = first.step(pair[0], symbol)
            b, final = second.step(pair[1], middle)
            if (a, b) not in number:
                number[a, b] = len(number)
                todo.append((a, b))
            out.arcs[number[pair], symbol] = (number[a, b], final)
    return out


def negation() -> Fst:
    fst = Fst(default={k: max(0, k - 1) for k in range(SCOPE + 1)})
    for k in range(SCOPE + 1):
        fst.arcs[k, "N"] = (SCOPE, "o")
        if k:
            for kind in "IH":
                fst.arcs[k, kind] = (k - 1, kind + "n")
    return fst


def reported() -> Fst:
    fst = Fst(default={0: 0, 1: 1})
    for k in (0, 1):
        fst.arcs[k, "R"] = (1, "o")
    for kind in "IH":
        fst.arcs[1, kind] = (1, kind + "r")
    return fst


def targeted() -> Fst:
    """Marks what comes after a target; the target stays for the way back."""
    fst = Fst(default={0: 0, 1: 1})
    for k in (0, 1):
        fst.arcs[k, "T"] = (1, "T")
    for kind in "IH":
        fst.arcs[1, kind] = (1, kind + "t")
    return fst


def grammar() -> Fst:
    classes = set("IHTNRo")
    return compose(compose(negation(), reported(), classes), targeted(), classes)


def transduce(machine: Fst, symbols: list[str]) -> list[str]:
    state, out = machine.start, []
    for symbol in symbols:
        state, said = machine.step(state, symbol)
        out.append(said)
    return out


def clause_events(machine: Fst, back: Fst, classes: list[str]) -> list[str]:
    """The clause's word classes through ``machine``, then from the end through ``back``."""
    return transduce(back, transduce(machine, classes)[::-1])[::-1]


# ----------------------------------------------------------------- lexicon
def _fixed() -> dict[str, str]:
    return {w: c for words, c in ((REPORTS, "R"), (NEGATIONS, "N"), (TARGETS, "T"), (THREATS, "H")) for w in words}


class Tagger:
    """Finds clauses with an insult or threat and runs the grammar over their words."""

    def __init__(self, words: list[str], stems: list[str]):
        self.classes = _fixed() | {w: "I" for w in words}
        self.stems = tuple(stems)
        marks = sorted({re.escape(w) + r"(?![^\W\d_])" for w in [*words, *THREATS]} | {re.escape(s) for s in stems})
        self.hit = re.compile(r"(?<![^\W\d_])(?:" + "|".join(marks) + ")")
        self.machine, self.back = grammar(), targeted()

    def _class(self, word: str) -> str:
        c = self.classes.get(word)
        if c is None:
            c = "I" if self.stems and word.startswith(self.stems) else "o"
        return c

    def events(self, text: str | None) -> list[int]:
        """Count of each event in the clauses of a whole text."""
        counts = dict.fromkeys(EVENTS, 0)
        if text:
            low = text.lower().replace("\u2019", "'")
            done = -1
            for m in self.hit.finditer(low):
                if m.start() < done:
                    continue  # in a clause that is counted already
                begin = max(low.rfind(c, 0, m.start()) for c in ".!?;:\n") + 1
                end = CLAUSE_END.search(low, m.end())
                done = end.start() if end else len(low)
                classes = [self._class(w.group()) for w in WORD.finditer(low, begin, done)]
                for out in clause_events(self.machine, self.back, classes):
                    if out in counts:
                        counts[out] += 1
        return [counts[e] for e in EVENTS]


def _document_features(text: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1))
    stems = F.flatten(F.transform(words, lambda w: F.array(*[F.when(F.char_length(w) >= k, F.substring(w, 1, k)) for k in STEM_LENGTHS])))
    whole = F.transform(words, lambda w: F.concat(w, F.lit("$")))
    return F.array_distinct(F.filter(F.concat(stems, whole), lambda x: x.isNotNull()))


def _least_shingle(text: Column) -> Column:
    """Least hash of a text's five-word shingles, each made of its words' hashes."""
    hashed = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: F.xxhash64(w))

    def least(h: Column) -> Column:
        return F.array_min(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, 5)])))

    # transform over a one-element array names the hashes once
    return F.transform(F.array(hashed), least)[0]


def learn_lexicon(sample: DataFrame) -> tuple[list[str], list[str]]:
    """(words, stems) that mark toxic texts in ``sample`` (text, toxic)."""
    # copies and near copies count once (by their least shingle), or a large group would vote alone
    once = sample.withColumn("_least", _least_shingle(F.col("text"))).dropDuplicates(["_least", "toxic"])
    sizes = {r.toxic: r.n for r in once.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return [], []
    counts = once.select("toxic", F.explode(_document_features(F.col("text"))).alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")
    )
    # clean texts would have to miss a word of no meaning every time
    least = math.ceil(math.log(CHANCE) / math.log(n1 / (n1 + n0)))
    good = (F.col("pos") >= least) & (F.col("pos") / n1 >= MIN_RATIO * (F.col("neg") + 0.5) / (n0 + 1.0))
    found = {r.f: r.pos for r in counts.where(good).collect()}  # each is in ``least`` of the sample's texts
    words, stems = [], []
    for f in sorted((f for f in found if not f.endswith("$")), key=lambda f: (len(f), f)):
        if any(f.startswith(s) for s in stems) or any(w == f or (w.startswith(f) and found[w + "$"] >= 0.95 * found[f]) for w in words):
            continue
        whole = [w[:-1] for w in found if w.endswith("$") and w.startswith(f) and found[w] >= 0.95 * found[f]]
        if whole:
            words.append(whole[0])
            continue
        longer = [g for g in found if not g.endswith("$") and g.startswith(f) and found[g] >= 0.98 * found[f]]
        stems.append(max(longer, key=len))
    rest = [f[:-1] for f in found if f.endswith("$") and f[:-1] not in words and not any(f.startswith(s) for s in stems)]
    return sorted({*words, *rest}), sorted(stems)


# ----------------------------------------------------------------- weights
def _row(events: np.ndarray) -> np.ndarray:
    """Saturating counts: the first event weighs most."""
    return 1 - 0.25**events


def fit_weights(events: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Posterior mode of the constant and the event weights, by Newton steps."""
    mean = np.array([PRIOR_CONSTANT, *[PRIOR[e] for e in EVENTS]])
    w = mean.copy()
    if not len(labels):
        return w
    x = np.hstack([np.ones((len(labels), 1)), _row(events)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + PRIOR_PRECISION * (w - mean)
        hess = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_PRECISION * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: np.ndarray


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(text, toxic) of about ``SAMPLE`` labelled rows of each label, drawn by a hash of the id."""
    known = labels.where(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    keep = F.lit(False)
    for label, n in sizes.items():
        keep = keep | ((F.col("toxic") == label) & (draw < int(1_000_000 * min(1.0, SAMPLE[label] / n))))
    # about sum(SAMPLE.values()) ids at most
    return docs.select("doc_id", "text").join(F.broadcast(known.where(keep)), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    from sheaf.llm.common import write_scratch

    sample = write_scratch(labelled_sample(docs, labels, usable), "toxic-sample")
    words, stems = learn_lexicon(sample)
    seen = sample.mapInArrow(_events_of(words, stems), "toxic bigint, events array<int>").toPandas()
    events = np.array(seen["events"].tolist(), dtype=float).reshape(len(seen), len(EVENTS))
    return Model(words, stems, fit_weights(events, seen["toxic"].to_numpy(dtype=float)))


def _events_of(words: list[str], stems: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(words, stems)
        for b in batches:
            found = [tagger.events(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "events"])

    return run


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns with score and the clause events of every whole text."""
    fields = docs.select(*keep).schema
    words, stems, weights = model.words, model.stems, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(words, stems)
        for b in batches:
            found = np.array([tagger.events(t) for t in b.column("_text").to_pylist()], dtype=float).reshape(-1, len(EVENTS))
            z = weights[0] + _row(found) @ weights[1:]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            arrays = [b.column(c) for c in fields.names] + [pa.array(p), pa.array(found.sum(axis=1).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*fields.names, "score", "n_events"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["score double", "n_events bigint"])
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_events); rows whose crc32 of the id leaves 1 modulo 3 are held out."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit(docs, labels, ~held)
    return score(docs, model, "doc_id").select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_events",
    )
