"""Near-duplicate documents by odd sketches of MinHash samples.

A document's set is its distinct five-word shingles.  Documents with equal
sets form a class first, so copies never meet each other again.  Each class
keeps ``bands * ROWS`` MinHash samples, hashed by bands, and an odd sketch:
every sample toggles one bit, so the XOR of two sketches counts, by parity,
the samples in which two classes differ, and its population count gives a
sharp estimate of high similarities.  Candidates come from equal bands, are
screened by their sketches, and are confirmed on the full sets.

No pairs are spread out within a bucket: each round draws one hub per
bucket and tests it against the members outside its component.  When the
hub rounds end, the members of buckets that still hold several components
meet by prefixes of their full sets, rarest shingles first (``_exhaustive``):
every pair that is similar enough has a shingle in common there, and the
places it stands at bound what the pair can share, so members that are only
alike through a common stock of shingles are not compared.
The number of bands is set so that a pair at the threshold shares none
with a probability below ``MISS``; the sketch screen lies six standard
deviations below the threshold.

Defined results: null and empty texts have empty sets and are linked with
nothing; ties take the smallest doc_id; rows that repeat a doc_id are kept
or dropped together; null ids are linked like others, a component's id is
its smallest non-null doc_id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import write_scratch
from sheaf.llm.components import connected_components
from sheaf.operators.joins import join_group_values

SHINGLE = 5
ROWS = 5
MISS = 1e-6
SKETCH_BITS = 512
HUB_ROUNDS = 3
MAX_MEMO = 500_000
#: Ids joined by broadcast up to this many rows (8 bytes each), by a shuffle beyond.
BROADCAST_IDS = 1_000_000

_words: dict[bytes, int] = {}


def n_bands(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def screen(threshold: float) -> float:
    """Sketch estimates below this are no candidates."""
    return threshold - 6 * math.sqrt(threshold * (1 - threshold) / (n_bands(threshold) * ROWS))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    try:
        h = np.array([_words[w] for w in words], dtype=np.uint64)
    except KeyError:
        if len(_words) > MAX_MEMO:
            _words.clear()
        for w in words:
            if w not in _words:
                _words[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([_words[w] for w in words], dtype=np.uint64)
    width = min(SHINGLE, len(h))
    acc = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    return np.unique(acc)


def minhash(shingles: np.ndarray, samples: int) -> np.ndarray:
    rng = np.random.default_rng(0x5EED)
    a = (rng.integers(0, 1 << 31, samples, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
    b = rng.integers(0, 1 << 32, samples, dtype=np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(samples, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(low), 4096):
        part = low[k : k + 4096]
        np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the (position, value) pairs as int64 words."""
    at = _mix(samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    odd = np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _features(batches: Iterator[pa.RecordBatch], bands: int, carried: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    place = np.arange(bands, dtype=np.uint64)
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            s = shingle_set(text)
            if len(s):
                m = minhash(s, bands * ROWS)
                acc = place.copy()
                for k in range(ROWS):
                    acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + m[k::ROWS])
                rows.append((uid, doc, len(s), xxhash.xxh3_128_digest(s.tobytes()), acc.view(np.int64), odd_sketch(m)))
            else:
                rows.append((uid, doc, 0, None, None, None))
            uid += 1
        names = ["uid", "doc_id", "n_shingles", "set_key", "bands", "sketch"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        if rows:
            made = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(made + [batch.column(c) for c in carried], names=[*names, *carried])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            names=["set_key", "shingles"],
        )


def sketch_similarity(x: Column, y: Column, samples: int) -> Column:
    """Similarity that the XOR of two sketches points to."""
    words = SKETCH_BITS // 64
    odd = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(1, words)), F.bit_count(x[0].bitwiseXOR(y[0])))
    left = F.greatest(F.lit(1.0) - odd * F.lit(2.0 / SKETCH_BITS), F.lit(1e-9))
    return F.lit(1.0) + F.log(left) * F.lit(SKETCH_BITS / (4.0 * samples))


class _Search:
    """Candidate rounds over the classes of one corpus."""

    def __init__(self, docs: DataFrame, features: DataFrame, threshold: float):
        self.docs, self.threshold = docs, threshold
        self.samples = n_bands(threshold) * ROWS
        classes = features.where("n_shingles > 0").groupBy("set_key").agg(
            F.min(F.struct("uid", "doc_id", "n_shingles", "bands", "sketch")).alias("f")
        )
        self.classes = write_scratch(
            classes.select(F.col("f.uid").alias("cid"), F.col("f.doc_id").alias("doc_id"), "set_key",
                           F.col("f.n_shingles").alias("n"), F.col("f.bands").alias("bands"), F.col("f.sketch").alias("sketch")),
            "classes",
        )
        rows = self.classes.select("cid", F.explode("bands").alias("band"))
        shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("band")
        self.buckets = write_scratch(rows.join(shared, "band"), "buckets")
        light = self.classes.select("cid", "n", "sketch")
        self.members = light
        self.known = None  # pairs confirmed or refuted
        self.links = None
        self.sets = self._candidate_sets()

    def _candidate_sets(self) -> DataFrame:
        """Full sets of the classes that share a band, from their first document's whole text."""
        need = self.classes.join(self.buckets.select("cid").distinct(), "cid", "left_semi").select("doc_id", "set_key", "cid")
        need = write_scratch(need, "need")
        ids = need.select(F.col("doc_id").alias("_need")).distinct()
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        texts = self.docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_need")), "left_semi").select("text")
        sets = texts.mapInArrow(_sets, "set_key binary, shingles array<bigint>").where("set_key is not null")
        found = sets.join(need.select("set_key", "cid"), "set_key").groupBy("cid").agg(F.any_value("shingles").alias("shingles"))
        return write_scratch(found, "sets")

    def confirm(self, pairs: DataFrame) -> None:
        """Screen pairs (a < b) by size and sketch, confirm the rest on their full sets."""
        if self.known is not None:
            pairs = pairs.join(self.known, ["a", "b"], "left_anti")
        one = self.members.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        two = self.members.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        t = F.lit(self.threshold)
        near = pairs.join(one, "a").join(two, "b").where(
            (F.least("na", "nb") >= F.greatest("na", "nb") * t - F.lit(1e-9))
            & (sketch_similarity(F.col("sa"), F.col("sb"), self.samples) >= F.lit(screen(self.threshold)))
        ).select("a", "b")
        near = write_scratch(near, "near")
        sa = self.sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
        sb = self.sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        whole = round(self.threshold * 100)
        done = near.join(sb, "b").join(sa, "a").select("a", "b", (common * 100 >= union * whole).alias("linked"))
        done = write_scratch(done, "confirmed")
        tested = done.select("a", "b")
        self.known = tested if self.known is None else self.known.unionByName(tested)
        new = done.where("linked").select("a", "b")
        self.links = new if self.links is None else self.links.unionByName(new)

    def labelled(self) -> DataFrame:
        """Bucket members with their component, in buckets that hold several."""
        comps = connected_components(self.links)
        rows = self.buckets.join(comps, F.col("cid") == F.col("node"), "left").select(
            "band", "cid", F.coalesce("comp", "cid").alias("comp")
        )
        several = rows.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band")
        self.comps = comps
        return write_scratch(rows.join(several, "band"), "open-buckets")

    def hubs(self, rows: DataFrame, round_no: int) -> DataFrame:
        """Pairs of each bucket's hub with the members outside the hub's component."""
        order = F.struct("cid", "comp") if round_no == 0 else F.struct(F.xxhash64("cid", F.lit(round_no)).alias("o"), "cid", "comp")
        hub = rows.groupBy("band").agg(F.min(order).alias("h")).select("band", F.col("h.cid").alias("hub"), F.col("h.comp").alias("hub_comp"))
        met = rows.join(hub, "band").where("comp <> hub_comp")
        return met.select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()

    def _prefixes(self, rows: DataFrame) -> DataFrame:
        """(s, at, cid, comp, n): the shingles by which members of open buckets can meet.

        Members list their shingles from the rarest to the commonest, rarity
        being counted over all of them.  Sets that are similar enough share one
        near the front: ``at`` places before it leave too little to share.
        Shingles of one member alone are counted, not carried."""
        whole = round(self.threshold * 100)
        members = write_scratch(rows.select("cid", "comp").distinct(), "open-members")
        each = members.join(self.sets, "cid").select("cid", "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
        shared = each.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        told = join_group_values(each, shared, ["s"], "c")
        order = F.array_sort(F.collect_list(F.struct("c", "s"))).alias("o")
        listed = told.groupBy("cid", "comp", "n").agg(order).withColumn("alone", F.col("n") - F.size("o"))
        front = listed.select("cid", "comp", "n", "alone", F.posexplode(F.transform("o", lambda x: x["s"])).alias("k", "s"))
        at = F.col("alone") + F.col("k")
        return front.select("s", at.alias("at"), "cid", "comp", "n").where((F.col("n") - F.col("at")) * 100 >= F.col("n") * whole)

    def _exhaustive(self, rows: DataFrame) -> DataFrame:
        """Pairs of open members of different components that can be similar enough, all of them.

        The larger set x and the smaller y first meet at places i and j of their
        lists, so they share at most min(nx - i, ny - j) shingles."""
        whole = round(self.threshold * 100)
        front = write_scratch(self._prefixes(rows), "prefixes")
        x, y = front.alias("x"), front.where((F.col("n") - F.col("at")) * (100 + whole) >= F.col("n") * (2 * whole)).alias("y")
        most = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
        met = x.join(
            y,
            (F.col("x.s") == F.col("y.s"))
            & (F.col("x.comp") != F.col("y.comp"))
            & ((F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.cid") < F.col("x.cid"))))
            & (most * (100 + whole) >= (F.col("x.n") + F.col("y.n")) * whole),
        )
        return met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()

    def run(self) -> DataFrame:
        rows = self.buckets.select("band", "cid", F.col("cid").alias("comp"))
        for r in range(HUB_ROUNDS):
            self.confirm(self.hubs(rows, r))
            rows = self.labelled()
        self.confirm(self._exhaustive(rows))
        return connected_components(self.links)


def _components(docs: DataFrame, threshold: float, *carried: str) -> DataFrame:
    """(doc_id, n_shingles, comp, ``carried`` long columns), one row per row of ``docs``; empty sets have no comp."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    bands = n_bands(threshold)
    schema = "uid bigint, doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>"
    features = write_scratch(
        docs.mapInArrow(lambda it: _features(it, bands, carried), ", ".join([schema, *[f"{c} bigint" for c in carried]])),
        "features",
    )
    search = _Search(docs, features, threshold)
    comps = search.run()
    keyed = search.classes.join(comps, F.col("cid") == F.col("node"), "left").select(
        "set_key", F.coalesce("comp", "cid").alias("comp")
    )
    return write_scratch(
        features.select("doc_id", "n_shingles", "set_key", *carried).join(keyed, "set_key", "left"), "doc-comps"
    )


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    rows = _components(docs, threshold)
    # components -> the smallest doc_id of each
    least = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(least, "comp", "left")
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: exactly one row of each
    component stays, by doc_id (nulls last), text hash and place in a written table.
    Rows with empty sets stay."""
    table = write_scratch(docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_place")), "numbered")
    read = table.select("_row.doc_id", "_row.text", F.xxhash64("_row.text").alias("_hash"), "_place")
    rows = _components(read, threshold, "_hash", "_place").where("comp is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash", "_place"))
    stay = rows.groupBy("comp").agg(first.alias("f")).select(F.col("f._place").alias("_place"))
    gone = write_scratch(rows.select("_place").join(stay, "_place", "left_anti"), "near-gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return table.join(gone, "_place", "left_anti").select("_row.*")
