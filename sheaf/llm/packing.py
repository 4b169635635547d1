"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut into whole sequences and one
shorter first piece.  Whole pieces fill a sequence each.  The others are
dealt at random into demes of about ``deme_items`` pieces (their number
grows with the corpus, so a deme never does).  Each deme evolves on
several islands: a chromosome is a list of bins, crossover injects whole
well-filled bins of one parent into the other, drops the bins that hold a
duplicate and puts the displaced documents back by best fit.  After each
epoch the islands' best chromosomes migrate to every island of the deme.
The poorly filled bins that demes end with are emptied and packed again
together, ``regroup`` demes at a time.

Defined results: null and empty texts are pieces of the end id alone;
null ids are kept; repeated rows are pieces of their own; ties go to the
piece read first; an empty table gives no pieces; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import write_scratch
from sheaf.llm.tokens import encoder

PIECE_SCHEMA = "uid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
Bins = list[list[int]]


# ------------------------------------------------------------ the algorithm
def best_fit(lengths: np.ndarray, items: list[int], bins: Bins, capacity: int) -> Bins:
    """Put ``items`` in the given order where the least room is left; opens bins as needed."""
    size = lengths.tolist()
    room = sorted((capacity - sum(size[i] for i in b), n) for n, b in enumerate(bins))
    for i in items:
        k = bisect_left(room, (size[i], -1))
        if k < len(room):
            left, n = room.pop(k)
            bins[n].append(i)
        else:
            left, n = capacity, len(bins)
            bins.append([i])
        if left > size[i]:
            insort(room, (left - size[i], n))
    return bins


def fills(lengths: np.ndarray, bins: Bins) -> np.ndarray:
    """Tokens in each bin; bins hold few pieces, so plain sums beat an array per bin."""
    size = lengths.tolist()
    return np.array([sum([size[i] for i in b]) for b in bins])


def fitness(lengths: np.ndarray, bins: Bins, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the mean square fill: full bins and one nearly empty beat even ones."""
    fill = fills(lengths, bins) / capacity
    return -len(bins), float((fill * fill).sum())


def crossover(rng: np.random.Generator, lengths: np.ndarray, donor: Bins, taker: Bins, capacity: int) -> Bins:
    fill = fills(lengths, donor)
    full = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = [donor[k] for k in full if rng.random() < 0.5]
    inside = np.zeros(len(lengths), dtype=bool)
    for b in chosen:
        inside[b] = True
    kept, displaced = [list(b) for b in chosen], []
    for b in taker:
        if inside[b].any():
            displaced += [i for i in b if not inside[i]]
        else:
            kept.append(list(b))
    return _refit(rng, lengths, kept, displaced, capacity)


def mutate(rng: np.random.Generator, lengths: np.ndarray, bins: Bins, capacity: int) -> Bins:
    """Empty the least filled bin and a few others."""
    fill = fills(lengths, bins)
    out = set(rng.choice(len(bins), size=min(len(bins), 4), replace=False).tolist()) | {int(fill.argmin())}
    kept = [list(b) for k, b in enumerate(bins) if k not in out]
    return _refit(rng, lengths, kept, [i for k in out for i in bins[k]], capacity)


def _refit(rng: np.random.Generator, lengths: np.ndarray, bins: Bins, loose: list[int], capacity: int) -> Bins:
    order = np.argsort(-(lengths[loose] * rng.uniform(0.97, 1.0, len(loose))), kind="stable") if loose else []
    return best_fit(lengths, [loose[k] for k in order], bins, capacity)


def evolve(
    lengths: np.ndarray, capacity: int, seed: int, elites: list[Bins], population: int = 4, offspring: int = 6
) -> Bins:
    """One island's epoch; stops early where no packing can have fewer bins."""
    rng = np.random.default_rng(seed)
    bound = -(-int(lengths.sum()) // capacity)
    everything = list(range(len(lengths)))
    people = [[list(b) for b in e] for e in elites]
    decreasing = np.argsort(-lengths, kind="stable").tolist()
    while len(people) < population:
        new = best_fit(lengths, decreasing, [], capacity) if not people else _refit(rng, lengths, [], everything, capacity)
        people.append(new)
        if len(new) <= bound:
            break
    scored = sorted(((fitness(lengths, p, capacity), n, p) for n, p in enumerate(people)), reverse=True)
    for n in range(offspring):
        if -scored[0][0][0] <= bound:
            break
        a, b = rng.choice(len(scored), size=2, replace=len(scored) < 2)
        child = crossover(rng, lengths, scored[min(a, b)][2], scored[max(a, b)][2], capacity)
        child = mutate(rng, lengths, child, capacity)
        scored.append((fitness(lengths, child, capacity), len(people) + n, child))
        scored = sorted(scored, reverse=True)[:population]
    return scored[0][2]


# --------------------------------------------------------------- the pieces
def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    tok, uid = encoder(path), TaskContext.get().partitionId() << 40
    end = np.array([end_id], dtype="<u4")
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for k in range(0, len(ids), 256):
            rows = []
            for doc, got in zip(ids[k : k + 256], tok.encode_many(texts[k : k + 256])):
                all_ids = np.concatenate([got, end]).astype("<u4")
                first = len(all_ids) % capacity or capacity
                cuts = [0, *range(first, len(all_ids) + 1, capacity)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    raw = all_ids[a:b].tobytes()
                    rows.append((uid, doc, p, a, b - a, zlib.crc32(raw), raw if keep_ids else None))
                    uid += 1
            names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Table of pieces with a unique ``uid``; ``ids`` (little-endian uint32) only on request."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda it: _pieces(it, tokenizer_path, end_id, capacity, keep_ids), PIECE_SCHEMA
    )
    return write_scratch(cut, "pieces")


# --------------------------------------------------------------- the islands
def _bins_of(frame: pd.DataFrame) -> Bins:
    return [g.tolist() for g in np.split(np.arange(len(frame)), np.flatnonzero(np.diff(frame["bin"].to_numpy())) + 1)]


def _place(frame: pd.DataFrame, bins: Bins) -> pd.DataFrame:
    where = np.concatenate([np.array(b, dtype=np.int64) for b in bins])
    out = frame.iloc[where].copy()
    out["bin"] = np.repeat(np.arange(len(bins)), [len(b) for b in bins]).astype("int32")
    return out


def _island(capacity: int, epoch: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        deme, island = int(key[0]), int(key[1])
        frame = frame.sort_values(["elite", "bin", "uid"], kind="stable").reset_index(drop=True)
        items = frame[frame["elite"] == frame["elite"].iloc[0]].sort_values("uid").reset_index(drop=True)
        spot = pd.Series(np.arange(len(items)), index=items["uid"].to_numpy())
        elites: list[Bins] = []
        if epoch:
            for _, e in frame.groupby("elite", sort=True):
                at = spot.loc[e["uid"].to_numpy()].to_numpy()
                elites.append([[int(at[i]) for i in b] for b in _bins_of(e.reset_index(drop=True))])
        lengths = items["length"].to_numpy(dtype=np.int64)
        best = evolve(lengths, capacity, hash((deme, island, epoch)) & 0x7FFFFFFF, elites)
        out = _place(items, best)
        out["elite"] = np.int32(island)
        out["n_bins"] = np.int32(len(best))
        return out[["deme", "island", "elite", "uid", "length", "bin", "n_bins"]]

    return run


_DEME = "deme bigint, island int, elite int, uid bigint, length bigint, bin int, n_bins int"


def pack_demes(items: DataFrame, capacity: int, islands: int, epochs: int, name: str) -> DataFrame:
    """(deme, uid, length, bin) from items (deme, uid, length)."""
    state = items.select(
        "deme", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"),
        F.lit(0).alias("elite"), "uid", "length", F.lit(0).alias("bin"), F.lit(0).alias("n_bins"),
    )
    for epoch in range(epochs):
        state = state.groupBy("deme", "island").applyInPandas(_island(capacity, epoch), _DEME)
        state = write_scratch(state, f"{name}-epoch{epoch}")
        if epoch + 1 < epochs:
            # Migration: every island of a deme receives all islands' elites.
            state = state.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
    best = state.groupBy("deme").agg(F.min(F.struct("n_bins", "elite")).alias("best"))
    best = best.select("deme", F.col("best.elite").alias("elite"))
    return state.join(best, ["deme", "elite"]).select("deme", "uid", "length", "bin")


def pack_pieces(
    pieces: DataFrame, capacity: int = 2048, deme_items: int = 2_048, islands: int = 2, epochs: int = 2, regroup: int = 64
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    short = pieces.where(F.col("length") < capacity).select("uid", "length")
    n = short.count()
    demes = max(1, -(-n // deme_items))
    dealt = short.withColumn("deme", F.pmod(F.xxhash64("uid"), F.lit(demes)))
    first = write_scratch(pack_demes(dealt, capacity, islands, epochs, "pack"), "packed")
    if demes > 1:
        fill = first.groupBy("deme", "bin").agg(F.sum("length").alias("fill"))
        poor = fill.where(F.col("fill") < 0.9 * capacity).select("deme", "bin")
        again = first.join(poor, ["deme", "bin"]).select((F.col("deme") % F.lit(-(-demes // regroup))).alias("deme"), "uid", "length")
        second = pack_demes(again, capacity, islands, 1, "repack")
        first = first.join(poor, ["deme", "bin"], "left_anti").unionByName(
            second.select((F.col("deme") + F.lit(demes)).alias("deme"), "uid", "length", "bin")
        )
    placed = first.select("uid", (F.shiftleft("deme", 24) + F.col("bin")).alias("sequence_id"))
    joined = pieces.join(placed, "uid", "left").withColumn(
        "sequence_id", F.coalesce("sequence_id", -F.col("uid") - 1)  # a whole piece is a sequence
    )
    return joined.select("*", _offset().alias("offset"))


def _offset():
    from pyspark.sql import Window

    # A sequence holds at most ``capacity`` pieces.
    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("length").over(before), F.lit(0))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = False, **how: int) -> DataFrame:
    return pack_pieces(cut_documents(docs, tokenizer_path, end_id, capacity, keep_ids), capacity, **how)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_ids) from pieces packed with ``keep_ids=True``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
    )
