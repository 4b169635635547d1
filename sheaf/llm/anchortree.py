"""Hard negatives by anchor spanning-tree bounds.

Anchors (the queries) are cut into blocks of near neighbours; each block
is a minimum spanning tree of its vectors.  Going down the tree, the score
of candidate x at a child lies within ``delta * |x|`` of its score at the
parent, where delta is the length of the tree's edge.  Only candidates
whose interval overlaps what an anchor still looks for are scored anew;
the others hand their interval on to the next level.

Two passes over the candidates, both exact: the best rows of the anchor's
own label (positives; an interval must reach the anchor's current last
place, which starts at the value found among the block's own anchors), then,
for each positive, the best rows of other labels whose score lies in the
window that the positive's score sets.

Scale: the candidates are scanned where they lie, never shuffled or joined.
Blocks go to the tasks in groups of at most ``group_bytes``, one scan per
group and pass; each task hands on at most ``positives`` rows per anchor and
``negatives`` per window.

Rows: a null label or vector, or any null or non-finite component: no part.
Scores exist between vectors of one length only.  Rows with the anchor's own
id are never its partners; equal anchor rows count once, anchors of one id
with different vectors are each an anchor.  Other repeated rows each count.
A null id is no anchor and comes last among ties.  Scores are exact
integers; beyond 64 bits they saturate.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import scratch_path, write_scratch

#: Anchors of a tree.
BLOCK = 1024
#: Bytes of blocks sent to the tasks for one scan.
GROUP_BYTES = 64 << 20
#: Candidates looked at together.
CHUNK = 2048
NO_ID = np.iinfo(np.int64).max
_LIMIT = np.iinfo(np.int64).max
_NONE = -_LIMIT  # below every score that a row must reach


def integer_rows(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: float) -> DataFrame:
    """(id, label, q): the rows that take part, components as floor(scale * x)."""
    vec = F.col(vec_col).cast("array<double>")
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(vec.isNotNull() & sound & label.isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(vec, lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("q"),
    )


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge length) of the minimum spanning tree of the rows, root 0 (Prim)."""
    n = len(x)
    parent, edge = np.full(n, -1), np.zeros(n)
    near, source = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    at, open_ = 0, np.ones(n, dtype=bool)
    for _ in range(n - 1):
        open_[at] = False
        gap = np.sqrt(((x - x[at]) ** 2).sum(1))
        closer = open_ & (gap < near)
        near[closer], source[closer] = gap[closer], at
        at = int(np.where(open_, near, np.inf).argmin())
        if not open_[at]:  # distances beyond the range of doubles
            at = int(open_.argmax())
        parent[at], edge[at] = source[at], near[at]
    return parent, edge


def levels_of(parent: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth, the root first."""
    out, frontier = [], np.flatnonzero(parent < 0)
    while len(frontier):
        out.append(frontier)
        frontier = np.flatnonzero(np.isin(parent, frontier))
    return out


def products(a: np.ndarray, x: np.ndarray, paired: bool = False) -> np.ndarray:
    """Exact integer scores of all rows of ``a`` with all of ``x``, or row by row."""
    with np.errstate(over="ignore"):
        reach = float(np.sqrt((a * a).sum(1)).max(initial=0)) * float(np.sqrt((x * x).sum(1)).max(initial=0))
    if reach < 2**53:
        return np.einsum("ij,ij->i", a, x) if paired else a @ x.T
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (a, x)]
    found = (whole[0] * whole[1]).sum(1) if paired else whole[0] @ whole[1].T
    return np.clip(found, -_LIMIT, _LIMIT).astype(np.int64)


class Block:
    """Anchors of one length with their tree."""

    def __init__(self, block: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, parent: np.ndarray, edge: np.ndarray, floor: np.ndarray):
        self.block, self.ids, self.labels, self.x, self.parent, self.edge, self.floor = block, ids, labels, x, parent, edge, floor
        self.levels = levels_of(parent)
        self.scored = 0

    def walk(self, x: np.ndarray, norm: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple]:
        """Yields (anchors, rows of x, exact scores) of every pair that ``wanted(nodes, low, high)`` cannot rule out."""
        place = np.zeros(len(self.x), dtype=np.int64)
        low = high = np.zeros((0, len(x)))
        for nodes in self.levels:
            if self.parent[nodes[0]] < 0:
                low = products(self.x[nodes], x).astype(np.float64)
                low, high = low - np.abs(low) * 1e-12, low + np.abs(low) * 1e-12
                self.scored += low.size
                anchor, row = np.nonzero(wanted(nodes, low, high))
                exact = products(self.x[nodes[anchor]], x[row], paired=True)
            else:
                # rounding of the bounds is outwards
                slack = self.edge[nodes][:, None] * norm * (1 + 1e-9) + 1e-6
                above = place[self.parent[nodes]]
                low, high = low[above] - slack, high[above] + slack
                slack = np.maximum(np.abs(low), np.abs(high)) * 1e-12
                low, high = low - slack, high + slack
                anchor, row = np.nonzero(wanted(nodes, low, high))
                self.scored += len(anchor)
                if 4 * len(anchor) > low.size:  # dense: one product of matrices
                    exact = products(self.x[nodes], x)[anchor, row]
                else:
                    exact = products(self.x[nodes[anchor]], x[row], paired=True)
                tight = exact.astype(np.float64)
                low[anchor, row], high[anchor, row] = tight - np.abs(tight) * 1e-12, tight + np.abs(tight) * 1e-12
            place[nodes] = np.arange(len(nodes))
            yield nodes[anchor], row, exact.astype(np.int64)


def best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``limit`` of each key by score (descending), then id."""
    order = np.lexsort((ids, -score, key))
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
    kept = order[rank < limit]
    return key[rank < limit], score[kept], ids[kept]


class Places:
    """The best rows of each key so far, and the score that a row must reach."""

    def __init__(self, floor: np.ndarray, limit: int):
        self.limit, self.floor = limit, floor.copy()
        self.key = self.score = self.ids = np.zeros(0, dtype=np.int64)

    def add(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if not found:
            return
        own = (self.key, self.score, self.ids)
        self.key, self.score, self.ids = best(*(np.concatenate(x) for x in zip(own, *found)), self.limit)
        full = np.flatnonzero(np.bincount(self.key, minlength=len(self.floor)) == self.limit)
        last = np.searchsorted(self.key, full, side="right") - 1
        self.floor[full] = np.maximum(self.floor[full], self.score[last])


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of a batch (id, label, q), by vector length, in chunks."""
    ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
    values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        for k in range(0, len(rows), CHUNK):
            part = rows[k : k + CHUNK]
            yield ids[part], labels[part], values[starts[part][:, None] + np.arange(d)]


def anchor_blocks(anchors: DataFrame, positives: int, block: int = BLOCK) -> DataFrame:
    """One row per block: ids, labels, vectors, tree, and a first value that its anchors' positives reach.

    Anchors are dealt by ranges of (length, label, first components), so a
    block holds neighbours; a label of any size is cut into blocks.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def made(pieces: list) -> pa.RecordBatch:
            nonlocal n
            ids, labels, x = (np.concatenate(c) for c in zip(*pieces))
            parent, edge = spanning_tree(x)
            scores = products(x, x).astype(np.int64)
            scores[(labels[:, None] != labels) | (ids[:, None] == ids)] = _NONE
            kth = -np.sort(-scores, axis=1)[:, positives - 1] if len(ids) >= positives else np.full(len(ids), _NONE)
            cells = [ids, labels, x, parent.astype(np.int64), edge, kth]
            n += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + n - 1]), pa.array([x.shape[1]]), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                names=["block", "dim", "ids", "labels", "x", "parent", "edge", "floor"],
            )

        for batch in batches:
            for ids, labels, x in _vectors(batch):
                held = waiting.setdefault(x.shape[1], [])
                for k in range(0, len(ids), block):
                    held.append((ids[k : k + block], labels[k : k + block], x[k : k + block]))
                    if sum(len(p[0]) for p in held) >= block:
                        yield made(held)
                        held.clear()
        for held in waiting.values():
            if held:
                yield made(held)

    schema = "block long, dim long, ids binary, labels binary, x binary, parent binary, edge binary, floor binary"
    anchors = write_scratch(anchors.dropDuplicates(["id", "label", "q"]), "anchors")
    parts = -(-anchors.count() // block) or 1
    first = [F.element_at("q", k) for k in (1, 2)]
    first = [F.when(F.size("q") >= k + 1, c) for k, c in enumerate(first)]
    dealt = anchors.repartitionByRange(parts, F.size("q"), "label", *first, "id")
    return dealt.sortWithinPartitions(F.size("q"), "label", *first, "id").mapInArrow(build, schema)


def _load(rows: list) -> list[Block]:
    out = []
    for r in rows:
        ids, labels, parent, floor = (np.frombuffer(r[c], dtype=np.int64) for c in ("ids", "labels", "parent", "floor"))
        x, edge = (np.frombuffer(r[c], dtype=np.float64) for c in ("x", "edge"))
        out.append(Block(r["block"], ids, labels, x.reshape(len(ids), r["dim"]), parent, edge, floor))
    return out


def _groups(blocks: DataFrame, group_bytes: int) -> list[list[int]]:
    """Block ids in groups of bounded size (16 bytes per block reach the driver)."""
    out, held = [], 0
    for r in blocks.select("block", F.octet_length("x").alias("size")).orderBy("block").toLocalIterator():
        if not out or held + r["size"] > group_bytes:
            out.append([])
            held = 0
        out[-1].append(r["block"])
        held += r["size"]
    return out


def _emit(blocks: list[Block], places: list[Places], per: int) -> Iterator[pa.RecordBatch]:
    for b, p in zip(blocks, places):
        if len(p.key):
            cells = [np.full(len(p.key), b.block), p.key // per, p.key % per]
            ids = pa.array(p.ids, mask=p.ids == NO_ID)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cells), ids, pa.array(p.score)], names=["block", "node", "slot", "id", "score"])


FOUND = "block long, node long, slot long, id long, score long"


def find_positives(rows: DataFrame, blocks: DataFrame, positives: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(block, node, slot, id, score): the best rows of each anchor's own label, slot from 0."""
    sc = rows.sparkSession.sparkContext
    path = scratch_path(rows.sparkSession, "positives")
    rows.sparkSession.createDataFrame([], FOUND).write.parquet(path)
    for group in _groups(blocks, group_bytes):
        shipped = sc.broadcast([r.asDict() for r in blocks.where(F.col("block").isin(group)).collect()])

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            trees = _load(shipped.value)
            places = [Places(t.floor, positives) for t in trees]
            for batch in batches:
                for ids, labels, x in _vectors(batch):
                    norm = np.sqrt((x * x).sum(1))
                    for t, p in zip(trees, places):
                        if t.x.shape[1] != x.shape[1]:
                            continue

                        def wanted(nodes, low, high):
                            return (t.labels[nodes][:, None] == labels) & (high >= p.floor[nodes][:, None]) & (t.ids[nodes][:, None] != ids)

                        p.add([(a, s, ids[r]) for a, r, s in t.walk(x, norm, wanted)])
            yield from _emit(trees, places, 1)

        rows.mapInArrow(run, FOUND).write.mode("append").parquet(path)
        shipped.unpersist()
    found = rows.sparkSession.read.schema(FOUND).parquet(path)
    place = F.row_number().over(Window.partitionBy("block", "node").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return write_scratch(found.withColumn("slot", (place - 1).cast("long")).where(F.col("slot") < positives), "positives")


def find_negatives(
    rows: DataFrame, blocks: DataFrame, chosen: DataFrame, positives: int, negatives: int, low_pct: int, high_pct: int, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """(block, node, slot, id, score, rank): for each positive's slot the best rows of
    other labels with low_pct * positive <= 100 * score <= high_pct * positive."""
    sc = rows.sparkSession.sparkContext
    path = scratch_path(rows.sparkSession, "negatives")
    rows.sparkSession.createDataFrame([], FOUND).write.parquet(path)
    for group in _groups(blocks, group_bytes):
        held = blocks.where(F.col("block").isin(group)).collect()
        windows = chosen.where(F.col("block").isin(group)).select("block", "node", "slot", "score").toArrow()
        shipped = sc.broadcast(([r.asDict() for r in held], *(windows.column(c).to_numpy() for c in ("block", "node", "slot", "score"))))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            held, at, node, slot, score = shipped.value
            trees = _load(held)
            # integer bounds of each window; an open slot has an empty window
            low = np.array([-(-int(s) * low_pct // 100) for s in score], dtype=np.int64)
            high = np.array([int(s) * high_pct // 100 for s in score], dtype=np.int64)
            places, tops = [], []
            for t in trees:
                floor, top = np.full(len(t.ids) * positives, _LIMIT), np.full(len(t.ids) * positives, _NONE)
                own = at == t.block
                floor[node[own] * positives + slot[own]], top[node[own] * positives + slot[own]] = low[own], high[own]
                floor[top < floor] = _LIMIT
                places.append(Places(floor, negatives))
                tops.append(top.reshape(-1, positives))
            for batch in batches:
                for ids, labels, x in _vectors(batch):
                    norm = np.sqrt((x * x).sum(1))
                    for t, p, top in zip(trees, places, tops):
                        if t.x.shape[1] != x.shape[1]:
                            continue
                        floor = p.floor.reshape(-1, positives)
                        least, most = floor.min(1), np.where(floor == _LIMIT, _NONE, top).max(1)

                        def wanted(nodes, lo, hi):
                            overlap = (hi >= least[nodes][:, None]) & (lo <= most[nodes][:, None])
                            return overlap & (t.labels[nodes][:, None] != labels) & (t.ids[nodes][:, None] != ids)

                        found = []
                        for a, r, s in t.walk(x, norm, wanted):
                            for w in range(positives):
                                inside = np.flatnonzero((s >= floor[a, w]) & (s <= top[a, w]))
                                found.append((a[inside] * positives + w, s[inside], ids[r[inside]]))
                        p.add(found)
            yield from _emit(trees, places, positives)

        rows.mapInArrow(run, FOUND).write.mode("append").parquet(path)
        shipped.unpersist()
    found = rows.sparkSession.read.schema(FOUND).parquet(path)
    place = F.row_number().over(Window.partitionBy("block", "node", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= negatives)


def hard_negatives(
    df: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", positives: int = 5, negatives: int = 3,
    low_pct: int = 50, high_pct: int = 95, scale: float = 256.0, block: int = BLOCK, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); see the module.

    ``is_anchor`` and ``label`` are expressions over ``df``.
    """
    rows = integer_rows(df, id_col, vec_col, label, scale)
    anchors = integer_rows(df.where(is_anchor), id_col, vec_col, label, scale)
    blocks = write_scratch(anchor_blocks(anchors, positives, block), "anchor-blocks")
    chosen = find_positives(rows, blocks, positives, group_bytes)
    found = find_negatives(rows, blocks, chosen, positives, negatives, low_pct, high_pct, group_bytes)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(ids, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), b)), pa.array(np.arange(len(own))), pa.array(own)], names=["block", "node", "anchor_id"])

    anchor = blocks.select("block", "ids").mapInArrow(names, "block long, node long, anchor_id long")
    pairs = chosen.select("block", "node", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.select("block", "node", "slot", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    out = out.join(pairs, ["block", "node", "slot"]).join(anchor, ["block", "node"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
