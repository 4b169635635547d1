"""Token ids in a file of range asymmetric numeral system (rANS) segments.

A segment holds whole documents in ascending doc_id order and about
``segment_tokens`` ids.  Its static frequency table, counted over the
segment and quantised to ``2**TABLE_BITS``, is shared by all its blocks.
A block is BLOCK ids over LANES interleaved coder states with one word
stream; every CHECKPOINT steps it keeps the states and the stream
position, so that decoding starts anywhere, and all checkpoints of all
blocks decode side by side.  Each block has the CRC-32 of its ids.

The file is a Parquet table of segments: Spark's committers make it whole
even if tasks are lost or run twice.

Defined results: null and empty texts hold the end id alone; null ids
come first; repeated rows are documents of their own, ties in doc_id are
ordered by text; an empty table gives an empty file; other columns are
ignored.  A document longer than a segment makes the segment longer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.common import scratch_path
from sheaf.llm.tokens import encoder

TABLE_BITS = 18
LANES = 64
STEPS = 1024
BLOCK = LANES * STEPS
CHECKPOINT = 256
SEGMENT_TOKENS = 16 * BLOCK
#: Characters of a text that decide its range among rows of one doc_id.
TIE_CHARS = 64
LOW = np.uint64(1 << 31)
_BLOCK = "struct<n:int,crc:bigint,words:binary,states:binary,starts:binary>"
FILE_SCHEMA = (
    "part int, seq int, n_tokens bigint, symbols binary, freqs binary,"
    f" doc_ids array<bigint>, doc_lens array<bigint>, blocks array<{_BLOCK}>"
)


def quantise(counts: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Frequencies of at least 1 that sum to ``2**bits``, in proportion to ``counts``."""
    whole = 1 << bits
    if len(counts) > whole:
        raise ValueError("more symbols than the table has places")
    freq = np.maximum(1, counts.astype(np.int64) * whole // int(counts.sum()))
    gap = whole - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if gap > 0:
        freq[order[0]] += gap
    for i in order:
        if gap >= 0:
            break
        # Too many ones: take from the largest, each down to half at most.
        give = min(-gap, int(freq[i]) // 2)
        freq[i] -= give
        gap += give
    while gap < 0:
        i = int(np.argmax(freq))
        give = min(-gap, int(freq[i]) - 1)
        freq[i] -= give
        gap += give
    return freq


def encode_segment(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[dict]]:
    """(symbols uint32, freqs uint32, blocks) of a non-empty id array."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    freq = quantise(counts[symbols])
    rank = np.zeros(len(counts), dtype=np.int32)
    rank[symbols] = np.arange(len(symbols), dtype=np.int32)
    coded = rank[ids]
    start = np.concatenate([[0], np.cumsum(freq)[:-1]])
    n = len(ids)
    blocks = -(-n // BLOCK)
    steps_last = -(-(n - (blocks - 1) * BLOCK) // LANES)
    grid = np.zeros(blocks * BLOCK, dtype=np.int32)
    grid[:n] = coded
    grid[n:] = int(np.argmax(freq))  # fills the last step; dropped by n
    grid = grid.reshape(blocks, STEPS, LANES).transpose(1, 0, 2).reshape(STEPS, blocks * LANES)
    lanes = blocks * LANES
    state = np.full(lanes, LOW, dtype=np.uint64)
    words = np.zeros((STEPS, lanes), dtype=np.uint32)
    wrote = np.zeros((STEPS, lanes), dtype=bool)
    states: dict[int, np.ndarray] = {}
    fq, st = freq.astype(np.uint64), start.astype(np.uint64)
    shift, lift, half = np.uint64(TABLE_BITS), np.uint64(63 - TABLE_BITS), np.uint64(32)
    for t in range(STEPS - 1, -1, -1):
        a = lanes if t < steps_last else lanes - LANES
        if a:
            x, s = state[:a], grid[t, :a]
            f = fq[s]
            over = x >= f << lift
            words[t, :a] = x  # the low half, read only where wrote is set
            wrote[t, :a] = over
            x = np.where(over, x >> half, x)
            whole = x // f
            state[:a] = (whole << shift) + (x - whole * f) + st[s]
        if t % CHECKPOINT == 0:
            states[t] = state.copy()
    out = []
    for b in range(blocks):
        own = slice(b * LANES, (b + 1) * LANES)
        steps = STEPS if b < blocks - 1 else steps_last
        marks = range(0, steps, CHECKPOINT)
        filled = np.concatenate([[0], np.cumsum(wrote[:, own].sum(axis=1))])
        part = ids[b * BLOCK : (b + 1) * BLOCK]
        out.append({
            "n": len(part),
            "crc": zlib.crc32(part.astype("<u4").tobytes()),
            "words": words[:, own][wrote[:, own]].astype("<u4").tobytes(),
            "states": np.concatenate([states[t][own] for t in marks]).astype("<u8").tobytes(),
            "starts": filled[list(marks)].astype("<u4").tobytes(),
        })
    return symbols.astype("<u4"), freq.astype("<u4"), out


def decode_blocks(symbols: np.ndarray, freqs: np.ndarray, blocks: list[dict]) -> np.ndarray:
    """The ids of any blocks of a segment, decoded from all checkpoints at once; checks each CRC."""
    if not blocks:
        return np.empty(0, dtype=np.uint32)
    freq = freqs.astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(freqs.astype(np.int64))[:-1]]).astype(np.uint64)
    place = np.repeat(np.arange(len(freqs), dtype=np.int32), freqs.astype(np.int64))
    words, states, at, steps, base = [], [], [], [], 0
    for b in blocks:
        w = np.frombuffer(b["words"], "<u4")
        marks = np.frombuffer(b["starts"], "<u4").astype(np.int64)
        total = -(-b["n"] // LANES)
        words.append(w)
        states.append(np.frombuffer(b["states"], "<u8").reshape(-1, LANES))
        at.append(marks + base)
        steps += [min(CHECKPOINT, total - k * CHECKPOINT) for k in range(len(marks))]
        base += len(w)
    stream = np.concatenate([*words, np.zeros(1, "<u4")])
    x = np.concatenate(states).astype(np.uint64)
    pos, left = np.concatenate(at), np.array(steps)
    order = np.argsort(-left, kind="stable")  # the shorter ones stop first
    x, pos, left = x[order], pos[order], left[order]
    out = np.zeros((len(order), CHECKPOINT, LANES), dtype=np.int32)
    mask, shift, half = np.uint64((1 << TABLE_BITS) - 1), np.uint64(TABLE_BITS), np.uint64(32)
    for t in range(int(left[0])):
        a = int(np.searchsorted(-left, -t, side="left"))  # rows with left > t
        y = x[:a]
        slot = y & mask
        s = place[slot.astype(np.int64)]
        out[:a, t] = s
        y = freq[s] * (y >> shift) + slot - start[s]
        need = y < LOW
        rank = np.cumsum(need, axis=1)
        take = stream[np.where(need, pos[:a, None] + rank - 1, len(stream) - 1)]
        x[:a] = np.where(need, (y << half) | take, y)
        pos[:a] += rank[:, -1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    out = out[back]
    ids, k = [], 0
    for b in blocks:
        marks = len(b["starts"]) // 4
        got = symbols[out[k : k + marks].reshape(-1)[: b["n"]]]
        if zlib.crc32(got.astype("<u4").tobytes()) != b["crc"]:
            raise ValueError("a block's checksum does not match its ids")
        ids.append(got)
        k += marks
    return np.concatenate(ids)


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int, segment_tokens: int) -> Iterator[pa.RecordBatch]:
    tok, part = encoder(path), TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4")
    doc_ids: list = []
    lens: list[int] = []
    held: list[np.ndarray] = []
    seq = size = 0
    kind = pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("symbols", pa.binary()),
        ("freqs", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("crc", pa.int64()), ("words", pa.binary()),
                                       ("states", pa.binary()), ("starts", pa.binary())]))),
    ])

    def full() -> pa.RecordBatch:
        ids = np.concatenate(held)
        symbols, freqs, blocks = encode_segment(ids)
        row = {"part": part, "seq": seq, "n_tokens": len(ids), "symbols": symbols.tobytes(), "freqs": freqs.tobytes(),
               "doc_ids": doc_ids, "doc_lens": lens, "blocks": blocks}
        return pa.RecordBatch.from_pylist([row], schema=kind)

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for k in range(0, len(ids), 256):
            for doc, got in zip(ids[k : k + 256], tok.encode_many(texts[k : k + 256])):
                doc_ids.append(doc)
                lens.append(len(got) + 1)
                held += [got, end]
                size += len(got) + 1
                if size >= segment_tokens:
                    yield full()
                    doc_ids, lens, held, size, seq = [], [], [], 0, seq + 1
    if doc_ids:
        yield full()


def write_token_file(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, segment_tokens: int = SEGMENT_TOKENS
) -> None:
    """Encode (doc_id, text) and write the segments to ``path``.

    Rows of one doc_id (or of null) are dealt by their texts' beginnings, in the same order that sorts them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, TIE_CHARS)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(
        lambda it: _segments(it, tokenizer_path, end_id, segment_tokens), FILE_SCHEMA
    ).write.option("compression", "none").parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ids = decode_blocks(np.frombuffer(r["symbols"], "<u4"), np.frombuffer(r["freqs"], "<u4"), r["blocks"])
            if len(ids) != r["n_tokens"] or sum(r["doc_lens"]) != len(ids):
                raise ValueError("a segment's counts do not match its ids")
            ends = np.cumsum(r["doc_lens"], dtype=np.int64)
            starts = ends - np.array(r["doc_lens"], dtype=np.int64)
            packed = ids.astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([r["part"]] * len(ends), pa.int32()),
                "seq": pa.array([r["seq"]] * len(ends), pa.int32()),
                "doc_id": pa.array(r["doc_ids"], pa.int64()),
                "local_start": pa.array(starts),
                "ids": pa.array([packed[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            })


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, doc_id, local_start, ids): each document's ids as little-endian uint32 bytes."""
    table = spark.read.schema(FILE_SCHEMA).parquet(path)
    return table.mapInArrow(_decoded, "part int, seq int, doc_id bigint, local_start bigint, ids binary")


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, base): ids before each segment.  One row per part is summed
    in one task, the rest within the parts; ids are not read."""
    seg = spark.read.schema(FILE_SCHEMA).parquet(path).select("part", "seq", "n_tokens")
    parts = seg.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("before"))
    return seg.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("before") + F.col("inside")).alias("base")
    )


def token_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the file in the shared folder, read it back: (doc_id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "rans")
    write_token_file(docs, path, tokenizer_path, end_id)
    per_doc = read_token_file(spark, path).select(
        "part", "seq", "doc_id", "local_start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )
    return per_doc.join(segment_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
