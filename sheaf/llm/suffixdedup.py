"""Repeated byte strings by external induced sorting over content shards.

Every ``width``-byte string that starts at two places is removed wherever it
stands (same text included; overlaps count; judged on the input).

1. *Shards by content.*  The string at a place is filed under the least hash
   of its ``gram``-byte parts (the first of equal ones): the place of that
   part, cut into two halves by the distance to it, gives runs of
   neighbouring places, *segments*, and the bytes common to all strings of a
   segment's range give its key.  Equal strings have equal keys, whatever
   stands around them, and a key that occurs once holds no repeated string.
2. *Pre-aggregation.*  Keys are counted (combined in the tasks); only
   segments under repeated keys send their bytes on.  Equal segments become
   one with its number: their strings are repeated, without any sorting.
   Different segments under one key are cut into ranges of ``FINE`` places
   and go through the same once more, with keys of almost whole strings.
3. *Induced sorting* (``induced.suffix_order``) of the different segments
   that still share a key, shard by shard: neighbours in suffix order with a
   common prefix of ``width`` are repeated strings.
4. Marks go back to the texts; covered bytes are removed.

Texts are known by their SHA-256, so a text of any number of copies is
analysed once (every byte of it is repeated when it is ``width`` long) and
copies need no text moved.  A key with more than ``hot_segments`` different
segments (a passage in very many surroundings) is no shard of its own: its
strings are combined in the tasks one by one, by their digests.  So no shard
has more than ``shard_bytes`` and one such key's segments, at any input size.

Rows: null text is empty; empty and short texts stay as they are.  Repeated
rows and ids are rows of their own (their texts repeat, so they go);
null ids stay null.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import scratch_path, write_scratch
from sheaf.llm.induced import suffix_order
from sheaf.operators.joins import broadcast_if_small, join_group_values

#: Bytes of text handled at a time while segments are looked for.
SLICE_BYTES = 4 << 20
#: Bytes of segments sorted as one shard.
SHARD_BYTES = 1 << 20
#: Different segments of one key beyond which its strings are combined one by one.
HOT_SEGMENTS = 2048
#: Places looked at as one block in a very long text (positions in a block take 24 bits).
BLOCK = 1 << 22
#: Places of a fine segment.
FINE = 16
_MASK = np.uint64((1 << 24) - 1)


class Shape:
    """Lengths that follow from the width of the strings."""

    def __init__(self, width: int, gram: int = 16):
        if gram < 8 or width < 3 * gram:
            raise ValueError("gram must be 8 at least, width three grams")
        self.width, self.gram = width, gram
        self.grams = width - gram + 1
        self.half = -(-self.grams // 2)
        self.core = width - self.half + 1
        rng = np.random.default_rng(9)  # fixed odd factors of the hashes
        self.factors = rng.integers(0, 1 << 63, width // 8 + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _words(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place (the buffer has eight bytes to spare)."""
    return np.ndarray((len(buffer) - 8,), dtype="<u8", buffer=buffer.data, strides=(1,))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def _key(words: np.ndarray, start: np.ndarray, length: int, seed: np.ndarray, shape: Shape) -> np.ndarray:
    """Hash of ``length`` bytes (whole eights) from each start."""
    key = seed.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(length // 8):
        key = _mix(key ^ (words[start + 8 * k] * shape.factors[k]))
    return key


def segments(texts: list[bytes], shape: Shape) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, key, first place, last place, shift) of the segments of some texts, in blocks.

    ``shift``: places of the segment's range before the first.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    buffer = np.frombuffer(b"".join([*texts, bytes(8 + shape.gram)]), dtype=np.uint8)
    words = _words(buffer)
    allowed = np.zeros(total + 1, dtype=np.int8)
    long_ = sizes >= shape.width
    np.add.at(allowed, starts[long_], 1)
    np.add.at(allowed, (starts + sizes - shape.width + 1)[long_], -1)
    allowed = np.cumsum(allowed[:total], dtype=np.int8).astype(bool)
    for low in range(0, max(total - shape.width + 1, 0), BLOCK):
        high = min(low + BLOCK, total - shape.width + 1)
        span = slice(low, high + shape.grams - 1)
        hashed = _mix(_mix(words[span]) + words[span.start + shape.gram - 8 : span.stop + shape.gram - 8] * shape.factors[-1])
        hashed = (hashed & ~_MASK) | np.arange(len(hashed), dtype=np.uint64)
        anchor = (_least(hashed, shape.grams) & _MASK).astype(np.int64) + low
        place = np.flatnonzero(allowed[low:high]) + low
        if not len(place):
            continue
        anchor = anchor[place - low]
        side = (anchor - place) // shape.half
        new = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(anchor) != 0) | (np.diff(side) != 0)])
        first, last = place[new], place[np.r_[new[1:], len(place)] - 1]
        # the bytes common to all strings of the range, from its last place on
        core = anchor[new] - side[new] * shape.half
        key = _key(words, core, shape.core, side[new], shape)
        text = np.searchsorted(starts, first, side="right") - 1
        # texts of no bytes share a start with the next; the last of them is meant
        yield text, key.view(np.int64), first - starts[text], last - starts[text], first - core + shape.half - 1


def fine_segments(pieces: list[bytes], keys: np.ndarray, shifts: np.ndarray, shape: Shape, fine: int = FINE) -> Iterator[tuple[np.ndarray, ...]]:
    """As ``segments``, of pieces that are segments themselves: the parts of ``fine`` places of their ranges."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    words = _words(np.frombuffer(b"".join([*pieces, bytes(8)]), dtype=np.uint8))
    strings = sizes - shape.width + 1
    parts = (shifts + strings - 1) // fine - shifts // fine + 1
    piece = np.repeat(np.arange(len(pieces)), parts)
    part = np.arange(len(piece)) - np.repeat(np.cumsum(parts) - parts, parts) + (shifts // fine)[piece]
    first = np.maximum(part * fine - shifts[piece], 0)
    last = np.minimum(part * fine + fine - 1 - shifts[piece], strings[piece] - 1)
    core = part * fine + fine - 1 - shifts[piece] + starts[piece]
    seed = keys[piece].view(np.uint64) + part.astype(np.uint64)
    key = _key(words, core, shape.width - fine + 1, seed, shape)
    yield piece, key.view(np.int64), first, last, np.zeros(len(piece), dtype=np.int64)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for n, size in enumerate(sizes):
        held += size
        if held >= SLICE_BYTES:
            yield start, n + 1
            start, held = n + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


LISTED = "key long, h binary, n long, first long, last long, shift long"


def find_segments(texts: DataFrame, shape: Shape, fine: bool = False) -> DataFrame:
    """(key, h, n, first, last, shift) of all segments of (h, data, n), or the fine ones of (h, data, n, key, shift)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(1).to_pylist()
            for start, end in _slices([len(d) for d in data]):
                own = batch.slice(start, end - start)
                if fine:
                    found = fine_segments(data[start:end], own.column(3).to_numpy(), own.column(4).to_numpy(), shape)
                else:
                    found = segments(data[start:end], shape)
                for text, key, *places in found:
                    text = pa.array(text)
                    cells = [pa.array(key), own.column(0).take(text), own.column(2).take(text), *map(pa.array, places)]
                    yield pa.RecordBatch.from_arrays(cells, names=["key", "h", "n", "first", "last", "shift"])

    return texts.select("h", "data", "n", *(["key", "shift"] if fine else [])).mapInArrow(run, LISTED)


def cut_segments(texts: DataFrame, width: int) -> DataFrame:
    """(key, h, n, first, shift, digest, piece) of the listed segments of (h, data, n, found)."""

    names = ["key", "h", "n", "first", "shift", "digest", "piece"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for h, data, n, found in zip(*(batch.column(c).to_pylist() for c in ("h", "data", "n", "found"))):
                for x in found:
                    first = x["first"]
                    piece = data[first : x["last"] + width]
                    held.append((x["key"], h, n, first, x["shift"], hashlib.blake2b(piece, digest_size=16).digest(), piece))
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    schema = "key long, h binary, n long, first long, shift long, digest binary, piece binary"
    return texts.select("h", "data", "n", "found").mapInArrow(run, schema)


def repeated_places(texts: DataFrame, listed: DataFrame, width: int, rest: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(h, low, high): places of (h, data, n) whose strings are repeated, given the texts'
    segments; and the texts that may have such places.

    ``rest`` marks, as (digest, low, high), the different pieces (key, digest,
    piece, n, shift, kinds) that share a key.
    """
    keys = listed.groupBy("key").agg(F.sum("n").alias("times")).where("times > 1")
    # only the hot keys are sent to the tasks, however many keys there are
    listed = join_group_values(listed, keys, ["key"], "times", broadcast_max_rows=0).groupBy("h").agg(F.collect_list(F.struct("key", "first", "last", "shift")).alias("found"))
    texts = write_scratch(texts.join(listed, "h"), "holders")
    cut = write_scratch(cut_segments(texts, width), "pieces")
    distinct = cut.groupBy("key", "digest").agg(F.sum("n").alias("n"), F.first("shift").alias("shift"), F.first("piece").alias("piece"))
    distinct = write_scratch(distinct, "distinct-pieces")
    kinds, _ = broadcast_if_small(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    # one kind of segment under a key: all its strings are repeated, or none
    alone = distinct.join(kinds, "key", "left_anti").where("n > 1")
    alone = alone.select("digest", F.lit(0).cast("long").alias("low"), (F.octet_length("piece") - width).cast("long").alias("high"))
    marks = write_scratch(alone.unionByName(rest(distinct.join(kinds, "key"))), "marks")
    placed = cut.select("digest", "h", "first").join(marks, "digest")
    return placed.select("h", (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high")), texts


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of neighbouring places (sorted)."""
    new = np.flatnonzero(np.r_[True, np.diff(places) != 1])
    return places[new], places[np.r_[new[1:], len(places)] - 1]


def sort_shards(pieces: DataFrame, width: int, shard_bytes: int, queue_rows: int, folder: str) -> DataFrame:
    """(digest, low, high): runs of places in (key, digest, piece, n) whose strings are repeated.

    Pieces come by key; whole keys make up a shard.  ``n`` above one: all its strings are.
    """

    def sorted_shard(held: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
        digests, pieces, times = zip(*held)
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes + 1) - sizes - 1
        strings = sizes - width + 1
        wanted = np.repeat(starts - (np.cumsum(strings) - strings), strings) + np.arange(strings.sum())
        places, common = suffix_order(list(pieces), wanted, queue_rows, folder, width)
        alike = common >= width
        repeated = np.zeros(int(sizes.sum() + len(sizes)), dtype=bool)
        repeated[places[alike]] = True
        repeated[places[np.flatnonzero(alike) - 1]] = True
        for k in np.flatnonzero(np.array(times) > 1):
            repeated[starts[k] : starts[k] + strings[k]] = True
        low, high = _runs(np.flatnonzero(repeated)) if repeated.any() else (np.zeros(0, dtype=np.int64),) * 2
        owner = np.searchsorted(starts, low, side="right") - 1
        cells = [pa.array([digests[k] for k in owner], pa.binary()), pa.array(low - starts[owner]), pa.array(high - starts[owner])]
        return pa.RecordBatch.from_arrays(cells, names=["digest", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, int]] = []
        size, last = 0, None
        for batch in batches:
            for key, digest, piece, n in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "piece", "n"))):
                if key != last and size >= shard_bytes:
                    yield sorted_shard(held)
                    held, size = [], 0
                held.append((digest, piece, n))
                size += len(piece)
                last = key
        if held:
            yield sorted_shard(held)

    dealt = pieces.select("key", "digest", "piece", "n").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "digest binary, low long, high long")


def combine_strings(pieces: DataFrame, width: int) -> DataFrame:
    """As ``sort_shards``, string by string: repeated ones are met by a count that is combined in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, piece, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "piece", "n"))):
                places = range(len(piece) - width + 1)
                strings = [hashlib.blake2b(piece[k : k + width], digest_size=16).digest() for k in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest] * len(strings), pa.binary()), pa.array(strings, pa.binary()), pa.array(places, pa.int64()), pa.array([n] * len(strings), pa.int64())],
                    names=["digest", "string", "low", "n"],
                )

    strings = write_scratch(pieces.select("digest", "piece", "n").mapInArrow(run, "digest binary, string binary, low long, n long"), "hot-strings")
    repeated = strings.groupBy("string").agg(F.sum("n").alias("times")).where("times > 1").select("string")
    return strings.join(repeated, "string").select("digest", "low", F.col("low").alias("high"))


def remove_marked(texts: DataFrame, width: int) -> DataFrame:
    """(h, spans, kept) of (h, data, marks): removed runs as (start, end), and the bytes that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for h, data, marks in zip(*(batch.column(c).to_pylist() for c in ("h", "data", "marks"))):
                spans: list[list[int]] = []
                for low, high in sorted((m["low"], m["high"] + width) for m in marks):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                ends = [0, *(e for _, e in spans)]
                for col, value in zip(out, (h, [{"start": s, "end": e} for s, e in spans], b"".join(data[a:b] for a, b in zip(ends, [*(s for s, _ in spans), len(data)])))):
                    col.append(value)
            kinds = [pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["h", "spans", "kept"])

    return texts.select("h", "data", "marks").mapInArrow(run, "h binary, spans array<struct<start:long,end:long>>, kept binary")


def repeated_strings(
    docs: DataFrame, width: int = 400, gram: int = 16, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES,
    hot_segments: int = HOT_SEGMENTS, queue_rows: int = 1 << 22,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (id, n_bytes, h) of every row, and (h, spans, kept) of every text that loses bytes.

    ``h`` is the SHA-256 of the text's UTF-8 bytes, ``kept`` the bytes that stay.
    """
    spark, shape = docs.sparkSession, Shape(width, gram)
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), data.alias("data"), F.unhex(F.sha2(data, 256)).alias("h"))
    names = write_scratch(rows.select("id", F.octet_length("data").cast("long").alias("n_bytes"), "h"), "texts")
    long_ = rows.where(F.octet_length("data") >= width).select("h", "data")
    copied = names.where(F.col("n_bytes") >= width).groupBy("h").agg(F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"))
    copied, _ = broadcast_if_small(copied.where("copies > 1"))
    # one row of each text; only copied texts take part in the grouping, combined in the tasks
    singles = long_.join(copied, "h", "left_anti")
    once = long_.join(copied, "h", "left_semi").groupBy("h").agg(F.first("data").alias("data"))
    texts = singles.unionByName(write_scratch(once, "copied-texts")).withColumn("n", F.lit(1).cast("long"))

    def sort_or_combine(mixed: DataFrame) -> DataFrame:
        queues = scratch_path(spark, "queues")
        ordered = sort_shards(mixed.where(F.col("kinds") <= hot_segments), width, shard_bytes, queue_rows, queues)
        return ordered.unionByName(combine_strings(mixed.where(F.col("kinds") > hot_segments), width))

    def refine(mixed: DataFrame) -> DataFrame:
        # the same bytes have the same key and shift
        pieces = mixed.select(F.col("digest").alias("h"), F.col("piece").alias("data"), "n", "key", "shift")
        pieces = write_scratch(pieces, "mixed-pieces")
        fine = write_scratch(find_segments(pieces, shape, fine=True), "fine-segments")
        return repeated_places(pieces, fine, width, sort_or_combine)[0].withColumnRenamed("h", "digest")

    listed = write_scratch(find_segments(texts, shape), "segments")
    placed, texts = repeated_places(texts, listed, width, refine)
    placed = placed.groupBy("h").agg(F.collect_list(F.struct("low", "high")).alias("marks"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    lost = remove_marked(texts.join(copied, "h", "left_anti").join(placed, "h"), width)
    gone = copied.select("h", whole.alias("spans"), F.lit("").cast("binary").alias("kept"))
    return names.withColumnRenamed("id", id_col), write_scratch(lost.unionByName(gone), "removed")


def removal_report(docs: DataFrame, width: int = 400, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that stay)."""
    names, removed = repeated_strings(docs, width, id_col=id_col, **options)
    digest = removed.select(
        "h", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
    none = F.lit(0).cast("long")
    return names.join(digest, "h", "left").select(
        id_col, "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("h"))).alias("kept_sha256"),
    )
