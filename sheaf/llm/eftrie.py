"""Language-model scores from sharded Elias-Fano tries of order two.

A map task turns a batch of whole texts into local word numbers and cuts
the batch's distinct bigrams, with training counts, into one compressed
packet per shard of the context word.  A shard merges its packets into a
trie: level one holds the 64-bit word hashes, level two every successor as
a 32-bit hash relative to its context's rank; both are monotone and lie in
Elias-Fano form, as do the pointers from contexts into level two.  Counts
are kept exact for words, and for bigrams as quantised logarithms.  The
levels are laid out in one byte string, memory-mapped and searched by
successor: each packet comes back as one byte per bigram plus the word
counts.  Batches then score their own documents, with

    P(w|u) = (c(u,w) + K p(w)) / (c(u) + K),  p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).

No model, vocabulary or n-gram set is ever whole in one place.  Contexts
that a sample of texts shows to be frequent are dealt over several shards
by their successors; that only moves them.

Defined results: null and empty texts are the end token alone; null ids
count as training texts; repeated rows count each time; with no training
tokens scores are those of the smoothing alone; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import write_scratch

#: Text bytes of a batch and shuffled packet bytes a shard aims at.
BATCH_BYTES = 8_000_000
SHARD_BYTES = 16_000_000
#: Weight of the unigram estimate, in tokens.
PRIOR = 40.0
#: Quantised logarithm: steps per octave; 0 stands for an absent bigram.
STEPS_PER_OCTAVE = 6
#: Documents looked at to find frequent contexts.
SAMPLE_DOCS = 2_000
END = xxhash.xxh3_64_intdigest(b" end")  # no word holds a space


# ------------------------------------------------------------- Elias-Fano
class EliasFano:
    """A non-decreasing uint64 sequence: packed low bits, unary high bits."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs = n, low_bits, lows, highs
        at = np.flatnonzero(np.unpackbits(highs, count=None, bitorder="little"))[:n]
        high = at - np.arange(len(at))
        # elements before each high part: the zeros' ranks
        self.before = np.concatenate([[0], np.cumsum(np.bincount(high, minlength=1))]) if n else np.zeros(2, np.int64)
        self.high = high.astype(np.uint64)

    @staticmethod
    def build(values: np.ndarray, universe_bits: int) -> bytes:
        n = len(values)
        low = max(0, universe_bits - max(1, int(n).bit_length() - 1))
        high = (values >> np.uint64(low)).astype(np.int64) if low < 64 else np.zeros(n, np.int64)
        bits = np.zeros((int(high[-1]) + n + 1) if n else 1, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        highs = np.packbits(bits, bitorder="little")
        lows = np.zeros(n * low // 64 + 2, dtype=np.uint64)
        if low:
            part = values & np.uint64((1 << low) - 1)
            bit = np.arange(n, dtype=np.uint64) * np.uint64(low)
            word, off = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            np.bitwise_or.at(lows, word, part << off)
            spill = np.where(off == 0, np.uint64(0), part >> ((np.uint64(64) - off) & np.uint64(63)))
            np.bitwise_or.at(lows, word + 1, spill)
        head = np.array([n, low, len(lows), len(highs)], dtype="<u8")
        pad = b"\0" * (-len(highs) % 8)
        return head.tobytes() + lows.tobytes() + highs.tobytes() + pad

    @staticmethod
    def view(buffer, at: int) -> tuple["EliasFano", int]:
        """The sequence that starts at byte ``at`` of a buffer, without copying, and its end."""
        n, low, n_lows, n_highs = (int(v) for v in np.frombuffer(buffer, "<u8", 4, at))
        lows = np.frombuffer(buffer, "<u8", n_lows, at + 32)
        highs = np.frombuffer(buffer, np.uint8, n_highs, at + 32 + 8 * n_lows)
        return EliasFano(n, low, lows, highs), at + 32 + 8 * n_lows + n_highs + (-n_highs % 8)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, off = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        rest = np.where(off == 0, np.uint64(0), self.lows[word + 1] << ((np.uint64(64) - off) & np.uint64(63)))
        return ((self.lows[word] >> off) | rest) & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        return (self.high[i] << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element >= x; n if there is none."""
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        low = x & np.uint64((1 << self.low_bits) - 1)
        top = len(self.before) - 1
        lo, hi = self.before[np.minimum(h, top)], self.before[np.minimum(h + 1, top)]
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            less = open_ & (self._low(np.minimum(mid, self.n - 1)) < low)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)


class Trie:
    """Two levels over a buffer: words, pointers, successors, counts."""

    def __init__(self, buffer):
        self.words, at = EliasFano.view(buffer, 0)
        self.pointers, at = EliasFano.view(buffer, at)
        self.successors, at = EliasFano.view(buffer, at)
        self.counts = np.frombuffer(buffer, "<u8", self.words.n, at)
        self.logs = np.frombuffer(buffer, np.uint8, self.successors.n, at + 8 * self.words.n)

    @staticmethod
    def build(words: np.ndarray, counts: np.ndarray, context: np.ndarray, follower: np.ndarray, pair_counts: np.ndarray) -> bytes:
        """From distinct sorted words with counts and distinct (context rank, follower) pairs in order."""
        pointers = np.searchsorted(context, np.arange(len(words) + 1)).astype(np.uint64)
        rank_bits = max(1, len(words).bit_length())
        relative = (context.astype(np.uint64) << np.uint64(32)) | follower.astype(np.uint64)
        parts = [
            EliasFano.build(words, 64),
            EliasFano.build(pointers, max(1, int(pointers[-1]).bit_length())),
            EliasFano.build(relative, rank_bits + 32),
            counts.astype("<u8").tobytes(),
            quantise(pair_counts).tobytes(),
        ]
        return b"".join(parts)

    def word(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, found) of each word."""
        if not self.words.n:
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        rank = self.words.successor(hashes)
        safe = np.minimum(rank, self.words.n - 1)
        return safe, (rank < self.words.n) & (self.words.access(safe) == hashes)

    def pair(self, rank: np.ndarray, found: np.ndarray, follower: np.ndarray) -> np.ndarray:
        """Quantised logarithm of each pair's count; 0 if absent."""
        if not self.successors.n:
            return np.zeros(len(rank), np.uint8)
        key = (rank.astype(np.uint64) << np.uint64(32)) | follower.astype(np.uint64)
        i = self.successors.successor(key)
        inside = found & (i >= self.pointers.access(rank).astype(np.int64)) & (i < self.pointers.access(rank + 1).astype(np.int64))
        safe = np.minimum(i, self.successors.n - 1)
        hit = inside & (self.successors.access(safe) == key)
        return np.where(hit, self.logs[safe], 0).astype(np.uint8)


def quantise(counts: np.ndarray) -> np.ndarray:
    logs = np.round(np.log2(np.maximum(counts, 1)) * STEPS_PER_OCTAVE) + 1
    return np.where(counts > 0, np.minimum(logs, 255), 0).astype(np.uint8)


def restored(logs: np.ndarray) -> np.ndarray:
    return np.where(logs > 0, 2.0 ** ((logs.astype(np.float64) - 1) / STEPS_PER_OCTAVE), 0.0)


# ------------------------------------------------------------ batches, packets
def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[len(a) for a in arrays]], dtype="<u8").tobytes()
    return zstandard.ZstdCompressor(level=9).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, "<u8", len(kinds) + 1)[1:]
    out, at = [], 8 * (len(kinds) + 1)
    for kind, n in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _shard_of(context: np.ndarray, follower: np.ndarray, shards: int, spread: dict[int, int]) -> np.ndarray:
    """Shard of each pair; frequent contexts take ``spread`` shards in a row by follower."""
    shard = (context >> np.uint64(20)) % np.uint64(shards)
    if spread:
        hot = np.array(sorted(spread), dtype=np.uint64)
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        wide = np.where(hot[at] == context, np.array([spread[int(h)] for h in hot], dtype=np.uint64)[at], np.uint64(1))
        shard = (shard + follower.astype(np.uint64) % wide) % np.uint64(shards)
    return shard.astype(np.int64)


_ROW = pa.schema([("kind", pa.string()), ("batch", pa.int64()), ("shard", pa.int32()), ("data", pa.binary()),
                  ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])
_ROW_SQL = "kind string, batch bigint, shard int, data binary, doc_ids array<bigint>, held array<boolean>"


def _release() -> None:
    """Give freed memory back: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    if libc and hasattr(trim := ctypes.CDLL(libc), "malloc_trim"):
        trim.malloc_trim(0)


def _batch_rows(batch: int, docs: list, held: list[bool], number: dict[bytes, int], parts: list[np.ndarray], shards: int, spread: dict[int, int]) -> Iterator[pa.RecordBatch]:
    lens = np.array([len(p) for p in parts], dtype="<u4")
    ids = np.concatenate(parts)
    hashes = np.array([END, *[xxhash.xxh3_64_intdigest(x) for x in list(number)[1:]]], dtype=np.uint64)
    number.clear()
    train = np.repeat(~np.array(held, dtype=bool), lens)
    counts = np.bincount(ids[train], minlength=len(hashes)).astype("<u4")
    previous = np.concatenate([[0], ids[:-1]]).astype(np.uint64)  # a text starts after an end token
    keys, place, = np.unique((previous << np.uint64(32)) | ids, return_inverse=True)
    pair_counts = np.bincount(place[train], minlength=len(keys)).astype("<u4")
    context, follower = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    short = (hashes & np.uint64(0xFFFFFFFF)).astype("<u4")
    shard = _shard_of(hashes[context], short[follower], shards, spread)
    home = _shard_of(hashes, np.zeros(len(hashes), np.uint32), shards, {})
    rows = [{"kind": "program", "batch": batch, "shard": -1, "doc_ids": docs, "held": held,
             "data": _pack(lens, ids, context.astype("<u4"), follower.astype("<u4"), shard.astype("<u4"), home.astype("<u4"))}]
    by_shard, by_home = np.argsort(shard, kind="stable"), np.argsort(home, kind="stable")
    cut = np.searchsorted(shard[by_shard], np.arange(shards + 1))
    cut_home = np.searchsorted(home[by_home], np.arange(shards + 1))
    for s in range(shards):
        p, w = by_shard[cut[s] : cut[s + 1]], by_home[cut_home[s] : cut_home[s + 1]]
        if len(p) or len(w):
            # pairs lie by context number: contexts once, with their runs
            c, runs = np.unique(context[p], return_counts=True)
            rows.append({"kind": "packet", "batch": batch, "shard": s, "doc_ids": None, "held": None,
                         "data": _pack(hashes[w], counts[w], hashes[c], runs.astype("<u4"), short[follower[p]], pair_counts[p])})
    yield pa.RecordBatch.from_pylist(rows, schema=_ROW)


_PACKET = ("<u8", "<u4", "<u8", "<u4", "<u4", "<u4")


def _batches(records: Iterator[pa.RecordBatch], shards: int, spread: dict[int, int]) -> Iterator[pa.RecordBatch]:
    batch = TaskContext.get().partitionId() << 24
    docs: list = []
    held: list[bool] = []
    number: dict[bytes, int] = {b" end": 0}
    parts: list[np.ndarray] = []
    size = 0
    for record in records:
        ids, out, text = (record.column(c) for c in ("doc_id", "held", "text"))
        for k in range(record.num_rows):
            raw = (text[k].as_py() or "").encode("utf-8", "surrogatepass")
            docs.append(ids[k].as_py())
            held.append(out[k].as_py())
            # new words take the next number; the end token is number 0
            parts.append(np.array([number.setdefault(w, len(number)) for w in raw.lower().split()] + [0], dtype="<u4"))
            size += len(raw)
            if size >= BATCH_BYTES:
                yield from _batch_rows(batch, docs, held, number, parts, shards, spread)
                docs, held, number, parts, size, batch = [], [], {b" end": 0}, [], 0, batch + 1
                _release()
    if docs:
        yield from _batch_rows(batch, docs, held, number, parts, shards, spread)
    del docs, held, number, parts
    _release()


# ------------------------------------------------------------------ shards
def merge_packets(packets: list[list[np.ndarray]]) -> bytes:
    """The trie of a shard from its packets' training counts."""
    words = np.concatenate([np.concatenate([p[0], p[2]]) for p in packets])
    counts = np.concatenate([np.concatenate([p[1].astype(np.int64), np.zeros(len(p[2]), np.int64)]) for p in packets])
    # Words with a training count here and contexts with a counted successor here.
    context = np.concatenate([np.repeat(p[2], p[3]) for p in packets])
    follower = np.concatenate([p[4] for p in packets])
    pairs = np.concatenate([p[5].astype(np.int64) for p in packets])
    seen = pairs > 0
    context, follower, pairs = context[seen], follower[seen], pairs[seen]
    keep = counts > 0
    names = np.unique(np.concatenate([words[keep], context]))
    total = np.zeros(len(names), dtype=np.int64)
    np.add.at(total, np.searchsorted(names, words[keep]), counts[keep])
    rank = np.searchsorted(names, context).astype(np.uint64)
    keys, place = np.unique((rank << np.uint64(32)) | follower, return_inverse=True)
    merged = np.zeros(len(keys), dtype=np.int64)
    np.add.at(merged, place, pairs)
    return Trie.build(names, total, (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(0xFFFFFFFF), merged)


def _mapped(blob: bytes):
    """The bytes as a private memory-mapped scratch file that is gone with the task."""
    file = tempfile.TemporaryFile()
    file.write(blob)
    file.flush()
    return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def _answer_shard(frame: pd.DataFrame) -> pd.DataFrame:
    packets = [_unpack(d, *_PACKET) for d in frame["data"]]
    trie = Trie(_mapped(merge_packets(packets)))
    rows = [(-1, int(frame["shard"].iloc[0]), b"", int((trie.counts > 0).sum()), int(trie.counts.sum()))]
    for batch, (own, _, context, runs, follower, _) in zip(frame["batch"], packets):
        at, found = trie.word(own)
        word_counts = np.where(found, trie.counts[at] if len(trie.counts) else 0, 0).astype("<u8")
        at, found = trie.word(context)
        logs = trie.pair(np.repeat(at, runs), np.repeat(found, runs), follower)
        rows.append((int(batch), int(frame["shard"].iloc[0]), _pack(word_counts, logs), 0, 0))
    del packets, trie
    _release()
    return pd.DataFrame(rows, columns=["batch", "shard", "data", "v", "n"])


def _score_batch(n: int, v: int):
    def run(key: tuple, program: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = program.iloc[0]
        lens, ids, context, follower, shard, home = _unpack(row["data"], *["<u4"] * 6)
        counts = np.zeros(len(home), dtype=np.int64)
        logs = np.zeros(len(context), dtype=np.uint8)
        by_shard, by_home = np.argsort(shard, kind="stable"), np.argsort(home, kind="stable")
        top = int(max(shard.max(initial=0), home.max(initial=0))) + 2
        cut = np.searchsorted(shard[by_shard], np.arange(top))
        cut_home = np.searchsorted(home[by_home], np.arange(top))
        for s, data in zip(answers["shard"], answers["data"]):
            word_counts, got = _unpack(data, "<u8", "u1")
            counts[by_home[cut_home[s] : cut_home[s + 1]]] = word_counts
            logs[by_shard[cut[s] : cut[s + 1]]] = got
        p = (counts + 0.1) / (n + 0.1 * (v + 1))
        base = np.log10(p)
        # pairs are sorted by (context, follower) number, as the tokens' keys are searched
        pair = np.log10((restored(logs) + PRIOR * p[follower]) / (counts[context] + PRIOR))
        keys = (context.astype(np.uint64) << np.uint64(32)) | follower
        previous = np.concatenate([[0], ids[:-1]]).astype(np.uint64)
        where = np.searchsorted(keys, (previous << np.uint64(32)) | ids)
        starts = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)[:-1]])
        return pd.DataFrame({
            "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"),
            "held_out": list(row["held"]),
            "n_tokens": lens.astype(np.int64),
            "n_known": np.add.reduceat((counts[ids] > 0).astype(np.int64), starts),
            "train_tokens": np.full(len(lens), n, dtype=np.int64),
            "base_score": np.add.reduceat(base[ids], starts),
            "score": np.add.reduceat(pair[where], starts),
        })

    return run


# ---------------------------------------------------------------- operator
def frequent_contexts(docs: DataFrame, shards: int) -> dict[int, int]:
    """Word hash -> shards to spread over, from a sample of whole texts.  At most 4 * shards entries."""
    n = docs.count()
    if shards == 1 or not n:
        return {}
    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(min(1.0, SAMPLE_DOCS / n) * 1_000_000)))
    words = part.select(F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("w")).where("w <> ''")
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("c"))
    total = counts.agg(F.sum("c")).first()[0] or 0
    hot = counts.where(F.col("c") * 4 * shards > F.lit(total)).collect()
    return {xxhash.xxh3_64_intdigest(r.w.encode()): min(shards, -(-r.c * 4 * shards // total)) for r in hot}


def score_documents(docs: DataFrame, held_out, shards: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); ``held_out`` is a
    boolean column, true (or null: false) for texts that are not learned from."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-size // SHARD_BYTES))
    spread = frequent_contexts(docs, shards)
    table = docs.mapInArrow(lambda it: _batches(it, shards, spread), _ROW_SQL)
    # Parquet need not compress again what is compressed
    table = write_scratch(table, "lm-batches", compression="none")
    packets = table.where("kind = 'packet'").select("batch", "shard", "data")
    answers = write_scratch(
        packets.groupBy("shard").applyInPandas(_answer_shard, "batch bigint, shard int, data binary, v bigint, n bigint"),
        "lm-answers", compression="none",
    )
    totals = answers.where("batch < 0").agg(F.sum("n"), F.sum("v")).first()
    n, v = totals[0] or 0, totals[1] or 0
    programs = table.where("kind = 'program'").select("batch", "data", "doc_ids", "held")
    back = answers.where("batch >= 0").select("batch", "shard", "data")
    return programs.groupBy("batch").cogroup(back.groupBy("batch")).applyInPandas(
        _score_batch(n, v),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
