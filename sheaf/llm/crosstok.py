"""Cross-tokenizer alignment with an identity-map fast path.

Two tokenizers (A: byte-level BPE, B: sentencepiece BPE) cut the same bytes
``space + text``.  Byte offsets where tokens of both end cut the tokens into
groups; the A token and the B token that end there are a *link*.

``identity_map`` is computed once from the two vocabularies: the B id with
the same bytes as an A id.  A group of one A token and one B token is such a
pair, so it is kept and counted as its A id alone, in a vector as long as
A's vocabulary; only the links of the other groups are counted as pairs.

Linked tokens end together, so one's bytes are a suffix of the other's.
The table of all pair counts is therefore bounded by the vocabularies,
whatever the corpus: at most the bytes of all entries of A, times the B ids
that share their bytes, and the reverse (``max_pairs``, about a million for
the vocabularies here).  This is the bound behind its broadcast.

Neither tokenizer merges over a single space between two non-space
characters (A's pattern starts a pre-token there, no piece of B has a space
behind another character), so texts are cut there, and each distinct chunk
is tokenised and aligned once per worker.

Rows: null and empty texts, and texts whose tokens do not give back their
bytes (U+2581 in the text), have no tokens: zeros and an empty ``groups``.
Repeated rows and ids are rows of their own; every step is row by row, so
no id is a key.  Other columns than the id and the text are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain, filterfalse
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.llm.common import write_scratch
from sheaf.llm.tokens import default_tokenizer_path

#: Chunks remembered per worker before the memory starts anew (about 400 bytes each).
MAX_MEMO = 250_000
#: Bytes of text handled at a time.
SLICE_BYTES = 2 << 20
#: Distinct pairs a task holds before it hands them on.
MAX_HELD = 1 << 20

_CUT = re.compile(r"(?<=\S)(?= \S)")
_loaded: dict[tuple[str, str], "Aligner"] = {}


def default_piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's letters: printable bytes stand for themselves, the rest follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(moved)}


class Chunk(NamedTuple):
    """The alignment of one chunk."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    same: bytes
    pairs: bytes


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_alphabet()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, k in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[k] = bytes(map(letters.__getitem__, token)) if known else token.encode()
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.identity = self.identity_map()
        self.known = [f"{k}|{x}" for k, x in enumerate(self.identity.tolist())]
        #: A piece of B with a space behind another character would forbid cutting texts at spaces.
        self.cuts = not any(b" " in x.lstrip(b" ") for x in self.b_bytes)
        #: Marks that are a token of their own behind a letter, in both: letters and a mark need only the letters tokenised.
        self.marks = {m: self._mark(m) for m in ".," if self._stands_alone(m)}
        self.memo: dict[str, Chunk | None] = {}
        self.odd: dict[str, Chunk | None] = {}

    def identity_map(self) -> np.ndarray:
        """B id with the same bytes for each A id, -1 where there is none (a whole piece before a byte piece)."""
        by_bytes: dict[bytes, int] = {}
        for k in sorted(range(len(self.b_bytes)), key=lambda k: (self.b.is_byte(k), k)):
            if not (self.b.is_control(k) or self.b.is_unknown(k)):
                by_bytes.setdefault(self.b_bytes[k], k)
        return np.array([by_bytes.get(x, -1) if x else -1 for x in self.a_bytes], dtype=np.int64)

    def _stands_alone(self, mark: str) -> bool:
        a, pieces = self.a.token_to_id(mark), [x.decode("utf-8", "ignore") for x in self.b_bytes]
        joined = any(mark in p[1:] and p[p.index(mark, 1) - 1].isalpha() for p in pieces)
        return a is not None and self.identity[a] >= 0 and self.cuts and not joined and len(self.a.encode("a" + mark).ids) == 2

    def _mark(self, mark: str) -> Chunk:
        a = self.a.token_to_id(mark)
        return Chunk(1, 1, 1, self.known[a], np.array([a], dtype="<u4").tobytes(), b"")

    def max_pairs(self) -> int:
        """Bound of the distinct linked pairs: one token's bytes are a suffix of the other's."""
        times: dict[bytes, int] = {}
        for x in self.b_bytes:
            times[x] = times.get(x, 0) + 1
        shared = max(times.values())
        return int(self.a_len.sum()) * shared + int(self.b_len.sum())

    def _learn(self, chunks: list[str], memo: dict[str, Chunk | None]) -> None:
        """Align ``chunks`` (each without the one space in front of it)."""
        a_ids = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        b_ids = self.b.encode(chunks, num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        raw = [b" " + c.encode() for c in chunks]
        if any(b"\xe2\x96\x81" in r for r in raw) or not (
            b"".join(map(a_bytes, chain.from_iterable(a_ids))) == b"".join(raw) == b"".join(map(b_bytes, chain.from_iterable(b_ids)))
        ):
            right = []
            for n, r in enumerate(raw):
                if b"".join(map(a_bytes, a_ids[n])) == r and b"".join(map(b_bytes, b_ids[n])) == r:
                    right.append(n)
                else:
                    memo[chunks[n]] = None
            chunks, a_ids, b_ids, raw = ([x[n] for n in right] for x in (chunks, a_ids, b_ids, raw))
        if not chunks:
            return
        # all chunks in one stream of bytes: a chunk's end is an end of both
        a = np.fromiter(chain.from_iterable(a_ids), dtype=np.int64)
        b = np.fromiter(chain.from_iterable(b_ids), dtype=np.int64)
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        last_a = np.flatnonzero(np.isin(a_end, b_end, assume_unique=True))
        last_b = np.searchsorted(b_end, a_end[last_a])
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        link_a, link_b = a[last_a], b[last_b]
        same = (n_a == 1) & (n_b == 1) & (self.identity[link_a] == link_b)
        listed_a, listed_b, known = list(map(str, a.tolist())), list(map(str, b.tolist())), self.known
        names = [
            known[k] if fast else ",".join(listed_a[i - p + 1 : i + 1]) + "|" + ",".join(listed_b[j - q + 1 : j + 1])
            for fast, k, i, j, p, q in zip(*(x.tolist() for x in (same, link_a, last_a, last_b, n_a, n_b)))
        ]
        fast_ids, pair_ids = link_a[same].astype("<u4").tobytes(), ((link_a << 32) | link_b)[~same].astype("<u8").tobytes()
        ends = np.searchsorted(a_end[last_a], np.fromiter(accumulate(map(len, raw)), dtype=np.int64)) + 1
        fast_ends = np.concatenate([[0], np.cumsum(same)])[ends].tolist()
        at = fast_at = 0
        for c, x, y, end, fast_end in zip(chunks, a_ids, b_ids, ends.tolist(), fast_ends):
            memo[c] = Chunk(
                len(x), len(y), end - at, ";".join(names[at:end]),
                fast_ids[4 * fast_at : 4 * fast_end], pair_ids[8 * (at - fast_at) : 8 * (end - fast_end)],
            )
            at, fast_at = end, fast_end

    def _know(self, chunks: set[str], memo: dict[str, Chunk | None]) -> None:
        missing = list(filterfalse(memo.__contains__, chunks))
        marked = [c for c in missing if c[-1] in self.marks and c[:-1].isalpha()]
        if marked:
            missing = list(set(missing).difference(marked).union(filterfalse(memo.__contains__, (c[:-1] for c in marked))))
        for k in range(0, len(missing), 4_000):
            self._learn(missing[k : k + 4_000], memo)
        for c in marked:
            x, m = memo[c[:-1]], self.marks[c[-1]]
            memo[c] = x and Chunk(x[0] + m[0], x[1] + m[1], x[2] + m[2], x[3] + ";" + m[3], x[4] + m[4], x[5] + m[5])

    def forget(self) -> None:
        """Give the memory back: an idle worker would hold it beside the tasks of later stages."""
        self.memo, self.odd = {}, {}

    def align(self, texts: list[str | None]) -> list[list[Chunk] | None]:
        """The chunks of each whole text; None where the text has no tokens."""
        for memo in (self.memo, self.odd):
            if len(memo) > MAX_MEMO:
                memo.clear()
        parts = [t.split(" ") if t and self.cuts else [] for t in texts]
        seen = set().union(*parts)
        edged = {c for c in seen if not c or c[0].isspace() or c[-1].isspace()}
        self._know(seen - edged, self.memo)
        # a space beside other white space is no cut: such texts are cut at the safe ones only
        odd = [n for n, t in enumerate(texts) if t and (not self.cuts or not edged.isdisjoint(parts[n]))]
        for n in odd:
            parts[n] = [c[1:] for c in _CUT.split(" " + texts[n])] if self.cuts else [texts[n]]
        self._know(set().union(*(parts[n] for n in odd)), self.odd)
        strange = set(odd)
        out: list[list[Chunk] | None] = []
        for n, p in enumerate(parts):
            found = list(map((self.odd if n in strange else self.memo).__getitem__, p))
            out.append(None if not found or None in found else found)
        return out


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner for these files."""
    key = (a_path, b_path)
    if key not in _loaded:
        _loaded[key] = Aligner(*key)
    return _loaded[key]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``SLICE_BYTES``."""
    start = held = 0
    for n, t in enumerate(texts):
        held += len(t) if t else 0
        if held >= SLICE_BYTES:
            yield start, n + 1
            start, held = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, groups, same, pairs) of each whole text.

    ``groups``: ``a1,a2|b1;a3|b2`` in order.  ``same``: the A ids (uint32) of
    the groups that are pairs of the identity map; ``pairs``: A id * 2^32 +
    B id (uint64) of the links of all other groups, both sorted.
    """
    a_path, b_path = a_path or default_tokenizer_path(), b_path or default_piece_path()

    def aligned(work: Aligner, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, end in slices(texts):
                cols: list[list] = [[], [], [], [], [], []]
                for chunks in work.align(texts[start:end]):
                    if chunks is None:
                        row = (0, 0, 0, "", b"", b"")
                    else:
                        same = np.frombuffer(b"".join([c.same for c in chunks]), dtype="<u4")
                        pairs = np.frombuffer(b"".join([c.pairs for c in chunks]), dtype="<u8")
                        row = (
                            sum([c.n_a for c in chunks]), sum([c.n_b for c in chunks]), sum([c.n_groups for c in chunks]),
                            ";".join([c.groups for c in chunks]), np.sort(same).tobytes(), np.sort(pairs).tobytes(),
                        )
                    for col, value in zip(cols, row):
                        col.append(value)
                kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), *(pa.array(c, kind) for c, kind in zip(cols, kinds))],
                    names=["id", "n_a", "n_b", "n_groups", "groups", "same", "pairs"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        try:
            yield from aligned(work, batches)
        finally:
            work.forget()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType),
        *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")),
        T.StructField("groups", T.StringType()), T.StructField("same", T.BinaryType()), T.StructField("pairs", T.BinaryType()),
    ])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def link_counts(aligned: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(a, b, n): how many links of all documents hold a pair.

    Each task counts its identity groups in one vector over A's ids and
    its other links as distinct pairs; only these partial counts are shuffled.
    """
    a_path, b_path = a_path or default_tokenizer_path(), b_path or default_piece_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = aligner(a_path, b_path).identity
        vector = np.zeros(len(identity), dtype=np.int64)
        codes, times = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, n)], names=["a", "b", "n"])

        for batch in batches:
            same = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u4")
            vector += np.bincount(same, minlength=len(vector))
            more, n = np.unique(np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u8"), return_counts=True)
            merged, place = np.unique(np.concatenate([codes, more]), return_inverse=True)
            times = np.bincount(place, weights=np.concatenate([times, n]), minlength=len(merged)).astype(np.int64)
            codes = merged
            if len(codes) > MAX_HELD:
                yield rows(codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF), times)
                codes, times = codes[:0], times[:0]
        yield rows(codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF), times)
        found = np.flatnonzero(vector)
        yield rows(found, identity[found], vector[found])

    return aligned.select("same", "pairs").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def with_best_links(aligned: DataFrame, counts: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` (links whose count is their B id's
    highest, ties included) and ``count_sum``; ``same`` and ``pairs`` go.

    ``counts`` is bounded by the vocabularies (see the module) and is sent to
    the tasks as arrays.
    """
    a_path, b_path = a_path or default_tokenizer_path(), b_path or default_piece_path()
    known = aligner(a_path, b_path)
    table = counts.toArrow()
    if table.num_rows > known.max_pairs():
        raise ValueError("more pairs than the vocabularies allow")
    a, b, n = (table.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    top = np.zeros(len(known.b_bytes), dtype=np.int64)
    np.maximum.at(top, b, n)
    code = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    order = np.argsort(code)
    fast = np.zeros(len(known.a_bytes), dtype=np.int64)
    fast_best = np.zeros(len(known.a_bytes), dtype=np.int64)
    is_fast = known.identity[a] == b
    fast[a[is_fast]], fast_best[a[is_fast]] = n[is_fast], n[is_fast] == top[b[is_fast]]
    shipped = aligned.sparkSession.sparkContext.broadcast((fast, fast_best, code[order], n[order], (n == top[b])[order].astype(np.int64)))
    kept = [c for c in aligned.columns if c not in ("same", "pairs")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast, fast_best, code, n, best = shipped.value
        for batch in batches:
            out: list[list[int]] = [[], [], []]
            for same, pairs in zip(batch.column("same").to_pylist(), batch.column("pairs").to_pylist()):
                x = np.frombuffer(same, dtype="<u4")
                y = np.searchsorted(code, np.frombuffer(pairs, dtype="<u8"))
                out[0].append(len(x) + len(y))
                out[1].append(int(fast_best[x].sum() + best[y].sum()))
                out[2].append(int(fast[x].sum() + n[y].sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(x, pa.int64()) for x in out)], names=[*kept, "n_links", "n_best", "count_sum"]
            )

    fields = [aligned.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]
    return aligned.mapInArrow(run, T.StructType(fields))


def alignment_report(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum.

    The alignments are made once and written, without the groups' text, to
    the shared folder; counting and the lookup of the counts read that table.
    """
    aligned = align_documents(docs, a_path, b_path, id_col, text_col)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = write_scratch(aligned.withColumn("groups_sha256", digest).drop("groups"), "alignments")
    return with_best_links(aligned, link_counts(aligned, a_path, b_path), a_path, b_path)
