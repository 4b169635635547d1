"""Token ids of whole texts by the ``tokenizers`` library, remembered by chunk.

Byte-level BPE never merges across the pre-tokens of its split pattern,
and a single space between two non-space characters always starts a
pre-token (`` ?\\p{L}+`` and its siblings take one space in front, no
pattern takes one behind).  So the ids of a text are the ids of its
space-separated chunks, and each distinct chunk is encoded once per
worker.  Texts with other white space at a chunk's edge are cut only at
the spaces for which this holds.  The memory has two generations: a full
one becomes the older, and chunks met again come back from it, so the many
chunks that occur once do not push out those that recur.  Added tokens (``<|endoftext|>``) have
their own ids, as in the library: texts are cut at them first.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import filterfalse

import numpy as np

#: Chunks in a generation of a worker's memory, of which it has two (about 200 bytes each).
GENERATION = 350_000
#: Chunks encoded by one call.
JOINED = 2_000

_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_loaded: dict[str, "ChunkEncoder"] = {}


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Encodes whole texts; ``add_special_tokens=False``, as the library does."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("the memo packs ids into 16 bits")
        #: chunk -> ids as little-endian uint16 bytes, with and without a space in front.
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.older_spaced: dict[str, bytes] = {}
        self.older_bare: dict[str, bytes] = {}
        self.marks = {c: self._ids(c) for c in ".,\n"}
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: array("H", [k]).tobytes() for k, t in added.items()}
        self.added_cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")")
        #: Added tokens that take nothing from their surroundings: a text may be cut at them.
        self.added_plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized and self.tokenizer.normalizer for t in added.values())
        #: The byte alphabet of byte-level BPE: printable bytes stand for themselves, the rest follow from U+0100.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in own]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(moved)}

    def _ids(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, chunks: set[str], memo: dict[str, bytes], lead: str) -> None:
        """Fill ``memo`` for ``chunks`` without white space at their edges."""
        plain: set[str] = set()
        stopped: list[str] = []
        broken: list[tuple[str, str, str]] = []
        odd: list[str] = []
        bare: set[str] = set()
        for c in chunks:
            if "\n" in c:
                left, right = c.split("\n", 1)
                if left[-1].isspace() or right[0].isspace():
                    odd.append(c)
                else:
                    broken.append((c, left, right))
                    bare.add(right)
                    if left not in memo:
                        plain.add(left)
            elif c[-1] in ".," and c[-2:-1].isalpha():
                stopped.append(c)
                if c[:-1] not in memo:
                    plain.add(c[:-1])
            else:
                plain.add(c)
        # A chunk of letters is one pre-token: straight to the merges, in the byte alphabet.
        letters = [c for c in plain if c.isalpha()]
        merge = self.tokenizer.model.tokenize
        mark = self.alphabet[32] if lead else ""
        for c in letters:
            mapped = c if c.isascii() else c.encode().decode("latin-1").translate(self.alphabet)
            memo[c] = array("H", [t.id for t in merge(mark + mapped)]).tobytes()
        rest = list(plain.difference(letters))
        for k in range(0, len(rest), JOINED):
            part = rest[k : k + JOINED]
            done = self.tokenizer.encode_batch_fast([lead + c for c in part], add_special_tokens=False)
            memo.update(zip(part, [array("H", e.ids).tobytes() for e in done]))
        for c in stopped:
            memo[c] = memo[c[:-1]] + self.marks[c[-1]]
        for c in odd:
            memo[c] = self._ids(lead + c)
        if broken:
            self._know(bare, self.bare, "")
            for c, left, right in broken:
                memo[c] = memo[left] + self.marks["\n"] + self.bare[right]

    def _know(self, chunks: set[str], memo: dict[str, bytes], lead: str) -> None:
        """Fill ``memo`` for ``chunks``, from the older generation where it has them."""
        older = self.older_spaced if lead else self.older_bare
        missing = set(filterfalse(memo.__contains__, chunks))
        back = [c for c in missing if c in older]
        memo.update(zip(back, map(older.__getitem__, back)))
        missing.difference_update(back)
        if missing:
            self._learn(missing, memo, lead)

    def _turn(self) -> None:
        """Full generations become the older ones."""
        if len(self.spaced) > GENERATION:
            self.older_spaced, self.spaced = self.spaced, {}
        if len(self.bare) > GENERATION:
            self.older_bare, self.bare = self.bare, {}

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint16 ids of each whole text; null is the empty text."""
        special = [n for n, t in enumerate(texts) if t and any(c in t for c in self.added)]
        if not special:
            return self._encode_ordinary(texts)
        cut = dict.fromkeys(special) if not self.added_plain else {n: self.added_cut.split(texts[n]) for n in special}
        ordinary = [[t] if n not in cut else [] if cut[n] is None else cut[n][::2] for n, t in enumerate(texts)]
        ids = iter(self._encode_ordinary([t for parts in ordinary for t in parts]))
        out = []
        for n, parts in enumerate(ordinary):
            if n in cut and cut[n] is None:
                out.append(np.frombuffer(self._ids(texts[n]), dtype="<u2"))
                continue
            pieces = [next(ids) for _ in parts]
            if n in cut:
                marks = [np.frombuffer(self.added[c], dtype="<u2") for c in cut[n][1::2]]
                pieces = [x for pair in zip(pieces, marks) for x in pair] + pieces[-1:]
            out.append(np.concatenate(pieces) if len(pieces) > 1 else pieces[0])
        return out

    def _encode_ordinary(self, texts: list[str | None]) -> list[np.ndarray]:
        """``encode_many`` of texts without added tokens."""
        self._turn()
        split = [t.split(" ") if t else None for t in texts]
        missing: set[str] = set()
        first: set[str] = set()
        known = self.spaced.__contains__
        for p in split:
            if p is not None:
                missing.update(filterfalse(known, p[1:]))
                first.add(p[0])
        bad = {c for c in missing | first if not c or c[0].isspace() or c[-1].isspace()}
        if bad:
            for n, p in enumerate(split):
                if p is not None and not bad.isdisjoint(p):
                    split[n] = [texts[n]]  # encoded below in safe cuts
            missing -= bad
            first -= bad
        self._know(first, self.bare, "")
        self._know(missing, self.spaced, " ")
        out = []
        get, bare = self.spaced.__getitem__, self.bare
        for t, p in zip(texts, split):
            if p is None:
                packed = b""
            elif p[0] not in bare:
                packed = b"".join(map(self._ids, _SAFE_CUT.split(t)))
            else:
                packed = bare[p[0]] + b"".join(map(get, p[1:]))
            out.append(np.frombuffer(packed, dtype="<u2"))
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text])[0]


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for this tokenizer file."""
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]
