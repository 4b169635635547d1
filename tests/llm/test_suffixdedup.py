"""op12: induced suffix sorting and removal of repeated strings, against brute force."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from sheaf.llm import induced, suffixdedup
from sheaf.llm.common import reach_workers


def samples(rng):
    letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256)), b"\x00\x01\xff"])
    out = [bytes(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 30, 60]))) for _ in range(rng.randint(1, 6))]
    if rng.random() < 0.5:
        out += [out[0][3:] + out[-1], b"ab" * rng.randint(1, 50), b"a" * rng.randint(1, 80), bytes(range(100)) * 2, bytes(range(100, 0, -1)) * 2]
    return out


@pytest.mark.parametrize("spill", [False, True])
def test_suffix_order(tmp_path, spill):
    rng = random.Random(1)
    for _ in range(60):
        pieces = samples(rng)
        limit, folder = (rng.choice([40, 100]), str(tmp_path)) if spill else (1 << 22, None)
        places, common = induced.suffix_order(pieces, limit=limit, folder=folder)
        starts = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        suffix = {int(s) + k: p[k:] for s, p in zip(starts, pieces) for k in range(len(p))}
        assert sorted(places.tolist()) == sorted(suffix)
        ordered = [suffix[k] for k in places.tolist()]
        assert ordered == sorted(suffix.values())
        assert common.tolist() == [0, *(len(os.path.commonprefix([a, b])) for a, b in zip(ordered, ordered[1:]))][: len(ordered)]
    assert os.listdir(tmp_path) == []


def test_common_prefixes_of_prose():
    """Copies that go on differently: neighbours whose common prefix ends at one symbol of two
    types stand between others that end at two symbols, at any level of the recursion."""
    rng = random.Random(8)
    for _ in range(25):
        words = [bytes(rng.choice(b"aeiounrst") for _ in range(rng.randint(1, 6))) for _ in range(40)]
        shared = b" ".join(rng.choice(words) for _ in range(60))
        pieces = [shared[: max(len(shared) - rng.randint(0, 30), 20)] + b" ".join(rng.choice(words) for _ in range(8)) for _ in range(6)]
        places, common = induced.suffix_order(pieces)
        starts = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        suffix = {int(s) + k: p[k:] for s, p in zip(starts, pieces) for k in range(len(p))}
        ordered = [suffix[k] for k in places.tolist()]
        assert ordered == sorted(suffix.values())
        assert common.tolist() == [0, *(len(os.path.commonprefix([a, b])) for a, b in zip(ordered, ordered[1:]))]


def brute(texts, width):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + width] for d in data for k in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=np.int8)
        for k in range(len(d) - width + 1):
            if seen[d[k : k + width]] > 1:
                gone[k : k + width] = 1
        spans = int((np.diff(gone, prepend=0) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def corpus():
    rng = random.Random(4)
    words = ["alpha", "beta", "γάμμα", "delta", "epsilon", "zeta", "eta", "theta", "日本", "kappa"]

    def prose(n):
        return " ".join(f"{rng.choice(words)}{rng.randint(0, 999)}" for _ in range(n))

    shared = [prose(12) for _ in range(6)] + ["x" * 90, "ab" * 60, prose(5)]
    out = []
    for _ in range(150):
        parts = [prose(rng.randint(0, 15)) for _ in range(rng.randint(0, 4))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, len(parts)), p[a : len(p) - rng.randint(0, 9)])
        out.append(rng.choice(["", " ", "\n"]).join(parts))
    same = prose(40)
    return [*out, None, "", "short", same, same, same, same + " " + prose(3), "a" * 700, prose(3) + "a" * 300, (prose(9) + "\n") * 8, prose(6000) + shared[0], None]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 300, "queue_rows": 64}, {"hot_segments": 1}])
def test_removal_equals_brute_force(spark, options, monkeypatch):
    reach_workers(spark)
    texts = corpus()
    rows = [(None if n % 50 == 7 else n // 2, t, b"clash", 1) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h binary, n_bytes long").repartition(4)
    for width, gram in ((48, 8), (100, 16)):
        found = Counter(tuple(r) for r in suffixdedup.removal_report(docs, width, gram=gram, **options).collect())
        want = Counter((r[0], *b) for r, b in zip(rows, brute(texts, width)))
        assert found == want
        assert sum(b[1] > 0 for b in brute(texts, width)) > 20


def test_blocks_of_long_texts(monkeypatch):
    """Segments do not depend on how a text is cut into blocks."""
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in (0, 3, 900, 0, 400, 399, 2000)]
    shape = suffixdedup.Shape(400)

    def keys():
        """Key of the string at each place."""
        out = {}
        for text, key, first, last, _ in suffixdedup.segments(texts, shape):
            for t, k, a, b in zip(text.tolist(), key.tolist(), first.tolist(), last.tolist()):
                out |= {(t, p): k for p in range(a, b + 1)}
        return out

    whole = keys()
    assert len(whole) == sum(max(0, len(t) - 399) for t in texts)
    monkeypatch.setattr(suffixdedup, "BLOCK", 137)
    assert keys() == whole


def test_empty_table(spark):
    reach_workers(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixdedup.removal_report(docs).collect() == []
