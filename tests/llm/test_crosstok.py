"""op13: alignment of two tokenizers against a plain version."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import pytest

from sheaf.llm import crosstok
from sheaf.llm.common import reach_workers


@pytest.fixture(scope="module")
def work():
    return crosstok.Aligner(crosstok.default_tokenizer_path(), crosstok.default_piece_path())


def plain(work, text):
    """(a ids, b ids, groups) of a whole text, tokenised whole; None without tokens."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = work.a.encode(" " + text, add_special_tokens=False).ids, work.b.encode(text)
    if b"".join(work.a_bytes[x] for x in a) != raw or b"".join(work.b_bytes[x] for x in b) != raw:
        return None

    def ends(ids, table):
        out, at = {}, 0
        for n, x in enumerate(ids):
            at += len(table[x])
            out[at] = n + 1
        return out

    a_end, b_end = ends(a, work.a_bytes), ends(b, work.b_bytes)
    groups, i, j = [], 0, 0
    for cut in sorted(set(a_end) & set(b_end)):
        p, q = a_end[cut], b_end[cut]
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return a, b, groups


def named(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ODD = [
    "a  b", "  x", " ", "\n", "a\n b", "▁x", "a▁", "<|endoftext|> hi", "<s> x </s>", "<0x41>", "日本語 テキスト です", "x\r\n y",
    "don't  stop\t \tnow ", "a\x1cb \x1c c", "🙂 🙂🙂", "a\x00b", "ab　cd 　 e", "﻿abc", "é x", " \x85 a", "No. 5, word.", "word,, word..",
]


def test_chunks_equal_whole_texts(work):
    rng = random.Random(3)
    letters = " \n\tab.',é日<|>▁\x85 "
    texts = [*ODD, *("".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000))]
    for text, found in zip(texts, work.align(texts)):
        want = plain(work, text)
        assert (found is None) == (want is None), text
        if want:
            assert ";".join(c.groups for c in found) == named(want[2]), text
            assert [sum(c[k] for c in found) for k in range(3)] == [len(want[0]), len(want[1]), len(want[2])]


def test_identity_map_has_the_same_bytes(work):
    pairs = [(a, b) for a, b in enumerate(work.identity.tolist()) if b >= 0]
    assert len(pairs) > 20_000
    assert all(work.a_bytes[a] == work.b_bytes[b] for a, b in pairs)


def test_counts_and_report(spark, work):
    reach_workers(spark)
    rng = random.Random(5)
    words = ["the", "nation", "unbelievably", "xqzt", "Straße", "日本", "é", "don't", "a▁", "\n", "1234567", "...", "colour"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(120)]
    texts += ["word " * 60_000, "日本語" * 5_000, None, "", *ODD]
    rows = [(n, t, n) for n, t in enumerate(texts)] + [(7, texts[7], 1), (None, "the nation", 2), (7, "other text", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, same long").repartition(5)  # "same" clashes on purpose
    found = Counter(tuple(r) for r in crosstok.alignment_report(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())

    made = [(n, plain(work, t)) for n, t, _ in rows]
    count = Counter((a[-1], b[-1]) for _, x in made if x for a, b in x[2])
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    want = Counter()
    for n, x in made:
        if x is None:
            want[n, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        links = [(a[-1], b[-1]) for a, b in x[2]]
        want[
            n, len(x[0]), len(x[1]), len(x[2]), len(links), sum(count[k] == top[k[1]] for k in links), sum(count[k] for k in links),
            hashlib.sha256(named(x[2]).encode()).hexdigest(),
        ] += 1
    assert found == want
    pairs = crosstok.link_counts(crosstok.align_documents(docs))
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)
    assert len(count) <= work.max_pairs()


def test_empty_table(spark):
    reach_workers(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert crosstok.alignment_report(docs).collect() == []


def test_workers_forget_after_a_task(spark):
    """Workers stay for later stages; what they remember of a task's texts goes with it."""
    reach_workers(spark)
    docs = spark.createDataFrame([(k, f"word{k} and more, {k * k}") for k in range(200)], "doc_id long, text string").repartition(8)
    assert crosstok.align_documents(docs).count() == 200

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            sizes = [len(x.memo) + len(x.odd) for x in crosstok._loaded.values()]
            yield pa.RecordBatch.from_pydict({"n": [sum(sizes)], "threads": [os.environ.get("TOKENIZERS_PARALLELISM", "")]})

    rows = spark.range(0, 8, 1, 8).mapInArrow(held, "n long, threads string").collect()
    assert {r.n for r in rows} == {0}
    assert "false" in {r.threads for r in rows}
