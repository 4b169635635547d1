"""The ten operators and the pipeline on small tables, against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import re
import time
import zlib
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheaf.llm import decontam, eftrie, fuzzylines, htmltree, oddsketch, outliers, packing, queries, rans, sharding, toxicity
from sheaf.llm.common import FILE_CLEANUP, documents, reach_workers, write_scratch
from sheaf.llm.tokens import ChunkEncoder, default_tokenizer_path
from tests.conftest import SF0001, needs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_lines int, _key string"
WORDS = ["alpha", "Beta", "gamma,", "delta.", "épsilon", "zeta", "eta", "theta", "iota", "kappa"]


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[rng.integers(10)]}{rng.integers(1000)}" for _ in range(n))


def rows():
    long_ = "\n".join(prose(k, 60) for k in range(40))
    near = prose(5, 120)
    texts = [None, "", " \n\t ", prose(1, 80), prose(1, 80), near, near.replace("alpha", "omega", 1), long_, "one two three",
             "a  b\n\n c  d", prose(9, 200) + "\n" + prose(1, 80), "x " * 400, near + " and more"]
    out = [(k, t, "en" if k % 3 else None, f"s{k % 2}", 1, "clash", 7, "clash") for k, t in enumerate(texts)]
    return out + [(None, prose(20, 70), "de", None, None, None, None, None), out[3], (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    reach_workers(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    reach_workers(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, prose(1, 80)), (2, "two THREE"), (3, None), (4, ""), (None, prose(1, 30)), (5, prose(77, 40))], "item_id long, text string")


# ------------------------------------------------------------------ tokens
def test_encoder_equals_the_library():
    enc = ChunkEncoder(default_tokenizer_path())
    odd = ["", "  a b", "a ", "x\n\ny", "a\n b", "it's. ok, don't. 12. a1.", "a b c.", "<|endoftext|> hi", "\x1c a", "²½. a²,", "a\r\nb", ".. ..", " ", "\n", "'s."]
    texts = odd + [r[1] for r in rows() if r[1]]
    for text, got in zip(texts, enc.encode_many(texts)):
        assert got.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_remembers_over_generations(monkeypatch):
    """Small generations, turned many times: the library's ids all the same."""
    monkeypatch.setattr("sheaf.llm.tokens.GENERATION", 50)
    enc = ChunkEncoder(default_tokenizer_path())
    texts = [prose(k % 7, 40 + k) + "\n" + prose(k, 5) + "." for k in range(60)]
    for k in range(0, 60, 4):
        for text, ids in zip(texts[k : k + 4], enc.encode_many(texts[k : k + 4])):
            assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert enc.older_spaced and len(enc.spaced) + len(enc.older_spaced) < len({c for t in texts for c in t.split(" ")})


def test_added_tokens_have_their_ids():
    from tokenizers import Tokenizer

    fresh, enc = Tokenizer.from_file(default_tokenizer_path()), ChunkEncoder(default_tokenizer_path())
    e = "<|endoftext|>"
    texts = ["plain text", e, e + e, f"{e} hi", f"a {e}b", f"a  {e}  b. c", f"x{e}y z\n{e}\n", None, "", "<|endoftext| >", *[r[1] for r in rows() if r[1]]]
    for text, got in zip(texts, enc.encode_many(texts), strict=True):
        assert got.tolist() == fresh.encode(text or "", add_special_tokens=False).ids
    assert 50256 in enc.encode(f"a{e}")


def tokens(text, end):
    enc = ChunkEncoder(default_tokenizer_path())
    return np.append(enc.encode(text), end).astype("<u4")


# -------------------------------------------------------------------- rANS
@pytest.mark.parametrize("n", [1, 63, 65, 65_537, 200_000])
def test_rans_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_000).astype(np.uint16)
    symbols, freqs, blocks = rans.encode_segment(ids)
    assert (rans.decode_blocks(symbols, freqs, blocks) == ids).all()
    assert (rans.decode_blocks(symbols, freqs, blocks[-1:]) == ids[(len(blocks) - 1) * rans.BLOCK :]).all()
    assert freqs.sum() == 1 << rans.TABLE_BITS


def test_rans_finds_damage():
    symbols, freqs, blocks = rans.encode_segment(np.arange(5000, dtype=np.uint16) % 700)
    words = bytearray(blocks[0]["words"])
    words[100] ^= 1
    with pytest.raises(ValueError):
        rans.decode_blocks(symbols, freqs, [blocks[0] | {"words": bytes(words)}])


def test_token_file(docs, none):
    got = sorted(rans.token_digest(docs, default_tokenizer_path()).collect(), key=lambda r: r.start)
    want = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for g, w in zip(got, want, strict=True):
        ids = tokens(w[1], 2)
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (w[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert rans.token_digest(none, default_tokenizer_path()).collect() == []


# ----------------------------------------------------------------- packing
def test_packing(docs, none):
    packed = packing.pack_documents(docs, default_tokenizer_path(), capacity=64, keep_ids=True, deme_items=8).cache()
    got = packed.collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == Counter(r[0] for r in rows())
    by_seq: dict = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for parts in by_seq.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        assert sum(r.length for r in parts) <= 64
    total = sum(r.length for r in got)
    assert total == sum(len(tokens(r[1], 0)) for r in rows())
    assert len(by_seq) <= math.ceil(total / 64) * 1.1 + 1
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == 4 * total
    assert packing.pack_documents(none, default_tokenizer_path()).collect() == []


def test_evolution_beats_no_worse_than_best_fit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(300, 900, 150)
    greedy = packing.best_fit(lengths, np.argsort(-lengths).tolist(), [], 2048)
    best = packing.evolve(lengths, 2048, 1, [], offspring=30)
    assert sorted(i for b in best for i in b) == list(range(150))
    assert len(best) <= len(greedy)


@pytest.mark.parametrize(("triples", "seed", "offspring"), [(12, 0, 6), (20, 0, 6), (40, 0, 200), (40, 2, 200)])
def test_evolution_saves_bins_that_best_fit_decreasing_opens(triples, seed, offspring):
    """Threes that fill a sequence exactly, in any order."""
    rng, lengths = np.random.default_rng(seed), []
    for _ in range(triples):
        a, b = (int(rng.integers(560, 800)) for _ in "ab")
        lengths += [a, b, 2048 - a - b]
    lengths = np.array(lengths)
    rng.shuffle(lengths)
    greedy = packing.best_fit(lengths, np.argsort(-lengths, kind="stable").tolist(), [], 2048)
    best = packing.evolve(lengths, 2048, 1 if offspring > 6 else 0, [], population=8 if offspring > 6 else 4, offspring=offspring)
    assert sorted(i for b in best for i in b) == list(range(3 * triples))
    assert all(lengths[b].sum() <= 2048 for b in best)
    assert triples <= len(best) < len(greedy)


# ---------------------------------------------------------------- sharding
def test_sharding(docs, none):
    got = sharding.shard_by_size(docs, 4).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len({r.text_crc32 for r in got}) == len({(r.text_crc32, r.shard) for r in got})
    assert sharding.shard_by_size(none).collect() == []


# ---------------------------------------------------------- quality, op 3
def brute_counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, cover = Counter(tri), set()
    for i, x in enumerate(tri):
        if seen[x] > 1:
            cover |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed)


def test_quality_counts(docs, none):
    got = outliers.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *[r[n] for n in names]) for r in got) == Counter((r[0], *brute_counts(r[1])) for r in rows())
    assert not any(r.kept for r in got if r.base_failed)
    assert outliers.judge(none).collect() == []


def test_quality_rejects_symbols(spark):
    clean = [(k, prose(k, 100), "en", "s") for k in range(300)]
    junk = [(1000 + k, prose(k, 100).replace(" ", "$$$ "), "en", "s") for k in range(10)]
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(got[k] for k in range(300)) >= 299
    assert not any(got[1000 + k] for k in range(10))


def test_quality_rejects_repeated_lines_and_words(spark):
    """Texts out of line in repeated lines alone, or in repeated words alone, among clean ones without spread."""
    clean = [(k, "\n".join(prose(100 * k + j, 4) for j in range(50)), "en", "s") for k in range(400)]
    lines_ = [(1000 + k, "\n".join([prose(90_000 + 100 * k + j, 4) for j in range(31)] + [prose(90_000 + 100 * k, 4)] * 29), "en", "s") for k in range(8)]
    words_ = [(2000 + k, prose(k, 110) + "\n" + prose(k + 50_000, 49) + "\n" + prose(k + 50_000, 49), "en", "s") for k in range(8)]
    schema = "doc_id long, text string, lang string, source string"
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(clean + lines_ + words_, schema)).collect()}
    assert sum(got[k].kept for k in range(400)) >= 398
    assert not any(r.base_failed for r in got.values())
    assert not any(got[k].kept for k in [*range(1000, 1008), *range(2000, 2008)])


def numpy_least_determinant(x, starts=60):
    """Least log determinant of a subset's covariance, by concentration steps from many random starts."""
    rng, h, best = np.random.default_rng(0), math.ceil(outliers.SUBSET * len(x)), math.inf
    for _ in range(starts):
        part = x[rng.choice(len(x), size=outliers.D + 1, replace=False)]
        for _ in range(30):
            inverse = np.linalg.pinv(np.cov(part.T, bias=True))
            d = np.einsum("ij,jk,ik->i", x - part.mean(0), inverse, x - part.mean(0))
            part = x[np.argsort(d, kind="stable")[:h]]
        best = min(best, np.linalg.slogdet(np.cov(part.T, bias=True) * outliers.CONSISTENCY)[1])
    return best


def test_quality_estimate_is_the_least_determinant(spark):
    """Against numpy, with a fifth of each group shifted away: the determinant is within 0.01 (in logarithm) of the
    least of 60 random starts, and the estimate is that of its own nearest rows (a fixed point of the steps)."""
    rng, data = np.random.default_rng(3), {}
    for g in ("a", None):
        mix = rng.normal(size=(5, 5)) + 2 * np.eye(5)
        x = rng.normal(size=(400, 5)) @ mix * 3 + rng.normal(size=5) * 10
        x[:80] += 60
        data[g] = x
    table = [(g, k, *map(float, v)) for g, x in data.items() for k, v in enumerate(x)]
    df = spark.createDataFrame(table, "lang string, k long, " + ", ".join(f"{n} double" for n in outliers.NAMES))
    model = outliers.mcd(df.select("lang", *outliers.NAMES), ["lang"], "test")
    dets = {r["lang"]: r["log_det"] for r in model.collect()}
    scored = outliers._with(df, model, ["lang"]).select("lang", "k", outliers._distance().alias("d")).collect()
    for g, x in data.items():
        assert dets[g] <= numpy_least_determinant(x) + 0.01
        got = np.array([r.d for r in sorted((r for r in scored if r.lang == g), key=lambda r: r.k)])
        part = x[np.argsort(got, kind="stable")[: math.ceil(outliers.SUBSET * len(x))]]
        cov = np.cov(part.T, bias=True) * outliers.CONSISTENCY
        assert dets[g] == pytest.approx(np.linalg.slogdet(cov)[1], abs=1e-6)
        assert list(got) == pytest.approx(list(np.einsum("ij,jk,ik->i", x - part.mean(0), np.linalg.inv(cov), x - part.mean(0))), rel=1e-6)


# -------------------------------------------------------------- trie, op 4
@pytest.mark.parametrize(("n", "bits"), [(0, 5), (1, 64), (7, 10), (1000, 64), (3000, 40)])
def test_elias_fano(n, bits):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, (1 << bits) - 1, n, dtype=np.uint64))
    ef, _ = eftrie.EliasFano.view(eftrie.EliasFano.build(v, bits), 0)
    if n:
        assert (ef.access(np.arange(n)) == v).all()
        x = np.concatenate([v, v + np.uint64(1), rng.integers(0, (1 << bits) - 1, 300, dtype=np.uint64)])
        assert (ef.successor(x) == np.searchsorted(v, x)).all()


@pytest.mark.parametrize("shards", [1, 5])
def test_scores(docs, none, shards):
    held = F.col("doc_id") % 4 == 0
    got = eftrie.score_documents(docs, held, shards).collect()
    texts = [(r[0], (r[1] or "").encode().lower().split() + [b" end"]) for r in rows()]
    out = {i for i, _ in texts if i is not None and i % 4 == 0}
    c, pairs = Counter(), Counter()
    for i, w in texts:
        if i not in out:
            c.update(w)
            pairs.update(zip([b" end"] + w, w))
    n, v = sum(c.values()), len(c)
    p = lambda x: (c[x] + 0.1) / (n + 0.1 * (v + 1))
    want = sorted((i is not None, i or 0, len(w), sum(c[x] > 0 for x in w), round(sum(math.log10(p(x)) for x in w), 6)) for i, w in texts)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    model = {}
    for i, w in texts:
        exact = sum(math.log10((pairs[u, x] + eftrie.PRIOR * p(x)) / (c[u] + eftrie.PRIOR)) for u, x in zip([b" end"] + w, w))
        model.setdefault((i, len(w)), exact)
    for r in got:
        assert abs(r.score - model[r.doc_id, r.n_tokens]) < 0.03 * r.n_tokens
    assert eftrie.score_documents(none, held).collect() == []


# ------------------------------------------------------------- lines, op 6
def test_fuzzy_lines(spark, docs, none):
    base = prose(50, 40)
    data = [(1, base + "\nshort line"), (2, prose(51, 30) + "\n" + base.replace("alpha", "alphe", 1)), (3, None), (4, base + "\n" + base), (5, "short line")]
    got = {r.doc_id: r for r in fuzzylines.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[1].text == data[0][1] and got[5].text == "short line" and got[3].text is None
    assert got[4].text == "" and got[4].n_dropped == 2
    assert got[2].text.split("\n")[0] == prose(51, 30)
    out = fuzzylines.dedup_lines(docs)
    assert out.count() == len(rows()) and set(out.columns) == set(docs.columns) | {"n_dropped"}
    assert fuzzylines.dedup_lines(none).collect() == []


def test_keys_go_in_turns(spark, monkeypatch):
    """No shuffle holds all kinds of keys at once, and the turns together find what one would."""
    tables, write = [], fuzzylines.write_scratch

    def spy(df, name, **options):
        out = write(df, name, **options)
        tables.append((name, out))
        return out

    monkeypatch.setattr(fuzzylines, "write_scratch", spy)
    lines = [prose(60 + k % 20, 30 + k % 3) for k in range(60)]
    groups = fuzzylines._Groups(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), 0.9, 8)
    turns = [Counter(map(tuple, t.select("band", "cid", "size").collect())) for name, t in tables if name == "line-buckets"]
    whole = Counter(map(tuple, groups.buckets.collect()))
    assert len(turns) == fuzzylines.TURNS and sum(turns, Counter()) == whole and whole
    assert all(sum(t.values()) < 0.5 * sum(whole.values()) for t in turns)
    forms = next(t for name, t in tables if name == "form-ids")
    assert {cid for _, cid, _ in whole} <= {r.cid for r in forms.collect()}


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def test_lines_with_changed_words_are_candidates(spark):
    """Recall against all pairs: short lines with a changed word and long ones with up to a twentieth of their words changed."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9)))
    lines = []
    for k in range(90):
        base = [word() for _ in range([9, 14, 20, 35][k % 4])]
        copy = list(base)
        for at in rng.choice(len(base), max(1, len(base) // 20), replace=False):
            copy[at] = copy[at][:1] + word()[: max(1, len(copy[at]) - 1)]
        lines += [" ".join(base), " ".join(copy)]
    near = lambda x, y: abs(len(x) - len(y)) * 10 <= max(len(x), len(y)) and edits(x, y) * 10 <= max(len(x), len(y))
    # different bases have nothing in common: links stay within a base and its copy
    assert not any(near(x, y) for x in lines[:8:2] for y in lines[8:16])
    want = [k for k in range(0, len(lines), 2) if lines[k] != lines[k + 1] and near(lines[k], lines[k + 1])]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in fuzzylines.dedup_lines(df).collect()}
    assert len(want) >= 60
    found = [k for k in want if got[k + 1]]
    assert len(found) >= 0.95 * len(want)
    assert not any(n for k, n in got.items() if k % 2 == 0 or k - 1 not in want and lines[k] != lines[k - 1])


def test_letters_never_rule_out_what_the_edit_distance_allows(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("aeinorstü"), rng.integers(1, 9)))
    pairs = [("e " * 600 + "x", "e" * 1300), ("", "abc"), ("é", "e")]
    for _ in range(60):
        x = " ".join(word() for _ in range(rng.integers(1, 9)))
        y = "".join(c for c in x if rng.random() < 0.9) + word() if rng.random() < 0.7 else " ".join(word() for _ in range(5))
        pairs.append((x, y))
    df = spark.createDataFrame(pairs, "x string, y string")
    counts = {c: fuzzylines.letter_counts(F.col(c)) for c in "xy"}
    df = df.select("*", *[n.alias(f"{c}_{k}") for c in "xy" for k, n in enumerate(counts[c])])
    x, y = ([F.col(f"{c}_{k}") for k in range(len(fuzzylines.COUNTS))] for c in "xy")
    for r in df.select("x", "y", fuzzylines.surplus(x, y).alias("m"), fuzzylines.surplus(y, x).alias("l")).collect():
        kept = [Counter({c: min(n, fuzzylines.MOST) for c, n in Counter(t).items() if c in fuzzylines.LETTERS}) for t in (r.x, r.y)]
        assert (r.m, r.l) == ((kept[0] - kept[1]).total(), (kept[1] - kept[0]).total())
        assert max(r.m, r.l) <= edits(r.x, r.y)


def test_lines_of_other_letters_never_come_to_the_edit_distance(spark, monkeypatch):
    """One bucket of lines that share word pairs and lengths and nothing else: no pair of them needs its texts."""
    tables, write = [], fuzzylines.write_scratch

    def spy(df, name, **options):
        out = write(df, name, **options)
        if name == "line-pairs":
            tables.append(out.count())
        return out

    monkeypatch.setattr(fuzzylines, "write_scratch", spy)
    lines = [" ".join(["the of"] * 3 + [c * 5] * 6) for c in "bcdghjkmnp"]
    out = fuzzylines.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert sum(tables) == 0
    assert not any(r.n_dropped for r in out.collect())


def test_rare_letters_rule_out_no_similar_pair(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("aeinorstüqxz "), rng.integers(1, 9)))
    pairs = [("eee ee", "tat"), ("", "zq"), ("é", "e")]
    for _ in range(80):
        x = " ".join(word() for _ in range(rng.integers(1, 9)))
        y = "".join(c if rng.random() < 0.9 else word()[:2] for c in x)
        pairs.append((x, y))
    df = spark.createDataFrame(pairs, "x string, y string")
    for r in df.select("x", "y", F.levenshtein(*[fuzzylines.rare_letters(F.col(c)) for c in "xy"]).alias("far")).collect():
        assert r.far <= edits(r.x, r.y)


def test_forms_without_a_near_length_leave_their_buckets(spark):
    lines = [" ".join(["the of"] * 3 + ["word"] * n) for n in (2, 6, 14, 30, 60)]
    groups = fuzzylines._Groups(spark.createDataFrame(list(enumerate([*lines, lines[0] + "s"])), "doc_id long, text string"), 0.9, 8)
    assert {r.size for r in groups.buckets.collect()} == {len(lines[0]), len(lines[0]) + 1}


def test_chance_pairs_need_their_rare_letters_only(spark, monkeypatch):
    """Lines of the same letters and word pairs in other orders: their whole texts are not compared, and a copy is still found."""
    tables, write = [], fuzzylines.write_scratch

    def spy(df, name, **options):
        out = write(df, name, **options)
        if name == "pair-texts":
            tables.append((set(out.columns), {r[0] for r in out.select(out.columns[-1]).collect()}))
        return out

    monkeypatch.setattr(fuzzylines, "write_scratch", spy)
    words = [c * 6 for c in "bcdghjkmpq"]
    lines = [" ".join(["the of"] * 3 + words[k:] + words[:k]) for k in range(0, 10, 2)]
    copy = lines[0].replace("hhhhhh", "hhhhhx")
    out = fuzzylines.dedup_lines(spark.createDataFrame(list(enumerate([*lines, copy])), "doc_id long, text string"))
    assert {r.doc_id: r.n_dropped for r in out.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1}
    seen = lambda column: {t for columns, texts in tables if column in columns for t in texts}
    assert len(seen("rare")) > 2 and seen("norm") == {lines[0], copy}


def test_normal_forms_of_whole_texts(spark):
    """Made at once, they are what each line gives by itself."""
    every = "".join(map(chr, [*range(1, 0x500), *range(0x1F00, 0x2100), 0x130, 0x3000])) + "".join(f"{chr(c)}x{chr(c)} Y " for c in range(1, 256))
    texts = [every, "Ab  cD,12 é\tÉ x\nfoo  \n  !bar.", "a\r\nb c", "ΑΣ\nΣ ΟΔΟΣ.\n", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.transform(F.split(fuzzylines.normalise(F.col("t")), "\n"), lambda line: F.trim(line))
    each = F.transform(F.split("t", "\n"), lambda line: F.trim(F.regexp_replace(F.lower(line), r"[\s\p{Punct}\d]+", " ")))
    for r in df.select("t", whole.alias("whole"), each.alias("each")).collect():
        assert r.whole == r.each


def test_scratch_tables_leave_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before, own = files(), spark.conf.getAll.get(FILE_CLEANUP)
    held = spark.range(20_000).groupBy((F.col("id") % 999).alias("k")).count()
    out = write_scratch(held, "test")
    late = time.time() + 20
    while files() - before and time.time() < late:
        time.sleep(0.2)
    assert not files() - before
    assert out.count() == 999 == held.count() and spark.conf.getAll.get(FILE_CLEANUP) == own


def test_simhash_of_long_and_short_lines(spark):
    lines = ["a b c d e f g h i", "w " * 20_000 + "x", prose(3, 70)]
    df = spark.createDataFrame(list(enumerate(lines)), "k int, norm string").select("k", F.trim("norm").alias("norm"))
    for r in fuzzylines.simhashes(df, "k").collect():
        words = lines[r.k].split()
        known = {x.w: x.h for x in spark.createDataFrame([(w,) for w in set(words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
        want = sum(1 << b for b in range(64) if sum((known[w] >> b) & 1 for w in words) * 2 > len(words))
        assert r.sim & (2**64 - 1) == want


# -------------------------------------------------------------- html, op 7
PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>Menu</a></ul></nav>"
    "<!-- no --><div class='ad'>Buy now</div><article><h1>Head &amp; more</h1><p>First  <b>bold</b>\n text, here.<br>Next.<p>Second one.</p>"
    "<form><input>Sign up</form></article><div class=comments><p>I like it.</p></div><footer>&copy; site</footer></body></html>"
)


def test_html(spark):
    pages = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<div class=ad>x</div>"), (None, "u", PAGE), (5, "u", "<p>open <b>bold <p>two &lt;")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.page_id, r.url): r for r in htmltree.extract(df).collect()}
    want = "Head & more First bold text, here. Next. Second one."
    assert got[1, "u"].text == want == got[None, "u"].text and got[1, "u"].n_chars == len(want)
    assert got[2, "u"].text == "" == got[3, None].text == got[4, "u"].text
    assert htmltree.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("tag", ["button", "select", "svg", "object", "video", "audio", "canvas", "math"])
def test_html_goes_on_after_unclosed_elements(tag):
    model = htmltree.fit_counts(htmltree.count_page(PAGE))
    want = "Head & more First bold text, here. Next. Second one."
    for start in (f"<{tag} x=1>hidden", f"<div><{tag}>hidden</div>", f"<{tag}>hidden<p></p></{tag.upper()} >", f"<{tag}/>", f"<{tag}><{tag}>hidden</{tag}>"):
        assert htmltree.main_text(PAGE.replace("<article>", start + "<article>"), model) == want, start
    if tag not in ("button", "select"):
        inner = f"<{tag}><{tag}>hidden</{tag}><p>hidden too</p></{tag}>"
        assert htmltree.main_text(PAGE.replace("<h1>", inner + "<h1>"), model) == want


def test_html_raw_text_ends():
    model = htmltree.fit_counts(htmltree.count_page(PAGE))
    want = "Head & more First bold text, here. Next. Second one."
    dotted = "<nav>" + "\u0130" * 40 + "</nav><SCRIPT>var a = '</scripted>';</Script>"
    assert htmltree.main_text(PAGE.replace("<article>", dotted + "<article>"), model) == want
    assert htmltree.main_text(PAGE.replace("<article>", "<script><article>"), model) == ""


def test_marginals_are_exact():
    nodes = htmltree.parse(PAGE)[:9]
    model = htmltree.fit_counts(htmltree.count_page(PAGE))
    own = [sum(model.unary.get(e, 0) for e in htmltree.evidence(n)) for n in nodes]
    z, on = 0.0, np.zeros(len(nodes))
    for mask in range(1 << len(nodes)):
        y = [(mask >> k) & 1 for k in range(len(nodes))]
        e = model.root * y[0] + sum(o for o, b in zip(own, y) if b) + sum(model.pair[y[n.parent], y[k]] for k, n in enumerate(nodes) if k)
        z += math.exp(e)
        on += math.exp(e) * np.array(y)
    assert np.allclose(htmltree.marginals(nodes, model), on / z)


# ------------------------------------------------------- near copies, op 9
def brute_groups(data, t):
    sets = []
    for _, text in data:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    ids = {}
    for (i, _), c in zip(data, comp):
        if i is not None:
            ids[c] = min(ids.get(c, i), i)
    return Counter((i, len(s), ids.get(c) if s else i) for (i, _), s, c in zip(data, sets, comp))


@pytest.mark.parametrize("t", [80, 85])
def test_near_duplicates(spark, docs, none, t):
    data = [(r[0], r[1]) for r in rows()]
    got = oddsketch.near_duplicates(docs, t / 100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(data, t)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert oddsketch.near_duplicates(none, t / 100).collect() == []


def test_near_duplicates_in_a_chain(spark):
    """A large group whose members are not all near each other."""
    base = prose(70, 150).split()
    data = [(k, " ".join(base[3 * k : ] + [f"n{j}" for j in range(3 * k)])) for k in range(30)]
    got = oddsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 0.85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(data, 85)


def test_near_duplicates_in_a_group_that_is_just_too_different(spark, monkeypatch):
    """Members with a stock of shared words are not all compared; no link is lost."""
    stock, rng = prose(71, 200).split(), np.random.default_rng(5)
    data = []
    for k in range(120):
        words = list(stock)
        for at in rng.choice(200, size=int(rng.integers(2, 8)), replace=False):
            words[at] = f"w{k}x{at}" if rng.random() < 0.7 else f"w{at}"
        data.append((k, " ".join(words)))
    compared = []
    confirm = oddsketch._Search.confirm

    def counted(self, pairs):
        pairs = oddsketch.write_scratch(pairs, "counted")
        compared.append(pairs.count())
        confirm(self, pairs)

    monkeypatch.setattr(oddsketch._Search, "confirm", counted)
    got = oddsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 0.85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(data, 85)
    assert compared[-1] < 120 * 119 / 2 / 10


def test_near_stage_decides_per_row(spark):
    """Null and repeated doc_ids: clean rows stay, one row of each group stays."""
    reach_workers(spark)
    a, b, c, d, e, f, g = (prose(200 + k, 90) for k in range(7))
    data = [(1, a), (None, a + " more"), (None, b), (2, c), (2, a + " end"), (None, d), (None, d), (None, d + " x"), (3, e), (3, e), (4, f), (None, f), (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, g) for i, t in data], "doc_id long, text string, extra string").repartition(3)
    out = corpus_pipeline.near(spark, df, "")
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert out.columns == df.columns
    (third,) = [t for i, t in got if i is None and t and t.startswith(d)]
    assert third in (d, d + " x")
    assert got == Counter([(1, a), (None, b), (2, c), (None, third), (3, e), (4, f), (None, None), (None, "")])


# --------------------------------------------------- decontamination, op 10
def words10(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_contamination(docs, bench, none):
    items = [(r.item_id, words10(r.text)) for r in bench.collect()]
    want = Counter()
    for r in rows():
        w, hit, ids = words10(r[1]), set(), set()
        for item, x in items:
            n = min(10, len(x))
            grams = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    ids |= {str(item)} if item is not None else set()
        want[r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)] += 1
    assert Counter(tuple(r) for r in decontam.contamination(docs, bench).collect()) == want
    assert decontam.contamination(none, bench).collect() == []
    assert not any(r.contaminated for r in decontam.contamination(docs, bench.limit(0)).collect())


def test_proximity(spark):
    item = "one two three four five six seven eight nine ten"
    moved = "zero one two three EXTRA four five six seven eight nine ten"
    matches, _ = decontam.find_matches(
        spark.createDataFrame([(1, moved), (2, item), (3, "one ten")], "doc_id long, text string"),
        spark.createDataFrame([(1, item)], "item_id long, text string"), slack=2,
    )
    kinds = {r._key[0]: r.kind for r in matches.collect()}
    assert kinds == {"1": "proximity", "2": "phrase"} or kinds == {"2": "phrase", "1": "proximity"}


# ------------------------------------------------------------ toxicity, op 1
def test_grammar():
    tagger = toxicity.Tagger(["idiot"], ["stup"])
    of = lambda t: dict(zip(toxicity.EVENTS, tagger.events(t)))
    assert of("You are an IDIOT.")["It"] == 1 and of("what an idiot")["I"] == 1
    assert of("he is not an idiot")["In"] + of("he is not an idiot")["It"] == 1
    assert of("she said idiot. Stupidity!") | {"Ir": 1, "I": 1} == of("she said idiot. Stupidity!") or of("she said idiot.")["Ir"] + of("she said idiot.")["It"] == 1
    assert sum(tagger.events(None)) == sum(tagger.events("")) == sum(tagger.events("idiotic plain")) == 0


@pytest.mark.parametrize(
    ("text", "event"),
    [("I will kill you", "Ht"), ("I will beat him", "Ht"), ("idiot, you", "It"), ("what an idiot you are", "It"), ("you will kill", "Ht"),
     ("he kills you", "Ht"), ("killing them", "Ht"), ("don\u2019t kill anyone", "Hn"), ("don't kill you", "Hn"), ("kill. You", "H"),
     ("he said: kill you", "Ht"), ("he said kill you", "Hr")],
)
def test_grammar_of_clauses(text, event):
    tagger = toxicity.Tagger(["idiot"], [])
    assert dict(zip(toxicity.EVENTS, tagger.events(text))) == dict.fromkeys(toxicity.EVENTS, 0) | {event: 1}


def test_grammar_against_its_definition():
    """Every clause of up to five word classes: negated within its scope, else reported, else targeted from either side."""
    machine, back = toxicity.grammar(), toxicity.targeted()
    for n in range(1, 6):
        for clause in product("IHTNRo", repeat=n):
            want = []
            for k, c in enumerate(clause):
                if c in "IH":
                    negated = "N" in clause[max(0, k - toxicity.SCOPE) : k]
                    want.append(c + ("n" if negated else "r" if "R" in clause[:k] else "t" if "T" in clause else ""))
            got = toxicity.clause_events(machine, back, list(clause))
            assert [e for e in got if e in toxicity.EVENTS] == want, clause


@needs(SF0001)
def test_toxicity_held_out(spark):
    sf = SF0001.replace("0.001", "0.01")
    got = {r.doc_id: r for r in queries.op1_toxicity(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels if got[r.doc_id].held_out]
    assert sum(p for p, y in held if not y) <= 2
    assert sum(p for p, y in held if y) >= 0.7 * sum(y for _, y in held)


def test_toxicity_edge_cases(docs, none, spark):
    labels = spark.createDataFrame([(3, 1), (5, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(none, labels.limit(0)).collect() == []


# ------------------------------------------------------------- SQL, pipeline
@needs(SF0001)
def test_contamination_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    got = queries.op10_decontamination(spark, SF0001)
    want = con.execute(queries.ORACLE["op10_decontamination"]).fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


@needs(SF0001)
def test_pipeline(spark):
    source = documents(spark, SF0001)
    kept = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF0001).cache()
        assert out.columns == source.columns, name
        assert out.count() <= kept.count()
        kept = out
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF0001)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
