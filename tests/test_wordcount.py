from __future__ import annotations

from sheaf.operators import wordcount as W
from sheaf.sources.text import lines_from_column

from .conftest import SF001, needs

# Fixed value: a one-line sample corpus and its known word counts.
DATASET_LINE = "hello world hello there you hello hello many hellos"


def _docs(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return lines_from_column(df)


def _counts(df):
    return {r.word: r.n for r in df.collect()}


def test_dataset_golden(spark):
    docs = _docs(spark, [DATASET_LINE])
    tokens = W.tokenize(docs)
    expected = {"hello": 4, "hellos": 1, "many": 1, "there": 1, "world": 1, "you": 1}
    for name, fn in W.STRATEGIES.items():
        assert _counts(fn(tokens)) == expected, name
    assert W.count_documents(docs).first().n_documents == 1
    row = W.avg_word_length(W.word_count(tokens)).first()
    assert (row.vocabulary_size, row.total_length, row.avg_word_length) == (6, 28, 4)


def test_empty_tokens_and_hot_word(spark):
    texts = ["a  b", "   ", "", "x " * 50 + "y", "a\n\nb"]
    tokens = W.tokenize(_docs(spark, texts))
    results = [_counts(fn(tokens)) for fn in W.STRATEGIES.values()]
    assert all(r == results[0] for r in results)
    # "a  b" -> a, "", b ; "   " -> nothing ; blank line -> one empty token
    assert results[0] == {"a": 2, "": 2, "b": 2, "x": 50, "y": 1}
    assert _counts(W.word_count(W.tokenize(_docs(spark, ["a  b"]), drop_empty=True))) == {"a": 1, "b": 1}


def test_salts_do_not_change_results(spark):
    tokens = W.tokenize(_docs(spark, [f"w{i % 13} w{i % 5} w{i % 3}" for i in range(300)]))
    base = _counts(W.word_count(tokens))
    for k in (1, 2, 7, 64):
        assert _counts(W.word_count_salted(tokens, k)) == base
        assert _counts(W.word_count_salted_pairs(tokens, k)) == base
    assert _counts(W.word_count_partitionwise(tokens.repartition(5))) == base


def test_word_length_is_utf16(spark):
    tokens = W.tokenize(_docs(spark, ["\U0001F600a ab"]))
    row = W.avg_word_length(W.word_count(tokens)).first()
    assert (row.total_length, row.avg_word_length) == (5, 2)


def test_empty_corpus(spark):
    docs = _docs(spark, [""])
    tokens = W.tokenize(docs)
    assert W.count_documents(docs).first().n_documents == 0
    assert W.vocabulary_size(W.word_count(tokens)).first().vocabulary_size == 0
    assert W.avg_word_length(W.word_count(tokens)).first().avg_word_length is None


def test_doc_term_counts(spark):
    rows = W.doc_term_counts(W.tokenize(_docs(spark, ["a b a", "a"]))).collect()
    assert sorted((r.doc_id, r.word, r.n) for r in rows) == [(0, "a", 2), (0, "b", 1), (1, "a", 1)]


@needs(SF001)
def test_golden_documents_sf001(spark):
    from sheaf.sources import tables

    docs = lines_from_column(tables.documents(spark, SF001))
    counts = W.word_count(W.tokenize(docs))
    assert W.count_documents(docs).first().n_documents == 9344
    row = W.avg_word_length(counts).first()
    assert (row.vocabulary_size, row.avg_word_length) == (93796, 7)


def test_word_count_report(spark):
    docs = _docs(spark, [DATASET_LINE, "x  y"])
    rows = {r.metric: r.value for r in W.word_count_report(docs, W.tokenize(docs), 3).collect()}
    vocab = {k: v for k, v in rows.items() if k.startswith("vocabulary_size_")}
    assert len(vocab) == 4 and set(vocab.values()) == {9}
    assert rows["n_documents"] == 2


def test_terms_counted_in_rows_equal_the_grouped_counts(spark):
    import random

    rng = random.Random(3)
    words = ["a", "b", "", "é", "日本", "word", "Word", "\t", "x" * 300]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["", "   ", " lead", "trail  ", "one", "a\n\nb", "hot " * 30_000 + "cold", None]
    docs = _docs(spark, texts)
    for drop in (False, True):
        want = sorted(map(tuple, W.doc_term_counts(W.tokenize(docs, drop_empty=drop, with_pos=False)).collect()))
        got = W.count_terms_in_rows(docs, drop_empty=drop)
        assert sorted(map(tuple, got.collect())) == want
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    # repeated rows are documents of their own; a null line has no words
    rows = spark.createDataFrame([(1, "a b a"), (1, "a b a"), (None, None)], "doc_id long, line string")
    assert sorted(map(tuple, W.count_terms_in_rows(rows, keep=["doc_id"]).collect())) == [(1, "a", 2), (1, "a", 2), (1, "b", 1), (1, "b", 1)]
    assert W.count_terms_in_rows(rows.where("false"), keep=["doc_id"]).collect() == []


def test_word_count_report_without_tokens(spark):
    docs = _docs(spark, ["a b a", "c", "", "a  c"])
    with_tokens = sorted(map(tuple, W.word_count_report(docs, W.tokenize(docs), 3).collect()))
    assert sorted(map(tuple, W.word_count_report(docs, n_salts=3).collect())) == with_tokens
