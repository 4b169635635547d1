"""Corpus word counts.

A document is one line of text; words are the tokens of Java's
``split(" ")`` (empty tokens between double spaces count as words).

Four strategies give the same (word, n) table:

* ``word_count`` – one round: explode, then ``groupBy(word)``.  Catalyst's
  partial ``HashAggregate`` combines inside each task before the shuffle,
  so a hot word is one row per task.
* ``word_count_salted`` – two rounds: each (document, word) pair gets a
  salt in [0, K) from a hash, round 1 sums per (salt, word), round 2 per
  word.  Bounds the rows any round-1 reducer sees for one word by ~1/K.
* ``word_count_salted_pairs`` – the same two rounds with the salt computed
  inside the grouping expression rather than stored as a column first.
* ``word_count_partitionwise`` – round 1 per (input partition, word), round
  2 per word: the explicit form of the partial aggregate.

Salts are hashes of the pair, not ``rand()``, so a retried task after an
executor loss regroups identically.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.random import hash_bucket
from sheaf.functions.strings import java_split, utf16_length
from sheaf.operators.joins import materialize

DOC_KEYS = ("doc_id", "line_no")


def tokenize(
    docs: DataFrame,
    text: str = "line",
    keep: Iterable[str] = DOC_KEYS,
    sep: str = " ",
    drop_empty: bool = False,
    with_pos: bool = True,
) -> DataFrame:
    """One row per token: keep columns, ``pos`` (0-based, if ``with_pos``) and ``word``."""
    tokens = java_split(text, sep)
    if with_pos:
        out = docs.select(*keep, F.posexplode(tokens).alias("pos", "word"))
    else:
        out = docs.select(*keep, F.explode(tokens).alias("word"))
    return out.where(F.col("word") != "") if drop_empty else out


def doc_term_counts(tokens: DataFrame, doc_keys: Iterable[str] = DOC_KEYS) -> DataFrame:
    """Occurrences of each word inside each document."""
    return tokens.groupBy(*doc_keys, "word").agg(F.count(F.lit(1)).alias("n"))


def count_terms_in_rows(
    docs: DataFrame, text: str = "line", keep: Iterable[str] = DOC_KEYS, sep: str = " ", drop_empty: bool = False
) -> DataFrame:
    """Occurrences of each word inside each document, every row being a document of its own.

    A row's tokens are sorted and run-length counted where the row lies:
    nothing is exchanged, whatever the number of tokens, and the rows may
    lie anywhere.  (``doc_term_counts`` counts rows that are already tokens.)
    """
    keys = list(keep)
    tokens = java_split(text, sep)
    if drop_empty:
        tokens = F.array_remove(tokens, "")
    tokens = F.coalesce(tokens, F.array().cast("array<string>"))
    ordered = docs.select(*keys, F.sort_array(tokens).alias("_words"))
    words = F.col("_words")
    # the places where another word begins than stands before
    begins = F.filter(
        F.sequence(F.lit(1), F.size(words)),
        lambda i: (i == 1) | (F.get(words, i - 1) != F.get(words, i - 2)),
    )
    begins = F.when(F.size(words) > 0, begins).otherwise(F.array().cast("array<int>"))
    marked = ordered.select(*keys, "_words", begins.alias("_begins"))
    end = F.size("_words") + 1
    runs = F.transform(
        F.col("_begins"),
        lambda first, k: F.struct(
            F.get(F.col("_words"), first - 1).alias("word"),
            (F.coalesce(F.get(F.col("_begins"), k + 1), end) - first).cast("bigint").alias("n"),
        ),
    )
    return marked.select(*keys, F.inline(runs))


def _tally(weight: str | None) -> Column:
    # One per token row, or the count a pre-counted (document, word) row carries.
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")


def word_count(tokens: DataFrame, weight: str | None = None) -> DataFrame:
    """(word, n): one-round corpus word count."""
    return tokens.groupBy("word").agg(_tally(weight).alias("n"))


def _second_round(partial: DataFrame) -> DataFrame:
    return partial.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_count_salted(
    tokens: DataFrame,
    n_salts: int = 16,
    doc_keys: Iterable[str] = DOC_KEYS,
    seed: int = 17,
    weight: str | None = None,
) -> DataFrame:
    """(word, n) in two rounds over a salt drawn per (document, word) pair."""
    keys = list(doc_keys)
    salted = tokens.withColumn("salt", hash_bucket(n_salts, *keys, "word", seed=seed))
    partial = salted.groupBy("salt", "word").agg(_tally(weight).alias("n"))
    return _second_round(partial)


def word_count_salted_pairs(
    tokens: DataFrame,
    n_salts: int = 16,
    doc_keys: Iterable[str] = DOC_KEYS,
    seed: int = 29,
    weight: str | None = None,
) -> DataFrame:
    """(word, n) in two rounds; the salt is drawn by the grouping expression."""
    keys = list(doc_keys)
    partial = tokens.groupBy(hash_bucket(n_salts, "word", *keys, seed=seed).alias("salt"), "word").agg(
        _tally(weight).alias("n")
    )
    return _second_round(partial)


def word_count_partitionwise(tokens: DataFrame, weight: str | None = None) -> DataFrame:
    """(word, n): per-partition counts first, then one sum per word.

    The first round is the aggregate's map side, which never leaves its
    partition; one exchange carries the partial counts to the second.
    """
    return word_count(tokens, weight)


STRATEGIES = {
    "one_round": word_count,
    "salted": word_count_salted,
    "salted_pairs": word_count_salted_pairs,
    "partitionwise": word_count_partitionwise,
}


def count_documents(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("n_documents"))


def vocabulary_size(counts: DataFrame) -> DataFrame:
    """Number of distinct words (exact) of a (word, n) table."""
    return counts.agg(F.count(F.lit(1)).alias("vocabulary_size"))


def word_lengths(counts: DataFrame) -> DataFrame:
    """Each distinct word with its ``String.length()``."""
    return counts.select("word", utf16_length("word").alias("length"))


def avg_word_length(counts: DataFrame) -> DataFrame:
    """Σ length of the distinct words div their number (integer division,
    not weighted by frequency); null on an empty corpus."""
    lengths = word_lengths(counts)
    return lengths.agg(
        F.count(F.lit(1)).alias("vocabulary_size"),
        F.sum("length").cast("bigint").alias("total_length"),
    ).select(
        "vocabulary_size",
        "total_length",
        F.expr("total_length div vocabulary_size").alias("avg_word_length"),
    )


def word_count_report(
    docs: DataFrame, tokens: DataFrame | None = None, n_salts: int = 16, doc_keys: Iterable[str] = DOC_KEYS
) -> DataFrame:
    """(metric, value) rows: number of documents, vocabulary size and token
    total by each of the four strategies (they must agree), and the average
    word length.

    The per-document term counts, the common input of all four strategies,
    are computed once and written to the checkpoint folder; the strategies
    then sum their ``n`` instead of re-reading and re-splitting the corpus.
    The corpus is scanned twice in all (term counts, line count), not six
    times, and a lost executor never recomputes the tokenising.  Without
    ``tokens`` the lines of ``docs`` are counted row by row, with no exchange.
    """
    keys = list(doc_keys)
    pairs = materialize(count_terms_in_rows(docs, keep=keys) if tokens is None else doc_term_counts(tokens, keys))
    parts = [count_documents(docs).select(F.lit("n_documents").alias("metric"), F.col("n_documents").alias("value"))]
    for name, fn in STRATEGIES.items():
        if name.startswith("salted"):
            counts = fn(pairs, n_salts, doc_keys=keys, weight="n")
        else:
            counts = fn(pairs, weight="n")
        # the token total keeps each strategy's counts alive in the optimised plan
        both = counts.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("tokens"))
        parts.append(both.select(F.explode(F.create_map(
            F.lit(f"vocabulary_size_{name}"), "words", F.lit(f"n_tokens_{name}"), "tokens"
        )).alias("metric", "value")))
    parts.append(avg_word_length(word_count(pairs, weight="n")).select(
        F.lit("avg_word_length").alias("metric"), F.col("avg_word_length").alias("value")
    ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
