"""The four programs end to end, from text files as their users run them."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pytest

from sheaf.operators import ratings as R
from sheaf.operators import silhouette as S
from sheaf.operators import wordcount as W
from sheaf.plans.ksweep import k_sweep_silhouette
from sheaf.sources import parse_labeled_points, parse_points, parse_ratings, read_text_lines


def _write(lines: list[str]) -> str:
    folder = tempfile.mkdtemp(prefix="sheaf-prog-")
    with open(os.path.join(folder, "input.txt"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return folder


def test_ratings_program(spark):
    path = _write(["p1,u1,5,x", "p2,u1,1", "p3,u2,4", "p1,u2,2", "p4,u3,3"])
    ratings = parse_ratings(read_text_lines(spark, path, num_partitions=3))
    top = R.top_normalized_ratings(ratings, 2).collect()
    assert [(r.product_id, r.max_norm_rating) for r in top] == [("p1", 2.0), ("p3", 1.0)]


def test_silhouette_program(spark):
    rng = np.random.default_rng(0)
    lines = [f"{x:.4f},{y:.4f},{c}" for c in (0, 1, 2) for x, y in rng.normal(c * 5, 1, size=(40, 2))]
    lines_df = read_text_lines(spark, _write(lines), with_ids=True)
    points = parse_labeled_points(lines_df, keep=["id"])
    approx = S.approx_silhouette(points, 10, seed=3).first()
    sample = S.exact_silhouette_sample(points, 10, seed=3).first()
    exact = S.exact_silhouette(points).first()
    assert approx.n_points == 120 and 0 < sample.n_points <= 30  # Bernoulli, capped at t per cluster
    assert 0.5 < exact.silhouette < 1.0 and 0.5 < sample.silhouette < 1.0


def test_k_sweep_program(spark):
    rng = np.random.default_rng(1)
    lines = [f"{x:.4f} {y:.4f}" for c in (0, 1, 2) for x, y in rng.normal(c * 6, 0.5, size=(30, 2))]
    points = parse_points(read_text_lines(spark, _write(lines), with_ids=True), keep=["id"])
    out = k_sweep_silhouette(points, k_start=2, h=3, max_iter=10, m=60, seed=2).orderBy("k").collect()
    assert [r.k for r in out] == [2, 3, 4] and max(out, key=lambda r: r.silhouette).k == 3


def test_word_count_program(spark):
    docs = read_text_lines(spark, _write(["hello world hello", "there  you", "hello"]), with_ids=True)
    tokens = W.tokenize(docs, text="value", keep=("id",))
    counts = [W.word_count(tokens), W.word_count_salted(tokens, 4, doc_keys=("id",)),
              W.word_count_salted_pairs(tokens, 4, doc_keys=("id",)), W.word_count_partitionwise(tokens)]
    results = [{r.word: r.n for r in c.collect()} for c in counts]
    assert all(r == {"hello": 3, "world": 1, "there": 1, "": 1, "you": 1} for r in results)
    report = {r.metric: r.value for r in W.word_count_report(docs, tokens, 4, doc_keys=("id",)).collect()}
    assert report["n_documents"] == 3 and report["vocabulary_size_salted"] == 5 and report["avg_word_length"] == 3


def test_line_ids_are_unique_and_stable(spark):
    path = _write([f"line {i}" for i in range(500)])
    a = {r.value: r.id for r in read_text_lines(spark, path, with_ids=True).collect()}
    b = {r.value: r.id for r in read_text_lines(spark, path, with_ids=True, num_partitions=7).collect()}
    assert a == b and len(set(a.values())) == 500


@pytest.mark.parametrize("bad", ["1,2,x,0"])
def test_malformed_point_fails(spark, bad):
    with pytest.raises(Exception):
        parse_labeled_points(read_text_lines(spark, _write([bad]))).collect()


def test_line_ids_are_positions_whatever_the_split_size(spark):
    folder = tempfile.mkdtemp(prefix="sheaf-ids-")
    expected = {}
    for f in range(3):
        lines = [f"file {f} line {i} " + "x" * (i % 13) for i in range(400)]
        with open(os.path.join(folder, f"part-{f}.txt"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        expected.update({line: f * 400 + i for i, line in enumerate(lines)})
    default = {r.value: r.id for r in read_text_lines(spark, folder, with_ids=True).collect()}
    key = "spark.sql.files.maxPartitionBytes"
    saved = spark.conf.get(key)
    try:
        spark.conf.set(key, "1024")  # many splits per file, lines cut across split borders
        small = read_text_lines(spark, folder, with_ids=True)
        assert small.rdd.getNumPartitions() > 10
        tiny = {r.value: r.id for r in small.collect()}
    finally:
        spark.conf.set(key, saved)
    assert default == expected and tiny == expected


def test_no_line_is_lost_when_the_cores_change(spark):
    """The split size follows the parallelism; ids are taken under one and read under another."""
    lines = [f"{i} " + "y" * (i % 61) for i in range(600_000)]
    path = _write(lines)
    key = "spark.sql.leafNodeDefaultParallelism"
    try:
        spark.conf.set(key, "4")
        numbered = read_text_lines(spark, path, with_ids=True)
        spark.conf.set(key, "9")
        got = numbered.selectExpr("count(*) AS n", "count(DISTINCT id) AS d", "max(id) AS m", "sum(int(id = int(split(value, ' ')[0]))) AS same").first()
    finally:
        spark.conf.unset(key)
    assert tuple(got) == (600_000, 600_000, 599_999, 600_000)


def test_brace_globs(spark):
    folder = tempfile.mkdtemp(prefix="sheaf-brace-")
    for name in "abc":
        with open(os.path.join(folder, f"{name}.txt"), "w") as fh:
            fh.write(name + "\n")
    got = read_text_lines(spark, f"{folder}/{{a,b}}.txt,{folder}/c.txt").collect()
    assert sorted(r.value for r in got) == ["a", "b", "c"]
