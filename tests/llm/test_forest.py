from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sunframe.llm import forest


def brute(vectors: dict[int, list[float]], query: int, k: int = 20):
    q = np.array(vectors[query], float)
    scored = sorted((-float((np.array(v, float) * q).sum()), i) for i, v in vectors.items() if i != query)
    return [(i, -s) for s, i in scored[:k]]


def test_op8_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    vectors = dict(zip(*pq.read_table(f"{sf}/embeddings.parquet").select(["vec_id", "embedding"]).to_pydict().values(), strict=True))
    found: dict[int, list] = {}
    for r in forest.op8_neighbours(spark, sf).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for q, rows in found.items():
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert q not in {r["vec_id"] for r in rows}
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        for r in rows:
            assert math.isclose(r["score"], float(np.dot(np.array(vectors[q], float), np.array(vectors[r["vec_id"]], float))), rel_tol=1e-12, abs_tol=1e-12)
        hits += len({r["vec_id"] for r in rows} & {i for i, _ in brute(vectors, q)})
    assert hits >= 0.9 * 20 * len(found)


@pytest.mark.parametrize("scale", [1.0, 5.0])
def test_recall_of_deep_trees_on_clusters_and_lengths(spark, scale):
    r = np.random.default_rng(0)
    centres = r.normal(size=(40, 16))
    x = centres[r.integers(0, 40, 4000)] + 0.2 * r.normal(size=(4000, 16))
    x *= r.uniform(1, scale, (4000, 1))
    vectors = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    rows = forest.neighbours(df, F.col("vec_id") % 100 == 0, leaf=64, sample=2000).collect()
    got: dict[int, set] = {}
    for row in rows:
        got.setdefault(row["query_id"], set()).add(row["vec_id"])
    hits = sum(len(got[q] & {i for i, _ in brute(vectors, q)}) for q in range(0, 4000, 100))
    assert hits >= 0.9 * 20 * 40


def test_hot_vector_ties_and_repeats(spark):
    r = np.random.default_rng(1)
    vectors = {i: ([1.0, 0.0, 0.0] if i % 3 else r.normal(size=3).tolist()) for i in range(600)}
    df = spark.createDataFrame(list(vectors.items()) + [(0, vectors[0])] * 3, "vec_id long, embedding array<double>")
    rows = forest.neighbours(df, F.col("vec_id") % 20 == 0, leaf=32, recall=1.0).orderBy("query_id", "rank").collect()
    for q in (20, 40):
        assert [(x["vec_id"], x["score"]) for x in rows if x["query_id"] == q] == brute(vectors, q)
    assert len(rows) == 30 * 20 and len({(x["query_id"], x["vec_id"]) for x in rows}) == len(rows)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (20, [0.0, 0.0]), (40, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("point", F.lit("own")).withColumn("leaf", F.lit(1))
    got = [tuple(r) for r in forest.neighbours(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 40, -1.0), (40, 1, 1, 0.5), (40, 2, 0, -1.0)]
    assert forest.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert forest.neighbours(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_blocks_of_a_leaf_change_nothing(spark, monkeypatch):
    r = np.random.default_rng(3)
    df = spark.createDataFrame([(i, r.normal(size=4).tolist()) for i in range(500)], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, forest.neighbours(df, F.col("vec_id") % 20 == 0).collect()))
    monkeypatch.setattr(forest, "BLOCK", 40)
    assert sorted(map(tuple, forest.neighbours(df, F.col("vec_id") % 20 == 0).collect())) == whole
    rerank = forest._rerank

    def spied(width, k):
        run = rerank(width, k)

        def watched(index, queries):
            if len(index) > 60 or len(queries) > 12:
                raise ValueError(f"{len(index)} points and {len(queries)} queries in one task")
            return run(index, queries)

        return watched

    monkeypatch.setattr(forest, "_rerank", spied)
    monkeypatch.setattr(forest, "QUERY_BLOCK", 4)
    assert sorted(map(tuple, forest.neighbours(df, F.col("vec_id") % 20 == 0).collect())) == whole
