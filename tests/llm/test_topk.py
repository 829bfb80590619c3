import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from rentloom.llm import queries, topk


def test_equals_sql(spark, smallest):
    assert compare.differences(queries.QUERIES["op5_top_k"](spark, smallest), compare.duck(smallest), queries.SQL["op5_top_k"]) == []


@pytest.mark.parametrize("blocks", [(2, 3), (256, 4096)])
def test_ties_nulls_lengths_and_repeats(spark, blocks):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], "t") for i in range(0, 20)] + [
        (30, [0.5, -0.001], "t"), (31, None, "t"), (32, [1.0, None], "t"), (33, [nan, 1.0], "t"), (34, [inf, 1.0], "t"),
        (None, [1.0, 1.0], "t"), (35, [], "t"), (36, [1.0], "t"), (37, [2.0, 9.0], "t"), (37, [2.0, 9.0], "t"), (50, [-3.0, 4.0], "t")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    vectors = topk.whole_vectors(df)
    got = {}
    for r in topk.top_k(vectors.filter("vec_id in (0, 36, 50)"), vectors, 5, *blocks, step=3).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got[0] == {1: (37, 512 * 256), 2: (37, 512 * 256), 3: (1, 65536), 4: (2, 65536), 5: (3, 65536)}
    assert 36 not in got  # no other vector is as long
    best = 9 * 256 * 4 * 256 - 2 * 256 * 3 * 256
    assert got[50][1] == got[50][2] == (37, best)
    assert got[50][3] == (30, 128 * -768 - 1024)


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    v = topk.whole_vectors(df)
    assert [tuple(r) for r in topk.top_k(v.filter("vec_id = 0"), v).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(v.filter("false"), v).collect() == topk.top_k(v, v.filter("false")).collect() == []
    assert topk.top_k(v.filter("vec_id = 0"), v.filter("vec_id = 0")).collect() == []


def test_scores_beyond_64_bits_are_refused(spark):
    v = topk.whole_vectors(spark.createDataFrame([(0, [1e15]), (1, [1e15])], "vec_id long, embedding array<double>"))
    with pytest.raises(OverflowError):
        topk.top_k(v, v).collect()


def test_outliers_whose_scores_fit(spark):
    """The largest components multiply beyond 64 bits, no real score does."""
    rows = [(0, [3.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, -1.0]), (50, [1e12, 0.0]), (100, [0.0, 1e4])]
    v = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    one = 256 * 256
    got = [tuple(r) for r in topk.top_k(v.filter("vec_id in (0, 100)"), v, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 50, 3 * one * 10**12), (0, 2, 3, 6 * one), (0, 3, 2, 3 * one),
                   (100, 1, 0, 0), (100, 2, 2, 0), (100, 3, 50, 0)]


def test_blocks_without_any_of_the_best(spark, monkeypatch):
    """The k-th value comes from counts of all scores: blocks are far larger than k, and most
    of them hold none of the best."""
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 40, (600, 6))
    x[7] = x[11] = x[13] = 60  # the best stand in at most three of some sixty blocks
    df = spark.createDataFrame([(i, [v / 256 for v in r]) for i, r in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    v = topk.whole_vectors(df)
    asked = []
    histogram = topk._histogram

    def counted(met, k, low, bits, wide):
        out = histogram(met, k, low, bits, wide)
        asked.append((bits, out.groupBy("query_id").agg(F.sum("n")).collect()))
        return out

    monkeypatch.setattr(topk, "_histogram", counted)
    got = {}
    for r in topk.top_k(v.filter("vec_id % 100 = 0"), v, 3, 2, 10, step=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    scores = x @ x.T
    for q in range(0, 600, 100):
        best = sorted((-scores[q, c], c) for c in range(600) if c != q)[:3]
        assert sorted(got[q]) == [(i + 1, c, -s) for i, (s, c) in enumerate(best)]
    # the first round counts every score but the query's own, later ones those of one bucket
    assert {n for _, n in asked[0][1]} == {599}
    assert len(asked) > 2 and all(n < 599 for _, n in asked[-1][1])
