"""Exact top-k against SQL and plain numpy; recall of the curve index against brute force."""

from __future__ import annotations

import compare as harness
import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from accolade.llm import hilbert_ann, queries, threshold_topk

SCHEMA = "vec_id long, embedding array<float>, rank string, score string, row string"


def harness_types(monkeypatch):
    monkeypatch.setitem(harness.SPARK_TYPES, "int", "INTEGER")


def test_topk_query_matches_sql(spark, con, monkeypatch):
    harness_types(monkeypatch)
    name = "op5_threshold_topk"
    assert harness.compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SMALL) is None


def brute(rows, k, measure):
    """(query, rank, id, score) with rows told apart by place; null ids last in ties."""
    usable = [(i, v) for i, v, *_ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(usable):
        if q is None or q % 20:
            continue
        scored = [(-measure(a, b), (c is None, c or 0), c) for m, (c, b) in enumerate(usable) if m != n and len(a) == len(b)]
        out += [(q, r + 1, c, -s) for r, (s, _, c) in enumerate(sorted(scored, key=lambda t: t[:2])[:k])]
    return sorted(out, key=str)


def whole(a, b):
    return int(sum(np.floor(64 * np.float64(np.float32(x))) * np.floor(64 * np.float64(np.float32(y))) for x, y in zip(a, b, strict=True)))


def edge_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).round(2).tolist()) for i in range(90)]
    rows += [(100 + i, [0.5] * 6) for i in range(40)] + [(20, [0.5] * 6), (20, [0.5] * 6), (None, [0.5] * 6), (None, None)]
    rows += [(40, None), (60, []), (80, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (100, [float("nan")] * 6), (120, [float("inf")] * 6)]
    rows += [(140, [0.0] * 6), (160, [1.0, 2.0]), (161, [1.0, 2.0])]
    return [(i, v, "a", "b", "c") for i, v in rows]


@pytest.mark.parametrize("block,pack", [(4096, 1024), (16, 3)])
def test_topk_edges(spark, block, pack):
    rows = edge_rows()
    got = threshold_topk.top_k(spark.createDataFrame(rows, SCHEMA), k=7, block=block, pack=pack).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 7, whole)
    assert threshold_topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_topk_large_components(spark):
    """Scores past 2 ** 53 and losing ones past 2 ** 63 are exact; what no long holds is an error."""
    rows = [(i, [2.0**25 + i, -float(i)]) for i in range(30)] + [(20, [1.0, -0.5]), (31, [2.0**57 - 8, 0.0]), (33, [-(2.0**56), 3.0])]
    top = threshold_topk.top_k(spark.createDataFrame([r for r in rows if r[0] != 31], "vec_id long, embedding array<double>"), k=3, block=8, pack=2)
    assert sorted(map(tuple, top.collect()), key=str) == brute(
        [r for r in rows if r[0] != 31], 3, lambda a, b: sum(int(64 * x // 1) * int(64 * y // 1) for x, y in zip(a, b, strict=True)))
    for bad in (rows, [(20, [1e30]), (1, [1.0])]):
        with pytest.raises(Exception, match="too large|64-bit"):
            threshold_topk.top_k(spark.createDataFrame(bad, "vec_id long, embedding array<double>"), k=3).collect()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 5), st.integers(1, 12))
def test_threshold_lists_are_exact(seed, n, width, k):
    rng = np.random.default_rng(seed)
    vectors = np.floor(rng.standard_normal((n, width)) * 2)
    lists = threshold_topk.SortedLists(rng.permutation(n), vectors)
    query = np.floor(rng.standard_normal(width) * 2)
    at, scores, depth = lists.top(query, k, 0)
    order = sorted((-(vectors[i] @ query), lists.ids[i]) for i in range(1, n))[:k]
    assert [(-s, lists.ids[i]) for i, s in zip(at, scores, strict=True)] == order and depth <= n


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((4000, 2))
    assert threshold_topk.SortedLists(np.arange(4000), vectors).top(np.array([3.0, 1.0]), 5, None)[2] < 1000


def recall(spark, rows, k=20, **more):
    got = hilbert_ann.nearest(spark.createDataFrame(rows, SCHEMA), k=k, **more).collect()
    vectors = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows}
    ids, table = np.array(list(vectors)), np.array(list(vectors.values()))
    hits = wanted = 0
    for q in ids[ids % 20 == 0]:
        mine = [r for r in got if r["query_id"] == q]
        scores = table @ vectors[q]
        best = [int(i) for i in ids[np.lexsort((ids, -scores))] if i != q][:k]
        hits += len({r["vec_id"] for r in mine} & set(best))
        wanted += len(best)
        assert [r["rank"] for r in sorted(mine, key=lambda r: r["rank"])] == list(range(1, len(mine) + 1))
        assert all(abs(r["score"] - vectors[q] @ vectors[r["vec_id"]]) < 1e-12 for r in mine)
    return hits / wanted


def test_curve_recall_of_the_query(spark):
    rows = [(r["vec_id"], r["embedding"], "", "", "") for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    assert recall(spark, rows) >= 0.92


def test_curve_recall_with_clusters_of_any_length(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 24)) * 3
    rows = [(i, ((centres[i % 60] + rng.standard_normal(24) * 0.4) * (1 + i % 3)).tolist(), "", "", "") for i in range(3000)]
    assert recall(spark, rows, window_share=0.1) >= 0.95


def test_curve_recall_with_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(6)
    hot, *others = (v / np.linalg.norm(v) for v in rng.standard_normal((2001, 24)))
    hot, others = hot.tolist(), iter(others)
    rows = [(i, hot if i % 3 == 0 else next(others).tolist(), "", "", "") for i in range(3000)]
    got = hilbert_ann.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    copies = sorted(i for i, v, *_ in rows if v is hot)
    for q in (i for i in copies if i % 20 == 0):
        mine = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert mine == [i for i in copies[:21] if i != q][:20]
    assert recall(spark, rows) >= 0.9


def test_curve_recall_with_one_very_long_vector(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((60, 24)) * 3
    rows = [(i, ((centres[i % 60] + rng.standard_normal(24) * 0.4) * (1 if i == 1 else 0.001)).tolist(), "", "", "") for i in range(3000)]
    assert recall(spark, rows) >= 0.9


def test_curve_edges(spark):
    rows = edge_rows()
    usable = [r for r in rows if r[1] and any(r[1])]
    got = hilbert_ann.nearest(spark.createDataFrame(rows, SCHEMA), k=7, window_share=2.0).collect()
    exact = brute(usable, 7, lambda a, b: float(np.float32(a).astype(float) @ np.float32(b).astype(float)))
    assert sorted(((q, r, c) for q, r, c, _ in map(tuple, got)), key=str) == sorted(((q, r, c) for q, r, c, _ in exact), key=str)
    assert hilbert_ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_length_and_magnitude(spark):
    """Several numbers of components in one table, and lengths from 1e-200 to 1e200."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(3 + i % 2).tolist()) for i in range(120)] + [(200 + i, [float(i), 1.0]) for i in range(5)]
    rows += [(300 + 20 * i, (rng.standard_normal(3) * 10.0**e).tolist()) for i, e in enumerate((-200, -100, 100, 150))]
    rows += [(400, [1e-200, 0.0, 0.0]), (420, [1e200, 0.0, 0.0]), (440, [0.0, -1e-300, 0.0]), (460, [3e-320, 0.0, 0.0]), (480, [1e-200, 5.0])]
    got = hilbert_ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=6, window_share=2.0).collect()
    with np.errstate(over="ignore", under="ignore"):
        exact = brute(rows, 6, lambda a, b: float(np.array(a) @ np.array(b)))
    assert sorted(((q, r, c) for q, r, c, _ in map(tuple, got)), key=str) == sorted(((q, r, c) for q, r, c, _ in exact), key=str)
    assert {q for q, *_ in exact} == {i for i, v in rows if i % 20 == 0}


@pytest.mark.parametrize("width,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(width, bits):
    cells = np.array(np.meshgrid(*[range(1 << bits)] * width)).reshape(width, -1).T
    keys = hilbert_ann.hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1
