"""Source mixing: targets against rounds of sharing, fits against all subsets."""

from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction
from itertools import product

import numpy as np
import pytest
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from accolade.llm import queries, source_mix


def shared(sizes: dict) -> dict:
    """Targets by the rounds of the contract, in fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in names if s not in capped)
        share = {s: Fraction(3 * sizes[s]) if s in capped else Fraction(rest * weight[s], open_) for s in names}
        over = {s for s in names if share[s] > 3 * sizes[s]}
        if not over:
            return share
        capped |= over


def check(rows, docs, off):
    sizes = defaultdict(int)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for _, text, source in docs:
        sizes[source] += count(text)
    assert sorted((str(r["doc_id"]), r["size"], str(r["source"])) for r in rows) == sorted((str(d), count(t), str(s)) for d, t, s in docs)
    taken, want = defaultdict(int), shared(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
        assert r["size"] == 0 and r["taken"] == 0 or r["size"] and r["taken"] % r["size"] == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= off(s)
    return taken


def sums(sizes):
    """What any subset adds up to."""
    reach = {0}
    for n in sizes:
        reach |= {x + n for x in reach}
    return reach


def test_query(spark, con):
    docs = [(d, t, s) for d, t, s in texts(con)]
    first = queries.op12_budget_fitting(spark, SMALL).collect()
    by, target = defaultdict(list), {r["source"]: r["target"] for r in first}
    for r in first:
        by[r["source"]].append(r["size"])
    closest = {s: min(abs(round(target[s]) % sum(sizes) - x) for x in sums(sizes)) for s, sizes in by.items()}
    check(first, docs, lambda s: closest[s] + 0.5)
    again = queries.op12_budget_fitting(spark, SMALL).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_targets_stop_at_three_times_the_source(spark):
    docs = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 10), ("b", 3), ("b", 4), ("c", 2000), ("d", 5), ("e", 0), ("é", 60), (None, 1), ("", 9)])]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    taken = check(source_mix.mix(df).collect(), docs, lambda s: 1300 if s == "c" else 20)
    assert taken["a"] == 30 and taken[""] == 27 and taken["e"] == 0


def test_edges(spark):
    got = source_mix.mix(edge_docs(spark)).collect()
    check(got, [(d, t, s) for d, t, _, s in EDGE], lambda s: 12000)
    assert source_mix.mix(empty_docs(spark)).count() == 0
    none = source_mix.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in none] == [(0, 0.0, 0)] * 2


def test_hot_source_of_one_length(spark):
    """A third of the rows are copies with one id: ranked apart from each other, taken to the word."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'a b c', 'd e') as text", "if(id % 3 = 0, 'hot', concat('s', id % 4)) as source")
    rows = source_mix.mix(df).collect()
    docs = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    check(rows, docs, lambda s: 3)


def best(lengths, counts, budget):
    return min(abs(budget - sum(n * x for n, x in zip(some, lengths, strict=True))) for some in product(*[range(c + 1) for c in counts]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 3)), min_size=1, max_size=5, unique_by=lambda p: p[0]), st.integers(0, 200))
def test_knapsack_comes_as_close_as_any_subset(pairs, budget):
    lengths, left = (np.array(x, dtype=np.int64) for x in zip(*sorted(pairs), strict=True))
    some = source_mix.knapsack(lengths, left, budget)
    assert all(0 <= n <= dict(pairs)[x] for x, n in some.items())
    assert abs(budget - sum(n * x for x, n in some.items())) == best(lengths.tolist(), left.tolist(), budget)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5000), st.integers(1, 400)), min_size=1, max_size=30, unique_by=lambda p: p[0]), st.floats(0, 0.999), st.integers(1, 300))
def test_fit_stays_within_counts_and_near(pairs, part, window):
    lengths, counts = (np.array(x, dtype=np.int64) for x in zip(*sorted(pairs), strict=True))
    budget = int(part * (lengths * counts).sum())
    some = source_mix.fit(lengths, counts, budget, window)
    assert (some >= 0).all() and (some <= counts).all()
    assert abs(budget - int((some * lengths).sum())) <= lengths.max()
