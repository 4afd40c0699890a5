"""Repeated strings against SQL and a count of all windows; suffix order against plain sorting."""

from __future__ import annotations

import random
from collections import Counter

import compare as harness
import pytest
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from accolade.llm import queries, suffix_dedup, suffix_sort

TEXTS = st.lists(st.one_of(
    st.binary(min_size=3, max_size=24), st.text("ab", min_size=3, max_size=30).map(str.encode),
    st.sampled_from([b"a" * 20, b"\0" * 9, b"\xff" * 9, b"abcabcabcabc"])), min_size=1, max_size=8)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 3))
def test_two_stage_order_and_repeats(texts, span):
    places, _, raw = suffix_sort.sorted_windows(texts, span)
    found = [raw[p:p + span] for p in places]
    assert found == sorted(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    prefixes = suffix_sort.common_prefixes(places, raw, span)
    assert all(a[:n] == b[:n] and (n == span or a[n] != b[n]) for a, b, n in zip(found, found[1:], prefixes[1:], strict=False))
    times = Counter(found)
    assert [m.tolist() for m in suffix_sort.repeated(texts, span)] == [
        [times[t[i:i + span]] > 1 for i in range(len(t) - span + 1)] for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300), st.sampled_from([(8, 3), (5, 5), (12, 4)]), st.sampled_from([7, 64, 1000]))
def test_segments_cover_and_follow_the_window(text, sizes, stretch):
    before, suffix_dedup.STRETCH = suffix_dedup.STRETCH, stretch
    try:
        anchor, start, windows = suffix_dedup.Anchors(*sizes).segments(text)
    finally:
        suffix_dedup.STRETCH = before
    covered = [i for a, n in zip(start.tolist(), windows.tolist(), strict=True) for i in range(a, a + n)]
    assert covered == list(range(len(text) - sizes[0] + 1))
    by: dict[bytes, set] = {}
    for h, a, n in zip(anchor.tolist(), start.tolist(), windows.tolist(), strict=True):
        assert n <= sizes[0] - sizes[1] + 1
        for i in range(a, a + n):
            by.setdefault(text[i:i + sizes[0]], set()).add(h)
    assert all(len(v) == 1 for v in by.values())


def brute(texts, span):
    bodies = [(t or "").encode() for t in texts]
    times = Counter(b[i:i + span] for b in bodies for i in range(len(b) - span + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - span + 1):
            if times[b[i:i + span]] > 1:
                gone[i:i + span] = [True] * span
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((len(b), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def check(docs, texts, **sizes):
    got = sorted((r["doc_id"], r["bytes_"], r["spans_"], bytes(r["kept_"])) for r in suffix_dedup.dedup(docs, **sizes).collect())
    assert got == [(i, *row) for i, row in enumerate(brute(texts, sizes["span"]))]


@pytest.mark.parametrize("most", [2048, 1])  # 1: every anchor with different segments is counted by windows
def test_repeats_against_all_windows(spark, most):
    r = random.Random(most)
    passage = "".join(r.choice("abcdef ") for _ in range(60))
    texts = ["".join(r.choice("abcdefgh ü") for _ in range(r.randrange(0, 90))) for _ in range(40)]
    texts += [t[:20] + passage[r.randrange(30):] + t[20:] for t in texts[:25]] + texts[:6] + texts[:3] + ["xyz" * 30, "=" * 50, None, "", "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check(df, texts, span=16, gram=6, most_segments=most)


def test_repeat_query_matches_sql(spark, con):
    name = "op2_suffix_array_spans"
    assert harness.compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SMALL) is None


def test_repeat_edges(spark):
    docs = edge_docs(spark)
    out = suffix_dedup.dedup(docs)
    assert [c for c in docs.columns if c != "text"] == out.columns[:-3]
    want = Counter((d, *row) for (d, *_), row in zip(EDGE, brute([t for _, t, *_ in EDGE], 200), strict=True))
    assert Counter((r["doc_id"], r["bytes_"], r["spans_"], bytes(r["kept_"])) for r in out.collect()) == want
    assert suffix_dedup.dedup(empty_docs(spark)).count() == 0
