"""Near duplicates against SQL and brute force; signatures against their expected agreement."""

from __future__ import annotations

import random

import compare as harness
import numpy as np
import pytest
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from accolade.llm import minmax_dedup, queries
from accolade.llm.components import components

SHINGLES = minmax_dedup.Shingles()


def plain_set(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


@settings(max_examples=300, deadline=None)
@given(st.text("aAbB \t\x1c\x85É", max_size=40))
def test_shingle_sets(text):
    assert len(SHINGLES.of(text)) == len(plain_set(text))


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        for _ in range(40):
            both, n = rng.integers(0, 2**63, 400, dtype=np.uint64), int(400 * (1 - share) / (2 * share))
            a, b = (np.concatenate([both, rng.integers(0, 2**63, n, dtype=np.uint64)]) for _ in range(2))
            same = (minmax_dedup.signature(a) == minmax_dedup.signature(b)).mean()
            errors.append(same - 400 / (400 + 2 * n))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def brute(rows, share=75):
    """component and kept of each row: rows are nodes, equal sets included."""
    sets = [plain_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(doc, least[r])
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, *_) in enumerate(rows)), key=str)


def test_query_matches_sql(spark, con):
    name = "op4_minmax_components"
    assert harness.compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SMALL) is None


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block_rows, entries", [(minmax_dedup.BLOCK_ROWS, minmax_dedup.ENTRIES), (3, 64)])
def test_chains_and_templates(spark, monkeypatch, block_rows, entries):
    """Links that no bucket leader shows: pairs inside a family whose other members are too far."""
    monkeypatch.setattr(minmax_dedup, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(minmax_dedup, "ENTRIES", entries)
    r, rows = random.Random(4), []
    for _ in range(6):
        base = [f"w{r.randrange(10**6)}" for _ in range(150)]
        for _ in range(14):  # about 0.6 alike
            member = edited(r, base, 8)
            rows.append(member)
            rows += [edited(r, member.split(), 2) for _ in range(r.randrange(3))]
        chain = base
        for _ in range(8):
            chain = edited(r, chain, 3).split()
            rows.append(" ".join(chain))
    r.shuffle(rows)
    rows = list(enumerate(rows + rows[:20]))
    got = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_edges(spark):
    got = minmax_dedup.near_duplicates(edge_docs(spark)).collect()
    assert sorted(map(tuple, got), key=str) == brute(EDGE)
    assert minmax_dedup.near_duplicates(empty_docs(spark)).count() == 0
    kept = minmax_dedup.keep_one(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted((x["doc_id"] for x in kept.collect()), key=str) == sorted([1, 1, 3, 4, 5, 7, 8, None, None], key=str)


def test_rows_equal_in_id_and_text_leave_one(spark):
    text = "five words and one more"
    rows = [(1, text, "b", {"x": 1}), (1, text, "a", {"x": 2}), (1, text, "a", {"x": 2}), (2, text, "a", None),
            (None, "no id but seven words of text", "a", None), (None, "no id but seven words of text", "a", None),
            (3, None, "a", None), (3, None, "a", None), (4, "", "a", None), (4, "", "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, id_ map<string,int>")
    kept = minmax_dedup.keep_one(df.withColumnRenamed("id_", "order"))
    assert kept.columns == ["doc_id", "text", "row", "order"]
    assert sorted(((r[0], r[1], r[2]) for r in kept.collect()), key=str) == sorted(
        [(1, text, "a"), (None, rows[4][1], "a"), (3, None, "a"), (3, None, "a"), (4, "", "a"), (4, "", "a")], key=str)


def test_every_group_keeps_a_row_where_ids_repeat_or_are_null(spark):
    third, group, clean = ("text of number three a b c d", "text of the seventh group a b c", "a clean text without an id")
    rows = [(3, third), (7, third), (7, group), (8, group), (9, group), (None, third), (None, clean), (None, "null ids " + group),
            (None, "NULL ids " + group)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in minmax_dedup.keep_one(df).collect()]
    assert {(3, third), (7, group), (None, clean)} <= set(kept) and len(kept) == 4
    assert sum(t.lower().startswith("null ids") for _, t in kept) == 1


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, links):
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    label = {x: x for link in links for x in link}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {a: b for a, b in label.items() if a != b}
