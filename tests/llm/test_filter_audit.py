"""The filter audit against its SQL and against applying the filters one after another."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import compare as harness
import numpy as np
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs
from pyspark.sql import functions as F

from accolade.llm import filter_audit, queries

LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, 0), (5, 0, 1), (6, 1, 1), (8, 1, 0), (None, 1, 1), (99, 1, 1), (3, None, None)]


def verdict(doc, text, docs):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text or "")) > 10 * len(text or ""), "D": bool(re.search(r"[#$%&*|]", text or "")),
        "E": doc is not None and any(d is not None and d < doc and (t or "") == (text or "") for d, t, *_ in docs),
    }


def brute(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    good.discard(None), toxic.discard(None)
    judged = defaultdict(list)
    for doc, text, lang, *_ in docs:
        judged[lang or ""].append((doc, verdict(doc, text, docs)))
    out = {}
    for part, rows in judged.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone, before = [r for r in left if r[1][f]], left
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(v[f] for _, v in rows) - sum(v[f] for _, v in before),
                    sum(v[f] and sum(v.values()) == 1 for _, v in rows), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_query_matches_sql(spark, con):
    name = "op13_tensor_audit"
    assert harness.compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SMALL) is None


def test_filters_applied_in_turn(spark):
    many = " ".join(f"w{i}" for i in range(120))
    docs = [*EDGE, (20, many, "en", "a"), (21, many, "de", "a"), (19, many, "", "a"), (22, many + " $", "en", "a"), (23, many.upper(), "en", "a"),
            (24, "A" * 11 + " b" * 100, "en", "a"), (25, "x y " * 70 + "#", None, "a"), (None, many, "en", "a")]
    labels = [*LABELS, (22, 1, 1), (23, 0, 1), (25, 1, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == brute(docs, labels)


def test_edges(spark):
    clash = ("part", "A", "E", "id_", "n", "good", "toxic", "digest_", "body_", "quality", "step", "kept")
    docs = edge_docs(spark).drop("n").select("*", *[F.lit("x").alias(c) for c in clash])
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").select("*", *[F.lit("x").alias(c) for c in ("A", "text", "lang", "id_", "n")])
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(docs, labels).collect()}
    assert got == brute(EDGE, LABELS)
    assert filter_audit.audit(empty_docs(spark), labels).count() == 0
    bare = filter_audit.audit(docs, labels.limit(0))
    assert bare.count() == len(got) and bare.where("good_lost + toxic_lost > 0").count() == 0


def test_selectors():
    """Each contraction against a sum over cells, with counts beyond 32 bits."""
    draw = np.random.default_rng(3)
    tensor = draw.integers(0, 2**45, (3, 2, 2, 2, 2, 2))
    picks = draw.integers(0, 3, (50, 5))
    for n, row in enumerate(picks):
        inside = np.ones((2, 2, 2, 2, 2), bool)
        for axis, pick in enumerate(row):
            keep = np.array([pick != filter_audit.FAIL, pick != filter_audit.PASS])
            inside &= keep.reshape([2 if a == axis else 1 for a in range(5)])
        assert (filter_audit.contract(tensor, picks)[:, n] == (tensor * inside).sum(axis=(1, 2, 3, 4, 5))).all()
