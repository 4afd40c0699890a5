"""The pipeline against a plain version of each stage; toxicity on held-out and made rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs
from test_minmax_dedup import brute as near
from test_suffix_dedup import brute as repeats
from test_tokens_and_packing import check_packs, wanted

import corpus_pipeline
from accolade.llm import queries, toxicity
from accolade.llm.site_lines import LEAST_PAGES, RATIO

MEDIUM = "/root/testdata/sf0.01"


def lines(rows):
    """(doc, text, source) without lines on too many pages of a source."""
    strip, pages, counts = " \t\r\n", Counter(s for *_, s in rows), defaultdict(Counter)
    for _, text, source in rows:
        counts[source].update({x.strip(strip) for x in (text or "").split("\n")} - {""})
    bad = {s: {x for x, n in c.items() if n >= LEAST_PAGES and n / pages[s] > RATIO} for s, c in counts.items()}
    return [(d, None if t is None else "\n".join(x for x in t.split("\n") if x.strip(strip) not in bad[s]), s) for d, t, s in rows]


def test_stages_against_plain_versions(spark, con):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    machine = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    place = toxicity._places(machine.terms)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    rows = [r for r in rows if machine.score(np.array(sorted(place(r[1])), int)) < 0.3]
    rows = lines(rows)
    kept = {d for d, _, _, k in near(rows) if k}
    rows = sorted(r for r in rows if r[0] in kept)
    rows = [(d, k.decode("utf-8", "ignore")) for (d, *_), (_, _, k) in zip(rows, repeats([t for _, t, _ in rows], 200), strict=True)]
    check_packs(corpus_pipeline.run(spark, SMALL).collect(), 4096, wanted(rows, 4096))


def test_stages_keep_the_columns_and_take_edges(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        docs = docs.selectExpr("*", "cast(length(text) as long) as n_chars")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
            assert docs.where("n_chars <> length(text)").count() == 0
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_near_stage_keeps_one_of_each_group(spark, con):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()]
    rows = con.execute("SELECT doc_id, text, source FROM documents").fetchall()
    assert sorted(kept) == sorted(d for d, _, _, k in near(rows) if k)


def labelled(n, seed):
    """Texts that are toxic only if an insult meets a group; each alone is clean."""
    r, rows = random.Random(seed), []
    common = [f"word{i}" for i in range(300)]
    for i in range(n):
        own, insult, group = r.choices(common, k=r.randrange(5, 60)), r.random() < 0.5, r.random() < 0.5
        own += ["dolt"] * insult + ["martian"] * group
        r.shuffle(own)
        rows.append((seed * 100_000 + i, " ".join(own), int(insult and group)))
    return rows


def test_pairs_of_terms_count(spark):
    rows = labelled(3000, 1)
    docs, labels = (spark.createDataFrame(rows, "doc_id long, text string, toxic int").select("doc_id", c) for c in ("text", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, *_ in rows)
    held = [(got[d]["predicted"], y) for d, _, y in rows if got[d]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.97


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    ahead = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert ahead > 0.95
    assert np.mean([s >= 0.3 for s in toxic]) > 0.8 and np.mean([s >= 0.3 for s in clean]) < 0.02


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0), (None, 1)], [(1, None), (3, 1)]])
def test_toxicity_edges(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.scored(edge_docs(spark), table).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in EDGE)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert toxicity.scored(empty_docs(spark), table).count() == 0


def test_query_names():
    assert {int(n[2:].split("_")[0]) for n in queries.queries() if n != "pipeline"} == set(range(1, 14))
