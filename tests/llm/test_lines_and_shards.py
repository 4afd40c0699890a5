"""Line dedup and sharding against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import compare as harness
import pytest
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs, texts

import corpus_pipeline
from accolade.llm import interleave_shards, queries, site_lines


def test_line_query_matches_sql(spark, con):
    name = "op6_site_line_frequency"
    assert harness.compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SMALL) is None


def test_line_query_drops_something(spark):
    assert queries.op6_site_line_frequency(spark, "/root/testdata/sf0.01").where("n_dropped > 0").count() > 0


def test_lines_by_hand(spark):
    rows = [(i, f"menu \nown {i}\n\nmenu", "en", "a") for i in range(6)] + [(9, "menu\nown", "en", "b"), (10, "menu", "en", None)]
    df = spark.createDataFrame(rows + EDGE, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in site_lines.drop_lines(df, least_pages=5, ratio=0.4).collect()}
    assert got[0]["text"] == "own 0\n" and (got[0]["lines_"], got[0]["dropped_"]) == (4, 2)
    assert got[9]["text"] == "menu\nown" and got[10]["text"] == "menu"


def test_lines_edges(spark):
    out = site_lines.drop_lines(edge_docs(spark))
    assert out.columns[:-2] == edge_docs(spark).columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((d, t) for d, t, *_ in EDGE)
    assert site_lines.drop_lines(empty_docs(spark)).count() == 0


def test_copies_of_a_page_are_one_page_in_the_pipeline(spark):
    rows = [(i, "first of the copies\nsecond\nmenu", "en", "a", 1) for i in range(30)]
    rows += [(100 + i, f"own {i}\nmenu", "en", "a", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_site_lines(spark, df, SMALL).collect()}
    assert {got[i] for i in range(30)} == {"first of the copies\nsecond"}
    assert all(got[100 + i] == f"own {i}" for i in range(20))
    share = {r["line"]: (r["pages"], r["site_pages"]) for r in site_lines.boilerplate(df, once=True).collect()}
    assert share == {"menu": (21, 21)}


def brute_shards(docs, shards):
    number = lambda v: int(hashlib.md5(f"2026:{'' if v is None else v}".encode()).hexdigest()[:15], 16)
    by = defaultdict(list)
    for doc, text, source in docs:
        body = (text or "").encode()
        name = "0" if source is None else f"1{source}"
        by[name].append((number(doc), (doc is not None, doc or 0), len(body) + 1, zlib.crc32(body), doc))
    placed = [
        ((rank + number(name) / 2**60) / len(rows), name, rank, r)
        for name, rows in by.items() for rank, r in enumerate(sorted(rows))
    ]
    n, out, slots = len(placed), [], Counter()
    for pos, (*_, r) in enumerate(sorted(placed)):
        shard = pos * shards // n
        out.append((r[4], r[2], r[3], shard, slots[shard]))
        slots[shard] += 1
    return out


def test_shard_query_against_plain_python(spark, con):
    got = queries.op10_stratified_interleaving(spark, SMALL)
    assert got.where("law <> 'rows' or grown_shard is not null").count() == 0
    assert dict(got.dtypes)["slot"] == "bigint"
    rows = [tuple(r) for r in got.select("doc_id", "size", "text_crc32", "shard", "slot").collect()]
    assert sorted(rows) == sorted(brute_shards(texts(con), 16))


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_match_the_mixture(spark, shards):
    df = spark.range(1000).selectExpr("id as doc_id", "'x' as text", "if(id % 3 = 0, 'hot', concat('s', id % 50)) as source")
    rows = interleave_shards.interleave(df, shards).join(df, "doc_id").collect()
    sizes, mix = Counter(r["shard"] for r in rows), Counter((r["shard"], r["source"]) for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(abs(mix[s, "hot"] - 334 / shards) <= 4 for s in range(shards))
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, i) for s in sizes for i in range(sizes[s])}


def test_shard_edges(spark):
    got = interleave_shards.interleave(edge_docs(spark), 4).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute_shards([(d, t, s) for d, t, _, s in EDGE], 4)))
    assert interleave_shards.interleave(empty_docs(spark)).count() == 0
    alone = spark.range(500).selectExpr("id as doc_id", "'x' as text", "cast(id as string) as source")
    assert interleave_shards.interleave(alone).groupBy("shard").count().where("count not in (31, 32)").count() == 0
