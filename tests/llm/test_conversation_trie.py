"""The prefix trie against its SQL and against a trie built turn by turn."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import compare as harness
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from accolade.llm import conversation_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_key(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(b"%08X" % len(role.encode()) + (role + text).encode()).digest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), turn_key(role, text), (role or "", text or "")))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    grown = {p for p in (m[:-1] for m in members if m)}
    for p, cs in members.items():
        if p:
            kids[p[:-1]] += 1
        more = (len(cs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += more
            leaves[p[:d]] += p not in grown
    return sorted(
        (cs[0], len(p), members[p[:-1]][0] if p else -1, len(cs), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in cs if len(paths[c]) == len(p)).encode()).hexdigest())
        for p, cs in members.items()
    )


def spark_trie(df):
    out = conversation_trie.trie(*conversation_trie.rebuilt(df)).na.fill({"parent_conv_id": -1})
    return sorted(tuple(r) for r in out.collect())


def test_query_matches_sql(spark, con):
    name = "op11_rollup_trie"
    assert harness.compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SMALL) is None


def long_and_shared():
    """Openings shared at every depth around the block borders, copies, and conversations of 8, 64,
    65 and 150 turns; families with and without a first conversation."""
    draw, rows = random.Random(5), []
    script = [("user" if i % 2 else "assistant", f"line {i} " + "w " * (i % 5)) for i in range(150)]
    for conv, n in enumerate([0, 1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 72, 73, 128, 150, 150, 64, 8, 8]):
        rows += [(conv, i, *t) for i, t in enumerate(script[:n])]
    for conv in range(20, 60):
        stop = draw.randrange(0, 90)
        rows += [(conv, i, *t) for i, t in enumerate(script[:stop])] + [(conv, 200 + i, "user", f"own {draw.randrange(2)}") for i in range(draw.randrange(4))]
    rows += [(conv, i, *t) for conv in range(61, 80) for i, t in enumerate(script[:3])]  # 60 is absent
    rows += [(100, i, "user", f"h{i}") for i in range(2)] + [(c, 0, "user", "one turn") for c in range(101, 120)]
    return rows


def test_long_conversations_go_on_in_further_blocks(spark):
    rows = long_and_shared()
    got = spark_trie(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert max(r[1] for r in got) == 150
    assert got == brute(rows)


def test_edges(spark):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, "user", "null turn first"), (1, 0, None, None), (1, 0, None, None),
        (1, 0, "user", "tie b"), (1, 0, "user", "tie a"), (2, 5, "", ""), (2, -3, "user", " \n\t"), (3, 0, "ab", "c"), (4, 0, "a", "bc"),
        (5, 1, "user", "Ünï 漢字 🙂 " * 4000), (6, 1, "user", "Ünï 漢字 🙂 " * 4000), (20, 0, "user", "only"), (23, 0, "user", "only"),
        (9_000_000_000_000_000_000, 0, "user", "large id"), (7, 3, "user", "x"), (7, 3, "user", "x"), (7, 3, "user", "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ("id", "pos", "key", "before", "t1", "n", "h", "m", "range_", "at_", "block", "ids", "base", "saved", "words", "n_convs")
    assert spark_trie(df.select("*", *[F.lit("x").alias(c) for c in clash])) == brute(rows)
    assert spark_trie(spark.createDataFrame([], SCHEMA)) == []


def test_turnless_conversations_end_at_the_root(spark):
    """A conversation whose own turns are all replaced by those of an absent first one is the root's."""
    without = [c for c in range(61, 80) if zlib.crc32(str(c).encode()) % 4 == 3]
    rows = [(c, i, "user", f"t{i}") for c in without for i in range(3)]
    got = spark_trie(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and len(got) == 1 and got[0][3] == len(without)


@pytest.mark.parametrize("copies", [9000])
def test_ids_of_a_large_group_of_copies(spark, copies):
    """More members than one piece of ids, which end at one node."""
    df = spark.range(copies).selectExpr("id * 20 as conv_id", "0L as turn", "'user' as role", "'same words here' as text")
    leaf = [r for r in spark_trie(df) if r[1] == 1]
    ids = ",".join(str(20 * i) for i in range(copies))
    assert [(r[0], r[3], r[6], r[7]) for r in leaf] == [(0, copies, 3 * (copies - 1), hashlib.sha256(ids.encode()).hexdigest())]
