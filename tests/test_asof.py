"""Point-in-time values against a walk through each key's changes."""

from __future__ import annotations

import dataclasses
import datetime as dt
import random

from conftest import SMALL, rows

from accolade.operators import asof as AO
from accolade.plans import catalog
from accolade.plans import guest360 as G

DAY = dt.date(2000, 3, 15)
MOVES = "member_id long, id long, at date, old int, new int"


def random_moves(seed):
    draw = random.Random(seed)
    return [(m, i, DAY + dt.timedelta(days=draw.randrange(-6, 7)), draw.choice([None, 1, 2]), draw.choice([None, 3, 4]))
            for i, m in enumerate(draw.randrange(40) for _ in range(160))]


def held(moves, member, day):
    own = sorted((at, i, old, new) for m, i, at, old, new in moves if m == member)
    past = [x for x in own if x[0] <= day]
    return past[-1][3] if past else own[0][2] if own else None


def test_value_on_a_day(spark):
    moves = random_moves(1)
    df = spark.createDataFrame(moves + [(5, 999, None, 8, 9)], MOVES)
    got = AO.value_on(df, "member_id", "at", "id", "old", "new", DAY, "tier")
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == sorted(((m, held(moves, m, DAY)) for m in {m[0] for m in moves}), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_as_of_join_gives_each_fact_its_own_day(spark):
    """Facts before, between and after the changes, on a day of several changes, without key or day."""
    moves = random_moves(2)
    facts = [(n, n % 45, DAY + dt.timedelta(days=n % 17 - 8)) for n in range(500)] + [(500, None, DAY), (501, 3, None), (502, 3, DAY), (502, 3, DAY)]
    stretches = AO.intervals(spark.createDataFrame(moves, MOVES), "member_id", "at", "id", "old", "new", "tier")
    got = AO.as_of_join(spark.createDataFrame(facts, "id long, member_id long, day date"), "member_id", "day", stretches, "tier")
    want = [(i, m, d, None if m is None or d is None else held(moves, m, d)) for i, m, d in facts]
    assert rows(got) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_stretches_neither_overlap_nor_leave_gaps(spark):
    stretches = AO.intervals(spark.createDataFrame(random_moves(3), MOVES), "member_id", "at", "id", "old", "new", "tier").collect()
    by = {}
    for r in stretches:
        by.setdefault(r["member_id"], []).append((r["valid_from"], r["valid_to"]))
    for own in by.values():
        own.sort(key=lambda x: (x[0] is not None, x[0]))
        assert own[0][0] is None and own[-1][1] is None
        assert all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))


def test_a_back_test_sees_the_tier_of_its_day_only_if_strict(spark):
    run = catalog.recognition_run(spark, SMALL)
    strict = catalog.recognition_run(spark, SMALL, policy=dataclasses.replace(run.policy, strict_as_of=True))
    now = {r["player_id"]: (r["member_id"], r["tier_id"]) for r in run.guest_360.select("player_id", "member_id", "tier_id").collect()}
    then = {r["player_id"]: (r["member_id"], r["tier_id"]) for r in strict.guest_360.select("player_id", "member_id", "tier_id").collect()}
    today = {r["player_id"]: r["tier_id"] for r in run.staged["member"].collect()}
    assert set(now) == set(then) and all(t == today.get(g) for g, (_, t) in now.items())
    assert any(now[g] != then[g] for g in now)
    late = {r["player_id"] for r in run.staged["member"].where(f"enroll_date > date'{run.as_of}'").collect()}
    assert late and all(then[g] == (None, None) for g in late & set(then))
    assert G.members_on(run.staged, dt.date(1900, 1, 1)).count() == 0
