"""Generic operators on hand-made rows and against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from accolade.operators import entity_day as ED
from accolade.operators import events as EV
from accolade.operators import joins as J
from accolade.operators import quality as Q
from accolade.operators import rules as RU
from accolade.operators import signals as SG
from accolade.operators import windows as W
from accolade.plans import catalog
from accolade.policy import Policy
from accolade.sources import readers

D = dt.date
AS_OF = D(2000, 3, 15)
POLICY = Policy(as_of_date=AS_OF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def days(spark, data):
    return spark.createDataFrame(data, "player_id long, activity_date date, visit_flag int")


def test_streaks(spark):
    data = [(1, D(2000, 1, 5), 1), (1, D(2000, 1, 20), 1), (1, D(2000, 2, 1), 1), (1, D(2000, 3, 1), 0),
            (1, D(2000, 4, 9), 1), (2, D(1999, 11, 30), 1), (2, D(1999, 12, 1), 1), (2, D(2000, 1, 31), 1)]
    got = rows(ED.month_streaks(days(spark, data), F.col("visit_flag") == 1), "player_id", "first_visit_in_month",
               "streak_months")
    assert got == sorted([
        (1, D(2000, 1, 5), 1), (1, D(2000, 2, 1), 2), (1, D(2000, 4, 9), 1),
        (2, D(1999, 11, 30), 1), (2, D(1999, 12, 1), 2), (2, D(2000, 1, 31), 3),
    ], key=lambda t: tuple((False, str(v)) for v in t))


def brute_streaks(data):
    out = set()
    for key in {k for k, _, _ in data}:
        visits = sorted(d for k, d, v in data if k == key and v)
        months = sorted({(d.year, d.month) for d in visits})
        for y, m in months:
            n, at = 0, (y, m)
            while at in months:
                n, at = n + 1, (at[0], at[1] - 1) if at[1] > 1 else (at[0] - 1, 12)
            out.add((key, min(d for d in visits if (d.year, d.month) == (y, m)), n))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_streaks_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    picked = {(rnd.randrange(6), D(1999, 1, 1) + dt.timedelta(days=rnd.randrange(900))) for _ in range(150)}
    data = [(k, d, rnd.randrange(2)) for k, d in picked]
    got = ED.month_streaks(days(spark, data), F.col("visit_flag") == 1)
    assert set(map(tuple, got.select("player_id", "first_visit_in_month", "streak_months").collect())) == brute_streaks(data)


def test_entity_day_sums_all_sources_and_flags_visits(spark):
    a = spark.createDataFrame([(1, D(2000, 1, 1), 5), (1, D(2000, 1, 1), None)], "k long, d date, x int")
    b = spark.createDataFrame([(1, D(2000, 1, 2), 7)], "k long, d date, y int")
    got = ED.entity_day(
        [ED.Contribution(a, "k", "d", {"n": "1", "x": "x"}), ED.Contribution(b, "k", "d", {"y": "y"})],
        ["n", "x", "y"], ["n"],
    )
    assert rows(got, "activity_date", "n", "x", "y", "visit_flag") == [
        (D(2000, 1, 1), 2, 5, 0, 1), (D(2000, 1, 2), 0, 0, 7, 0)
    ]
    with pytest.raises(ValueError, match="not registered"):
        ED.zero_filled(["n"], {"m": "1"})


def test_running_totals_need_one_exchange(spark):
    daily = spark.createDataFrame(
        [(1, D(2000, 1, 1), 2, 1), (1, D(2000, 1, 5), 0, 0), (1, D(2000, 1, 9), 3, 1)],
        "player_id long, activity_date date, x int, visit_flag int",
    )
    totals = ED.with_streaks(ED.running_totals(daily, {"life": "x"}), F.col("visit_flag") == 1)
    assert rows(totals, "cum_life", "prior_activity_date", "streak_months") == sorted(
        [(2, None, 1), (2, D(2000, 1, 1), None), (5, D(2000, 1, 5), None)],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
    assert plan(totals).count("Exchange hashpartitioning") == 1


def test_unpivot_skips_days_without_growth(spark):
    totals = spark.createDataFrame(
        [(1, D(2000, 1, 1), 0, 0, 4, 9), (1, D(2000, 1, 2), 3, 3, 0, 9)],
        "player_id long, activity_date date, x int, cum_a int, y int, cum_b int",
    )
    got = rows(EV.unpivot_cumulative(totals, {"a": "x", "b": "y"}), "event_date", "metric_name", "metric_value", "prior_value")
    assert got == [(D(2000, 1, 1), "b", 9.0, 5.0), (D(2000, 1, 2), "a", 3.0, 0.0)]


def test_calendar_leap_day_and_window(spark):
    people = spark.createDataFrame([(1, D(2000, 2, 29)), (2, None), (3, D(1980, 6, 1))], "player_id long, date_of_birth date")
    got = rows(EV.birthday_events(people, D(2001, 2, 28), 45), "player_id", "event_date", "metric_name", "metric_value")
    assert got == [(1, D(2001, 2, 28), "age_at_birthday", 1.0), (1, D(2001, 2, 28), "birthday", 1.0)]
    members = spark.createDataFrame([(1, D(2001, 1, 20)), (2, D(1999, 12, 30)), (3, D(1990, 4, 30))],
                                    "player_id long, enroll_date date")
    got = rows(EV.membership_events(members, D(2001, 1, 10), 12), "player_id", "event_date", "metric_value")
    assert got == [(2, D(2000, 12, 30), 1.0)]  # no anniversary in the year of joining


RULES = [("A10", "A", "m", 10.0, 1), ("A25", "A", "m", 25.0, 1), ("A50", "A", "m", 50.0, 0), ("B10", "B", "m", 10.0, 1)]


def rule_frame(spark, data=RULES):
    base = spark.createDataFrame(data, "rule_id string, milestone_family string, metric_name string, threshold double, is_active int")
    other = {"milestone_name": F.col("rule_id"), "reward_type": F.lit("NonGaming"), "reward_budget_usd": F.lit(5.0),
             "action_owner": F.lit("Host"), "priority_weight": F.lit(40), "recommended_action": F.lit("act"),
             "talking_point": F.lit("hi"), "lead_days": F.lit(1), "recognition_window_days": F.lit(3)}
    return base.withColumns(other)


def event_frame(spark, data):
    return spark.createDataFrame(data, "player_id long, event_date date, metric_name string, metric_value double, prior_value double")


def test_only_the_highest_threshold_of_a_family(spark):
    events = event_frame(spark, [(1, AS_OF, "m", 30.0, 0.0), (2, AS_OF, "m", 10.0, 9.0), (3, AS_OF, "m", 12.0, 10.0),
                                 (4, AS_OF, "other", 99.0, 0.0), (5, AS_OF, "m", 60.0, 40.0)])
    got = rows(RU.milestones(events, rule_frame(spark)), "player_id", "rule_id", "achieved_value")
    assert got == [(1, "A25", 30.0), (1, "B10", 30.0), (2, "A10", 10.0), (2, "B10", 10.0)]


def test_large_catalogs_are_salted_not_broadcast(spark):
    rnd = random.Random(5)
    data = [(rnd.randrange(40), AS_OF - dt.timedelta(days=rnd.randrange(50)), "m", float(rnd.randrange(40, 60)),
             float(rnd.randrange(0, 40))) for _ in range(300)]
    events, rules = event_frame(spark, data), rule_frame(spark)
    small = RU.cross_thresholds(events, rules)
    salted = RU.cross_thresholds(events, rules, max_rows=1, salts=4)
    assert rows(small) == rows(salted.select(*small.columns))
    whole = RU.milestones(events, rules)
    assert rows(whole) == rows(RU.milestones(events, rules, max_rows=1))
    assert "SortAggregate" not in whole._jdf.queryExecution().executedPlan().toString()
    best = {}
    for r in small.collect():
        key = (r["player_id"], r["milestone_family"], r["event_date"])
        best[key] = min(best.get(key, (0.0, "~", 0.0)), (-r["threshold"], r["rule_id"], -r["metric_value"]))
    assert rows(whole, "player_id", "milestone_family", "event_date", "rule_id", "achieved_value") == sorted(
        ((*k, i, -v) for k, (_, i, v) in best.items()), key=lambda t: tuple((v is None, str(v)) for v in t))


def join_rows(df):
    """Rows that the joins of a plan put out, by its own counters."""
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    found, todo = [], [executed.executedPlan() if "Adaptive" in executed.getClass().getName() else executed]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getName():
            node = node.plan()
        if "Join" in node.nodeName():
            found.append(node.metrics().get("numOutputRows").get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_ten_thousand_rules_meet_only_what_is_crossed(spark):
    rnd = random.Random(11)
    rules = [(f"R{i:05}", f"F{i % 7}", f"m{i % 3}", float(rnd.randrange(1, 4000)) / 2, 1) for i in range(10_000)]
    rules += [("none", "F0", "m0", None, 1), ("off", "F0", "m0", 5.0, 0)]
    data = [(i, AS_OF, rnd.choice(["m0", "m1", "m2", "other"]), *sorted((rnd.randrange(0, 4400) / 2, rnd.randrange(0, 4400) / 2), reverse=True)[:2])
            for i in range(400)]
    data = [(k, d, m, v, v - rnd.choice([0.0, 0.5, 1.0, 20.0])) for k, d, m, v, _ in data]
    data += [(900, AS_OF, "m0", 5000.0, -1.0), (901, AS_OF, "m0", 0.0, 0.0), (902, AS_OF, None, 9.0, 0.0), (903, AS_OF, "m1", None, 0.0), (904, AS_OF, "m1", 9.0, None)]
    crossed = RU.cross_thresholds(event_frame(spark, data), rule_frame(spark, rules))
    want = sorted((k, r) for k, _, m, v, p in data for r, _, rm, t, on in rules
                  if on and None not in (t, m, v, p) and rm == m and p < t <= v)
    assert [tuple(r) for r in sorted(crossed.select("player_id", "rule_id").collect())] == want
    assert join_rows(crossed) == [len(want)]


def test_an_empty_catalog(spark):
    events = event_frame(spark, [(1, AS_OF, "m", 30.0, 0.0)])
    off = rule_frame(spark, [("A", "A", "m", 1.0, 0)])
    assert RU.cross_thresholds(events, off).count() == 0 and RU.milestones(events, off).count() == 0


def test_a_family_of_several_metrics(spark):
    rule = dict(lead_days=0, recognition_window_days=5, reward_type="PersonalNote", reward_budget_usd=1.0, action_owner="h",
                priority_weight=1, recommended_action="a", talking_point="t", milestone_name="n", is_active=1, milestone_family="F")
    rules = spark.createDataFrame([{**rule, "rule_id": i, "metric_name": m, "threshold": t} for i, m, t in (
        ("P", "m", 10.0), ("Q", "k", 20.0), ("R", "k", 20.0))], readers.RULE_SCHEMA)
    events = event_frame(spark, [(1, AS_OF, "m", 900.0, 0.0), (1, AS_OF, "k", 21.0, 0.0), (2, AS_OF, "m", 11.0, 0.0)])
    got = rows(RU.milestones(events, rules), "player_id", "rule_id", "achieved_value")
    assert got == [(1, "Q", 21.0), (2, "P", 11.0)]


def test_actionable_window_edges(spark):
    ms = spark.createDataFrame([(o, AS_OF + dt.timedelta(days=o), 1, 3) for o in (-4, -3, 0, 1, 2)],
                               "o int, event_date date, lead_days int, recognition_window_days int")
    assert rows(RU.actionable(ms, AS_OF), "o", "days_since_event") == sorted(
        [(-3, 3), (0, 0), (1, -1)], key=lambda t: tuple((False, str(v)) for v in t)
    )


def test_trailing_window_is_open_below(spark):
    df = spark.createDataFrame([(1, AS_OF - dt.timedelta(days=n)) for n in (0, 13, 14)], "k int, d date")
    assert W.trailing_agg(df, "k", "d", AS_OF, 14, {"n": F.count("*")}).first()["n"] == 2
    assert W.trailing_agg(df, "k", "d", AS_OF, 15, {"n": F.count("*")}, lag_days=13).first()["n"] == 2


def activity(spark, data):
    return spark.createDataFrame(
        data, "player_id long, activity_date date, gaming_sessions int, actual_win decimal(18,2), gaming_minutes int"
    )


def test_anomaly_flags(spark):
    from decimal import Decimal as M

    past = AS_OF - dt.timedelta(days=10)
    got = rows(SG.baseline_anomaly(activity(spark, [
        (1, AS_OF, 1, M("2500"), 10),                                # no history: floor of 1
        (2, AS_OF, 1, M("2499.99"), 599),
        (3, AS_OF, 1, M("0"), 600),
        (4, AS_OF, 1, M("2600"), 10), (4, past, 1, M("900"), 10),    # below three times the norm
        (5, AS_OF, 1, M("1300"), 10), (5, AS_OF - dt.timedelta(days=1), 1, M("1300"), 10),
        (6, AS_OF - dt.timedelta(days=2), 1, M("9000"), 900),        # outside the recent window
    ]), AS_OF, POLICY), "player_id", "rg_review_flag", "rg_reason")
    norm, play = "losses well above guest norm", "extended play time"
    assert got == [(1, True, norm), (2, False, None), (3, True, play), (4, False, None), (5, True, norm)]


def test_budget_window_edges(spark):
    spend = spark.createDataFrame([(1, AS_OF - dt.timedelta(days=n), 10.0) for n in (-1, 0, 13, 14, 29, 30)],
                                  "member_id long, comp_date date, comp_amount double")
    got = SG.trailing_budget(spend, AS_OF, POLICY).first()
    assert (got["comps_cooldown_usd"], got["comps_window_usd"], got["last_comp_date"]) == (20.0, 40.0, AS_OF)


def test_favorite_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (2, "a", None), (2, "z", 1), (3, None, 2)], "k int, v string, w int")
    assert rows(W.favorite(df, "k", ["v"], "w")) == [(1, "a"), (2, "z"), (3, None)]


def test_latest_in_interval(spark):
    stays = spark.createDataFrame(
        [(1, D(2000, 3, 10), AS_OF, 1, "left today"), (2, AS_OF, D(2000, 3, 16), 2, "new"),
         (2, D(2000, 3, 1), D(2000, 3, 20), 3, "old"), (2, AS_OF, D(2000, 3, 18), 4, "tie, larger id"), (None, AS_OF, D(2000, 3, 17), 5, "x")],
        "k long, s date, e date, id long, t string",
    )
    assert rows(W.latest_in_interval(stays, "k", "s", "e", AS_OF, "id"), "k", "t") == [(2, "tie, larger id")]


def test_packed_orders_against_brute_force(spark):
    """Negative, NULL and wide weights and ids, days before 1970, timestamps to the microsecond."""
    rnd = random.Random(4)
    data = []
    for i in range(400):
        day = rnd.choice([None, D(1969, 12, 31), D(1, 1, 1), D(9999, 12, 31), AS_OF, D(1970, 1, 1)])
        at = None if day is None else dt.datetime(2000, 1, 1, 0, 0, 0, rnd.randrange(3))
        data.append((i % 40, rnd.choice(["a", "b", "Ä", None, ""]), rnd.choice([None, -(10**17), -1, 0, 7, 10**17]), day, at,
                     rnd.choice([-(2**63), -5, 0, 2**63 - 1 - i]) + i % 2, i))
    df = spark.createDataFrame(data, "k long, v string, w long, d date, t timestamp, id long, i long")
    per_value = {}
    for k, v, w, *_ in data:
        per_value.setdefault((k, v), []).append(w)
    sums = {kv: sum(w for w in ws if w is not None) if any(w is not None for w in ws) else None for kv, ws in per_value.items()}
    best = {}
    for (k, v), w in sums.items():
        best.setdefault(k, []).append(((w is None, -(w or 0)), (v is None, (v or "").encode()), v))
    weights = df.groupBy("k", "v").agg(F.sum(F.col("w").cast("decimal(20,2)")).alias("w"))
    liked = W.favorite(weights, "k", ["v"], "w")
    assert rows(liked, "k", "v") == sorted(((k, min(c)[2]) for k, c in best.items()), key=lambda t: tuple((x is None, str(x)) for x in t))
    for at, place in (("d", 3), ("t", 4)):
        newest = {}
        for r in data:
            newest.setdefault(r[0], []).append(((r[place] is not None, r[place] or 0), r[5], r[6]))
        latest = W.latest_value(df, "k", at, "id", "i")
        top = {k: max(c, key=lambda x: x[:2])[:2] for k, c in newest.items()}
        assert "SortAggregate" not in plan(latest) and plan(latest).count("HashAggregate") == 2
        assert all(any(c[:2] == top[r["k"]] and c[2] == r["i"] for c in newest[r["k"]]) for r in latest.collect())
    assert "SortAggregate" not in plan(liked)
    with pytest.raises(ValueError, match="packed"):
        W.favorite(df.select("k", "v", F.col("w").cast("double").alias("w")), "k", ["v"], "w")


def test_latest_day_shares_the_window_that_made_the_rows(spark):
    daily = spark.createDataFrame([(1, D(2000, 1, 1), 2), (1, D(2000, 1, 5), 0), (2, D(2001, 1, 9), 3), (1, D(2002, 1, 1), 9)],
                                  "player_id long, activity_date date, x int")
    latest = W.latest_per_key(ED.running_totals(daily, {"life": "x"}), "player_id", "activity_date", D(2001, 12, 31))
    assert rows(latest, "player_id", "activity_date", "cum_life") == [(1, D(2000, 1, 5), 2), (2, D(2001, 1, 9), 3)]
    assert plan(latest).count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan(latest)


@pytest.mark.parametrize("name", ["favorite_game", "favorite_outlet", "latest_snapshot", "property_today", "in_house", "entity_360"])
def test_no_sort_aggregates(spark, name):
    assert "SortAggregate" not in plan(catalog.queries()[name](spark, SMALL))


def test_fold_rest_with_null_texts(spark):
    df = spark.createDataFrame([(1, 3.0, None), (1, 2.0, "b"), (1, 1.0, None), (2, 2.0, "x"), (2, 1.0, None), (3, 1.0, None)],
                               "k int, score double, name string")
    folded = W.fold_rest(df, "k", [F.col("score").desc()], "name", "rest")
    assert "Aggregate" not in plan(folded) and plan(folded).count("Exchange") == 1
    assert {r["k"]: (r["name"], r["rest"]) for r in folded.collect()} == {1: (None, "b"), 2: ("x", None), 3: (None, None)}


def test_fold_rest(spark):
    df = spark.createDataFrame([(1, 9.0, "a"), (1, 5.0, "b"), (1, 7.0, "c"), (2, 1.0, "d")], "k int, score double, name string")
    got = rows(W.fold_rest(df, "k", [F.col("score").desc()], "name", "rest"), "k", "name", "rest")
    assert got == [(1, "a", "c, b"), (2, "d", None)]


@pytest.mark.parametrize("n", [2, 25])
def test_top_n_prunes_before_the_exchange(spark, n):
    df = spark.range(1000).select((F.col("id") % 3 != 0).alias("part"), F.col("id"))
    top = W.top_n(df, "part", [F.col("id").desc()], n, "rank", salt_by="id")
    best = {p: sorted((i for i in range(1000) if (i % 3 != 0) == p), reverse=True)[:n] for p in (True, False)}
    assert {(r["part"], r["id"], r["rank"]) for r in top.collect()} == {
        (p, i, k + 1) for p, ids in best.items() for k, i in enumerate(ids)
    }
    before, after = plan(top).split("Exchange hashpartitioning")[:2]
    assert "WindowGroupLimit" in after


def test_top_n_beyond_the_group_limit_is_salted(spark):
    df = spark.range(5000).select(F.lit(1).alias("part"), F.col("id"))
    top = W.top_n(df, "part", [F.col("id").asc()], 1500, "rank", salt_by="id", salts=8)
    assert rows(top.agg(F.count("*"), F.max("id"), F.max("rank"))) == [(1500, 1499, 1500)]
    assert "_salt" in plan(top)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.001, 0.2, 0.9])
def test_lookup_join_with_a_hot_key(spark, how, share):
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 != 1, F.col("id")).alias("k")
    )
    lookup = spark.range(0, 700).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = J.lookup_join(facts, lookup, "k", how, J.hot_keys(facts, "k", share))
    assert rows(got, "id", "k", "v") == rows(facts.join(lookup, "k", how), "id", "k", "v")
    hot = J.hot_keys(facts, "k", 0.2)
    assert hot == [0]


def test_quality_checks_find_planted_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, None)], "id int, kind string")
    assert rows(Q.check_unique(df, "id")) == [(1, 2)]
    assert rows(Q.check_unique(df, "id", "kind")) == [(None, "c", 2)]
    assert Q.check_not_null(df, "id").count() == 2
    assert rows(Q.check_accepted_values(df, "kind", ["a", "b"])) == [("c", 2)]
    assert rows(Q.check_relationships(df, "id", spark.createDataFrame([(2,)], "pid int"), "pid")) == [(1, 2)]
    report = Q.run_checks([Q.TableChecks("t", df, {"not_null(id)": F.col("id").isNull()}, [("id",), ("id", "kind")],
                                         {"extra": df.limit(1)})])
    assert {(r["check"], r["violations"]) for r in report.collect()} == {
        ("not_null(id)", 2), ("unique(id)", 1), ("unique(id, kind)", 1), ("extra", 1)
    }


def test_business_rule_checks_find_planted_rows(spark):
    recs = spark.createDataFrame(
        [("ok", 1, False, "GamingOffer", 5.0, 10.0, "RECOMMEND", "hello"),
         ("offer", 2, True, "GamingOffer", 0.0, 10.0, "INELIGIBLE", "hello"),
         ("money", 3, True, "PersonalNote", 1.0, 10.0, "RG_CHECK_IN", f"about {POLICY.check_in_phrase}?"),
         ("over", 4, False, "NonGaming", 20.0, -10.0, "RECOMMEND", "hello"),
         ("script", 5, True, "PersonalNote", 0.0, 10.0, "RG_CHECK_IN", "well done!")],
        "recommendation_id string, player_id long, rg_review_flag boolean, final_reward_type string, "
        "approved_reward_usd double, remaining_budget_usd double, recommendation_status string, talking_point string",
    )
    ids = lambda df: sorted(r["recommendation_id"] for r in df.collect())
    assert ids(Q.check_no_incentive_when_flagged(recs)) == ["money", "offer"]
    assert ids(Q.check_reward_within_budget(recs)) == ["over"]
    assert ids(Q.check_script_match(recs, POLICY.check_in_phrase)) == ["script"]
    guests = spark.createDataFrame([(1, True, None), (4, False, "banned")], "player_id long, is_eligible boolean, ineligible_reason string")
    assert rows(Q.check_excludes_ineligible(recs, guests)) == [(4, "banned")]
    assert rows(Q.check_one_row_per_key(recs.unionByName(recs.limit(1)), "player_id")) == [(1, 2)]


def test_normalized_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "PlayerID int, game_date int, HOMEPROPERTYID int")
    assert readers.select_normalized(df, ["player_id", "game_date", "home_property_id"]).columns == [
        "player_id", "game_date", "home_property_id"
    ]
    with pytest.raises(ValueError, match="email.*columns present: PlayerID, game_date"):
        readers.select_normalized(df, ["player_id", "email"])


def test_live_rows(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, _deleted boolean")
    assert rows(readers.live_rows(df), "id") == [(2,), (3,)]
    assert readers.live_rows(df.drop("_deleted")).count() == 3
    assert rows(readers.live_rows(df.withColumnRenamed("_deleted", "gone"), "gone"), "id") == [(2,), (3,)]
    for name in ("IsDeleted", "_LOADER_DELETED", "_deleted"):
        assert rows(readers.live_rows(df.withColumnRenamed("_deleted", name), POLICY.deleted_flags), "id") == [(2,), (3,)]
    both = df.withColumn("is_deleted", F.col("id") == 2)
    assert rows(readers.live_rows(both, POLICY.deleted_flags, required=True), "id") == [(3,)]
    with pytest.raises(ValueError, match="soft-delete"):
        readers.live_rows(df.drop("_deleted"), POLICY.deleted_flags, required=True)


@pytest.mark.parametrize("hours,status", [(2, "pass"), (2.5, "warn"), (24, "warn"), (24.1, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2000, 1, 10)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (now - dt.timedelta(days=9),)], "t timestamp_ntz")
    got = readers.freshness(df, "t", now).first()
    assert (got["status"], round(got["age_hours"], 3)) == (status, hours)


def test_freshness_of_an_empty_table_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert readers.freshness(df, "t", dt.datetime(2000, 1, 1)).first()["status"] == "error"
