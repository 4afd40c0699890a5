"""The pipeline on a few hand-made landed tables, and its sinks."""

from __future__ import annotations

import dataclasses
import datetime as dt
import time
import uuid
from decimal import Decimal as M
from pathlib import Path

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.operators import signals as SG
from accolade.operators import windows as W
from accolade.plans import catalog
from accolade.plans.pipeline import ChecksFailed, CutBySteps, Recognition, TablesKept, build, cutting, publish_staging
from accolade.policy import Policy
from accolade.sources import readers, sinks
from accolade.sources.staging import SOURCE_COLUMNS

D = dt.date
AS_OF = D(2000, 3, 15)
T = lambda d, h=12: dt.datetime.combine(d, dt.time(h))

SCHEMAS = {
    "player": "player_id long, first_name string, last_name string, date_of_birth date, home_property_id int, "
              "player_status string, vip_flag boolean, created_at timestamp_ntz",
    "player_session": "session_id long, player_id long, property_id int, game_category string, gaming_date date, "
                      "start_time timestamp_ntz, end_time timestamp_ntz, minutes_played int, cash_in decimal(18,2), "
                      "cash_out decimal(18,2), coin_in_or_action decimal(18,2), average_bet decimal(18,2), "
                      "theoretical_win decimal(18,2), actual_win decimal(18,2), points_awarded int",
    "jackpot": "jackpot_id long, asset_id long, player_id long, jackpot_date_time timestamp_ntz, amount decimal(18,2), "
               "jackpot_type string",
    "member": "member_id long, player_id long, member_number string, tier_id int, enroll_date date, "
              "enroll_property_id int, points_balance long, tier_credits_ytd long, member_status string, "
              "last_activity_date date, email_opt_in boolean, sms_opt_in boolean",
    "tier": "tier_id int, tier_name string, tier_credits_required int, point_multiplier double",
    "tier_history": "tier_history_id long, member_id long, old_tier_id int, new_tier_id int, change_date date, "
                    "change_reason string",
    "comp": "comp_id long, member_id long, property_id int, comp_date_time timestamp_ntz, comp_category string, "
            "comp_amount decimal(18,2), authorized_by_employee_id long",
    "check": "check_id long, outlet_id int, member_id long, opened_at timestamp_ntz, closed_at timestamp_ntz, "
             "guest_count int, subtotal decimal(18,2), total_amount decimal(18,2), check_status string",
    "outlet": "outlet_id int, property_id int, outlet_name string, outlet_type string",
    "reservation": "reservation_id long, player_id long, property_id int, arrival_date date, departure_date date, "
                   "nightly_rate decimal(18,2), is_comp boolean, reservation_status string",
    "property": "property_id int, property_code string, property_name string",
}


def player(i, status="Active", born=D(1960, 7, 1)):
    return (i, f"G{i}", "X", born, 1, status, None, None)


def member(i, tier=1):
    return (i + 100, i, f"M{i}", tier, D(1995, 8, 1), 1, 0, 0, "Active", None, None, None)


def session(i, p, day, minutes=60, theo="0", loss="0", prop=1):
    z = M(0)
    return (i, p, prop, "Slots", day, T(day), T(day), minutes, z, z, z, z, M(theo), M(loss), 0)


def check(i, m, day, spend, status="Closed", hour=12):
    return (i, 1, m, None, T(day, hour), 1, M(spend), M(spend), status)


def landed(spark, **data):
    base = {"tier": [(1, "Silver", 0, 1.0), (2, "Gold", 0, 1.0), (3, "Platinum", 0, 1.0)],
            "outlet": [(1, 1, "Grill", "Restaurant")], "property": [(1, "ONE", "One"), (2, "TWO", "Two")]}
    base.update(data)
    return {n: spark.createDataFrame(base.get(n, []), s) for n, s in SCHEMAS.items()}


def run(spark, policy=Policy(as_of_date=AS_OF), **data):
    return Recognition(
        landed(spark, **data),
        readers.shipped_seed(spark, "sample_rules.csv", readers.RULE_SCHEMA),
        readers.shipped_seed(spark, "tier_budgets.csv", readers.BUDGET_SCHEMA),
        policy,
    )


def test_activity_day_rules(spark):
    day = D(2000, 3, 1)
    r = run(
        spark,
        player=[player(1)], member=[member(1)],
        player_session=[session(1, 1, day, theo="10.50")],
        check=[check(1, 101, day, "20.25"), check(2, 101, day, "9", "Open"), check(3, None, day, "8"),
               check(4, 999, day, "7"), check(5, 101, day, "1.75", hour=5)],
        jackpot=[(1, 1, 1, T(D(2000, 3, 3)), M("500"), "x"), (2, 1, None, T(day), M("9"), "x")],
        reservation=[(1, 1, 1, day, D(2000, 3, 4), M("100"), True, "CheckedOut"),
                     (2, 1, 1, D(2000, 3, 5), D(2000, 3, 7), M("100"), None, "InHouse"),
                     (3, 1, 1, D(2000, 3, 9), D(2000, 3, 10), M("100"), False, "Cancelled")],
    )
    got = rows(r.activity, "activity_date", "gaming_sessions", "dining_checks", "dining_spend", "hotel_nights",
               "hotel_revenue", "jackpot_amount", "visit_flag")
    z = M("0.00")
    assert got == [
        (D(2000, 2, 29), 0, 1, M("1.75"), 0, z, z, 1),    # closed at five: the day before
        (day, 1, 1, M("20.25"), 3, z, z, 1),              # comped stay: nights, no revenue
        (D(2000, 3, 3), 0, 0, z, 0, z, M("500.00"), 0),   # jackpot only: not a visit
        (D(2000, 3, 5), 0, 0, z, 2, M("200.00"), z, 1),
    ]
    prior = {x["activity_date"]: x["prior_activity_date"] for x in r.cumulative.collect()}
    assert prior[D(2000, 3, 5)] == D(2000, 3, 3)  # a jackpot-only day still counts as the prior day


def test_tier_moves(spark):
    move = lambda i, old, new, d=D(2000, 3, 10): (i, 101, old, new, d, "x")
    r = run(spark, player=[player(1)], member=[member(1)],
            tier_history=[move(1, None, 1), move(2, 3, 2), move(3, 1, 3), move(4, 1, 3), move(5, 1, 2)])
    events = rows(r.metric_events.where("metric_name = 'tier_level'"), "metric_value", "prior_value")
    assert events == [(2.0, 1.0), (3.0, 1.0), (3.0, 1.0)]
    assert rows(r.milestones.where("milestone_family = 'TIER_UPGRADE'"), "rule_id") == [("TIER_UPGRADE_3",)]


def test_exact_threshold_fires_once(spark):
    days = [D(2000, 3, d) for d in (1, 2, 3)]
    r = run(spark, player=[player(1)], member=[member(1)],
            player_session=[session(i, 1, d, theo=t) for i, (d, t) in enumerate(zip(days, ("9999.99", "0.01", "1")))])
    assert rows(r.milestones.where("milestone_family = 'LIFETIME_VALUE'"), "event_date", "achieved_value") == [
        (D(2000, 3, 2), 10000.0)
    ]


def flagged_ineligible(spark):
    """A banned guest with very long play who comes back after half a year."""
    return run(spark, player=[player(1, "Banned"), player(2)], member=[member(1), member(2)],
               player_session=[session(1, 1, D(1999, 8, 1)), session(2, 1, AS_OF, minutes=700),
                               session(3, 2, D(1999, 8, 1)), session(4, 2, AS_OF, minutes=700, prop=2)])


def test_flagged_and_ineligible(spark):
    r = flagged_ineligible(spark)
    got = rows(r.recommendations.where("milestone_family = 'COMEBACK'"), "player_id", "recommendation_status",
               "final_reward_type", "approved_reward_usd", "rg_reason")
    assert got == [
        (1, P.INELIGIBLE, "GamingOffer", 0.0, "extended play time"),  # keeps the rule's reward type
        (2, P.RG_CHECK_IN, "PersonalNote", 0.0, "extended play time"),
    ]
    report = {(c["check"], c["table"]): c["violations"] for c in r.check_report().collect()}
    assert {k: v for k, v in report.items() if v} == {("no_incentive_when_flagged", "recommendations"): 1}
    listed = r.worklist.collect()
    assert [w["player_id"] for w in listed] == [2]
    assert listed[0]["property_name"] == "Two" and listed[0]["presence"] == P.PRESENCE_ON_PROPERTY
    assert Policy().check_in_phrase in listed[0]["talking_point"]


def test_budget_and_cooldown(spark):
    comp = lambda i, m, d, usd: (i, m, 1, T(d), "Dining", M(usd), 1)
    r = run(spark, player=[player(i, born=D(1950, 3, 15)) for i in (1, 2, 3)],
            member=[member(1), member(2), member(3)],
            comp=[comp(1, 101, D(2000, 2, 20), "60"), comp(2, 102, D(2000, 2, 20), "100"),
                  comp(3, 103, D(2000, 3, 10), "25"), comp(4, 999, D(2000, 3, 10), "25")])
    got = rows(r.recommendations.where("rule_id = 'BIRTHDAY_1'"), "player_id", "recommendation_status",
               "approved_reward_usd", "remaining_budget_usd")
    assert got == [(1, P.RECOMMEND, 40.0, 40.0), (2, P.SUPPRESSED_BUDGET, 0.0, 0.0), (3, P.SUPPRESSED_COOLDOWN, 0.0, 75.0)]


def test_a_new_cumulative_metric_is_one_registry_line(spark):
    policy = Policy(as_of_date=AS_OF, cumulative_metrics={**P.CUMULATIVE_METRICS, "lifetime_minutes": "gaming_minutes"})
    r = run(spark, policy, player=[player(1)], member=[member(1)],
            player_session=[session(1, 1, D(2000, 3, 1), 60), session(2, 1, D(2000, 3, 2), 30)])
    assert rows(r.metric_events.where("metric_name = 'lifetime_minutes'"), "metric_value", "prior_value") == [
        (60.0, 0.0), (90.0, 60.0)
    ]
    assert r.guest_360.first()["lifetime_minutes"] == 90


def test_back_test_moves_every_window(spark):
    data = dict(player=[player(1)], member=[member(1)],
                player_session=[session(i, 1, D(2000, 1, d)) for i, d in enumerate(range(1, 11))])
    then = run(spark, Policy(as_of_date=D(2000, 1, 6)), **data)
    now = run(spark, **data)
    assert (then.guest_360.first()["lifetime_visit_days"], now.guest_360.first()["lifetime_visit_days"]) == (6, 10)
    assert rows(then.recommendations, "rule_id") == [("VISIT_COUNT_5",)]
    assert rows(now.recommendations, "rule_id") == []


def test_missing_table_is_named(spark):
    tables = landed(spark)
    del tables["comp"]
    with pytest.raises(KeyError, match="comp"):
        Recognition(tables, None, None, Policy(as_of_date=AS_OF))


def test_staging_drops_contact_columns(spark):
    r = catalog.recognition_run(spark, SMALL)
    assert "email" not in r.staged["player"].columns
    scan = r.staged["player"]._jdf.queryExecution().executedPlan().toString()
    assert "example.com" not in scan
    publish_staging(r, "t_")
    assert spark.table("t_stg_member").count() == r.staged["member"].count()


def test_catalog_build_equals_the_lazy_run(spark):
    prefix = f"t{uuid.uuid4().hex[:8]}"
    root = sinks.shared_folder(spark) + f"/{prefix}"
    kept = catalog.recognition_run(spark, SMALL, TablesKept(prefix, buckets=4, root=root))
    build(kept)
    lazy = catalog.recognition_run(spark, SMALL)
    listed = lazy.worklist  # the stored one has a folder for each property, whose name comes last there
    assert rows(spark.table(f"{prefix}_recognition.daily_worklist"), *listed.columns) == rows(listed)
    assert rows(spark.table(f"{prefix}_recognition.guest_360")) == rows(lazy.guest_360)
    tables = {t.name for t in spark.catalog.listTables(f"{prefix}_intermediate")}
    assert {"guest_activity_daily", "guest_metric_events", "guest_rg_signals", "guest_comp_budget",
            "guest_visit_streaks"} <= tables
    stored = spark.table(f"{prefix}_intermediate.guest_activity_daily")
    by_guest = stored.groupBy("player_id").agg(F.sum("visit_flag"))
    assert "Exchange" not in by_guest._jdf.queryExecution().executedPlan().toString()
    build(catalog.recognition_run(spark, SMALL, TablesKept(prefix, buckets=4, root=root)))  # full overwrite
    assert spark.table(f"{prefix}_recognition.daily_worklist").count() == lazy.worklist.count()


def scan_counts(df, metric="numFiles"):
    """Of every file scan of a plan that ran, what its own counter says."""
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    todo, found = [executed.executedPlan() if "Adaptive" in executed.getClass().getName() else executed], []
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getName():
            node = node.plan()
        if "FileSourceScan" in node.getClass().getName():
            found.append(node.metrics().get(metric).get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_range_of_days_opens_the_files_of_its_months(spark):
    prefix, buckets = f"t{uuid.uuid4().hex[:8]}", 2
    kept = catalog.recognition_run(spark, SMALL, TablesKept(prefix, buckets, sinks.shared_folder(spark) + f"/{prefix}"))
    lazy = catalog.recognition_run(spark, SMALL)
    whole = scan_counts(kept.activity.select("player_id", "theo_win"))[0]
    months = kept.activity.select("activity_date_month").distinct().count()
    assert buckets * 20 < whole <= buckets * months
    trailing = lambda run: W.trailing_agg(run.activity, "player_id", "activity_date", run.as_of, 60, {"n": F.sum("visit_flag")})
    assert scan_counts(trailing(kept))[0] <= 3 * buckets and rows(trailing(kept)) == rows(trailing(lazy))
    signals = SG.baseline_anomaly(kept.activity, kept.as_of, kept.policy)
    assert scan_counts(signals)[0] <= 4 * buckets and rows(signals) == rows(lazy.rg_signals)
    assert rows(kept.milestones, *lazy.milestones.columns) == rows(lazy.milestones)
    stored = scan_counts(spark.table(f"{prefix}_recognition.guest_milestones").select("rule_id", "player_id"))[0]
    recs = kept.recommendations  # from the stored milestones, by their day
    near = W.days_within(kept.milestones, "event_date", *kept._widest_window)
    assert scan_counts(near)[0] <= 3 * buckets < stored
    assert rows(recs, *lazy.recommendations.columns) == rows(lazy.recommendations)
    some = kept.worklist.select("property_name").first()[0]
    table = spark.table(f"{prefix}_recognition.daily_worklist")
    assert scan_counts(table.where(F.col("property_name") == some).select("player_id"))[0] < scan_counts(table.select("player_id"))[0]


def test_the_write_counts_bad_rows_and_the_list_is_computed_once(spark):
    prefix = f"t{uuid.uuid4().hex[:8]}"
    kept = catalog.recognition_run(spark, SMALL, TablesKept(prefix, 2, sinks.shared_folder(spark) + f"/{prefix}"))
    build(kept)
    assert kept.counted["guest_360"] == {"not_null(player_id)": 0, "not_null(is_eligible)": 0}
    assert set(kept.counted["recommendations"]) == set(kept.row_checks["recommendations"])
    lazy = catalog.recognition_run(spark, SMALL)
    assert rows(kept.check_report()) == rows(lazy.check_report())
    assert all("daily_worklist_staged" in f for f in kept.listed.inputFiles())
    reads = kept.check_report(["marts"])._jdf.queryExecution().optimizedPlan().toString()
    for table in ("guest_360", "guest_milestones", "recommendations", "daily_worklist_staged"):
        assert reads.count(f".{table}[") + reads.count(f"`{table}`") <= 1, table


def test_counts_of_the_write(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "player_id int, x string")
    name = f"t{uuid.uuid4().hex[:8]}"
    watch = {"gone": F.col("x").isNull(), "never": F.col("player_id") < 0}
    path = sinks.fresh_path(spark, name)
    assert sinks.save_table(df, name, "player_id", buckets=2, path=path, watch=watch)[1] == {"gone": 2, "never": 0}
    assert sinks.save_table(df.limit(0), name, path=path, watch=watch)[1] == {"gone": 0, "never": 0}
    spark.sql(f"DROP TABLE {name}")


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*")}


@pytest.mark.parametrize("label", ["guest_milestones", "guest_activity_daily"])
def test_tables_cut_by_steps_leave_no_shuffle_files(spark, label):
    settings = lambda: [spark.conf.get(name, None) for name in (sinks.SHUFFLE_CLEANUP, sinks.SPLIT_BYTES)]
    before, set_before = shuffle_files(spark), settings()
    with sinks.scratch(spark):
        days = spark.range(1000).groupBy((F.col("id") % 10).alias("player_id"), F.lit(AS_OF).alias("activity_date")).agg(F.count("*").alias("n"))
        stored = CutBySteps(label)(days, label)
        until = time.time() + 10  # Spark removes them a moment after the write
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
        assert rows(stored) == [(k, AS_OF, 100) for k in range(10)]
    assert settings() == set_before


def test_the_report_removes_what_later_steps_do_not_read(spark):
    with sinks.scratch(spark):
        before = set(sinks._WRITTEN)
        report = catalog.dq_report(spark, SMALL)
        left = {Path(p).name.rpartition("_")[0] for p in sinks._WRITTEN if p not in before}
        assert left == {"guest_activity_daily", "guest_profile", "guest_milestones", "recommendations",
                        "daily_worklist_staged", "report_staged", "report_intermediate", "report_marts"}
        assert rows(report.where("table = 'guest_metric_events'")) == [("not_null(metric_name)", "guest_metric_events", 0)]


def test_tables_cut_by_steps_are_those_of_one_pass(spark):
    """Guests with two kinds of activity on a day, sessions of nobody, comped stays and bad rows of each table."""
    stay = lambda i, p, day, comp: (i, p, 1, day, day + dt.timedelta(days=2), M("80"), comp, "CheckedOut")
    data = dict(player=[player(1), player(2)], member=[member(1), member(2)],
                player_session=[session(1, 1, AS_OF), session(2, 1, AS_OF), session(3, None, AS_OF), session(4, 2, D(2000, 3, 1))],
                reservation=[stay(1, 1, AS_OF, True), stay(2, 1, AS_OF, False), stay(3, 2, D(2000, 3, 1), None)])
    with sinks.scratch(spark):
        steps = run(spark, **data)
        steps._keep = CutBySteps("guest_activity_daily", "guest_metric_events", "guest_milestones")
        lazy = run(spark, **data)
        assert steps.activity.schema.simpleString() == lazy.activity.schema.simpleString()
        assert rows(steps.activity) == rows(lazy.activity) and steps.activity.count() == 3
        assert steps.counted["guest_activity_daily"] == {"not_null(player_id)": 1}
        assert rows(steps.milestones) == rows(lazy.milestones)
        assert rows(steps.check_report()) == rows(lazy.check_report())


def test_each_layer_is_checked_before_the_next(spark):
    r = catalog.recognition_run(spark, SMALL)
    r.staged = {**r.staged, "check": r.staged["check"].unionByName(r.staged["check"].limit(1))}
    with pytest.raises(ChecksFailed, match="check.unique.check_id"):
        build(r)
    assert not {"activity", "guest_360", "milestones", "recommendations"} & set(r.__dict__)
    r = catalog.recognition_run(spark, SMALL)
    r.__dict__["rg_signals"] = r.rg_signals.unionByName(r.rg_signals)
    with pytest.raises(ChecksFailed, match="guest_rg_signals.unique"):
        build(r)
    assert not {"guest_360", "milestones", "recommendations"} & set(r.__dict__)


def test_stale_sources_stop_a_build(spark):
    r = catalog.recognition_run(spark, SMALL)
    seen = "source string, newest timestamp, age_hours double, status string"
    late = spark.createDataFrame([("comp", None, None, "error"), ("check", None, 3.0, "warn")], seen)
    with pytest.raises(ChecksFailed, match="comp: newest row None"):
        build(r, ["rg_signals"], freshness=late)
    build(r, ["rg_signals"], freshness=late.where("status = 'warn'"))
    assert "rg_signals" in r.__dict__


def test_cut_is_bucketed_and_leaves_no_catalog_entry(spark):
    before = {t.name for t in spark.catalog.listTables()}
    r = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
    assert "Exchange" not in r.cumulative._jdf.queryExecution().executedPlan().toString()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert rows(r.activity) == rows(catalog.recognition_run(spark, SMALL).activity)


def test_a_run_leaves_nothing_behind(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(sinks.shared_folder(spark) + "/accolade")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    listing = lambda: {f.getPath().getName() for f in files.listStatus(folder)} if files.exists(folder) else set()
    before = listing()
    with sinks.scratch(spark):
        assert catalog.queries()["running_totals"](spark, SMALL).count() > 0
        r = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily", "guest_metric_events"))
        assert r.metric_events.count() > 0 and listing() > before
    assert listing() == before


def test_event_date_bound_reaches_the_scan(spark):
    """The guests of the window are found by a range that the scan of the stored days gets."""
    with sinks.scratch(spark):
        r = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
        plan = r.recommendations._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "GreaterThanOrEqual(activity_date,2000-03-01)" in line]
    assert pushed


def test_a_failed_check_keeps_the_old_worklist(spark):
    with sinks.scratch(spark):
        r = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily", "recommendations"))
        recs = r.recommendations
        r.__dict__["recommendations"] = recs.withColumn("approved_reward_usd", F.col("approved_reward_usd") + 10_000.0)
        with pytest.raises(ChecksFailed, match="recommendations.reward_within_budget"):
            build(r, ["worklist"])
        assert "worklist" not in r.__dict__
        r.__dict__["listed"] = r.listed.unionByName(r.listed)
        with pytest.raises(ChecksFailed, match="daily_worklist.unique"):
            build(r, ["worklist"], warn_only=["recommendations.reward_within_budget"])


def test_registry_names_paths_and_identifiers():
    files = readers.Registry("/data", suffix=".parquet", identifiers={"player_session": "playersession"},
                             schemas={"cms": "/data/cms"})
    assert files.locate("player_session", "cms") == "/data/cms/playersession.parquet"
    assert files.locate("comp") == "/data/comp.parquet"
    tables = readers.Registry(fmt="table", schemas={"pos": "raw_pos"})
    assert tables.locate("check", "pos") == "raw_pos.`check`"


def test_table_registry_reads_the_catalog(spark):
    spark.range(3).createOrReplaceTempView("landed_numbers")
    tables = readers.read_sources(spark, readers.Registry(fmt="table", identifiers={"n": "landed_numbers"}), {"n": None})
    assert tables["n"].count() == 3 and list(tables) == ["n"]


@pytest.mark.parametrize("name,count,active", [("standard_rules.csv", 42, 42), ("sample_rules.csv", 36, 35)])
def test_shipped_catalogs(spark, name, count, active):
    rules = readers.shipped_seed(spark, name, readers.RULE_SCHEMA)
    assert rules.count() == count and rules.where("is_active = 1").count() == active
    assert rules.select("rule_id").distinct().count() == count
    assert not rules.where(~F.col("reward_type").isin(*P.REWARD_TYPES) | ~F.col("metric_name").isin(*P.METRIC_NAMES)).count()
    assert not rules.where(F.col("reward_budget_usd").isNull() | ~F.col("talking_point").contains("{first_name}")).count()
    from_file = readers.read_seed(spark, readers.SEED_DIR / name, readers.RULE_SCHEMA)
    assert rows(from_file) == rows(rules)


def test_seed_with_quoted_commas(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text('tier_id,tier_name,max_reward_usd_30d\n1,"Silver, or ""less""",100\n')
    assert rows(readers.read_seed(spark, path, readers.BUDGET_SCHEMA)) == [(1, 'Silver, or "less"', 100.0)]


def test_partitioned_sink_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    for part in (df, df.where("n = 2")):
        sinks.write_table(part, str(tmp_path / "t"), ["k"])
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [(2, "b")]


def test_source_columns_cover_the_landed_tables():
    assert set(SOURCE_COLUMNS) == set(SCHEMAS)
    assert dataclasses.replace(Policy(), min_age=18).min_age == 18
