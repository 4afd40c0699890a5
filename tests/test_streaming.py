"""Refreshing stored entity-days from newly landed rows equals a full rebuild."""

from __future__ import annotations

import datetime as dt

from conftest import SMALL, rows
from pyspark.sql import functions as F

from accolade.plans import catalog
from accolade.plans.activity import guest_activity, on_days, runs_of
from accolade.plans.pipeline import Recognition
from accolade.policy import Policy
from accolade.sources import sample
from accolade.sources.staging import stage_all
from accolade.streaming import refresh as RF

POLICY = Policy(as_of_date=sample.AS_OF)


def test_refresh_by_stream_equals_full_rebuild(spark, tmp_path):
    tables = dict(sample.landed_tables(spark, SMALL))
    late = F.col("check_id") % 50 == 7
    folder, stored = str(tmp_path / "check"), str(tmp_path / "days")
    tables["check"].where(~late).write.parquet(folder)
    landed = {**tables, "check": spark.read.parquet(folder)}
    RF.write_days(guest_activity(stage_all(landed, POLICY), POLICY), stored)
    whole = guest_activity(stage_all(tables, POLICY), POLICY)
    stale = RF.read_days(spark, stored).select(*whole.columns)
    assert rows(stale) != rows(whole)

    tables["check"].where(late).coalesce(1).write.mode("append").parquet(folder)
    landed["check"] = spark.read.parquet(folder)
    changes = spark.readStream.schema(landed["check"].schema).parquet(folder)
    only_late = changes.where(late)  # the first files were loaded by the batch build
    RF.stream_refresh(only_late, "check", landed, stored, str(tmp_path / "cp"), POLICY).awaitTermination(120)
    fresh = RF.read_days(spark, stored)
    assert rows(fresh.select(*whole.columns)) == rows(whole)

    run = catalog.recognition_run(spark, SMALL)
    again = Recognition(tables, run.rules, run.guardrails, POLICY, activity=fresh)
    assert rows(again.worklist) == rows(run.worklist)


def test_refresh_twice_changes_nothing(spark, tmp_path):
    landed, stored = sample.landed_tables(spark, SMALL), str(tmp_path / "days")
    days = [dt.date(2000, 3, 14), sample.AS_OF]
    RF.refresh_days(landed, days, stored, POLICY)
    first = rows(RF.read_days(spark, stored))
    RF.refresh_days(landed, days, stored, POLICY)
    assert rows(RF.read_days(spark, stored)) == first
    whole = guest_activity(stage_all(landed, POLICY), POLICY).where(F.col("activity_date").isin(days))
    assert len(first) == whole.count() > 0
    RF.refresh_days(landed, [], stored, POLICY)


def test_day_restriction_reaches_the_scan(spark):
    staged = on_days(stage_all(sample.landed_tables(spark, SMALL), POLICY), [sample.AS_OF], POLICY)
    plan = staged["reservation"]._jdf.queryExecution().optimizedPlan().toString()
    bounds = plan.split("Filter")[1]
    assert "o_orderdate" in bounds and "2000-03-15" in bounds and "cast" not in bounds


def test_touched_days_include_deleted_rows(spark):
    changed = spark.createDataFrame(
        [(1, 1, dt.date(2000, 1, 1), dt.date(2000, 1, 2), True), (2, 1, None, None, False)],
        "reservation_id long, player_id long, arrival_date date, departure_date date, _deleted boolean",
    ).withColumns({"property_id": F.lit(1), "nightly_rate": F.lit(1.0), "is_comp": F.lit(False),
                   "reservation_status": F.lit("InHouse")})
    assert RF.touched_days(changed, "reservation", POLICY) == [dt.date(2000, 1, 1)]


def test_a_day_that_loses_all_rows_is_emptied(spark, tmp_path):
    tables, stored = dict(sample.landed_tables(spark, SMALL)), str(tmp_path / "days")
    day = sample.AS_OF
    RF.refresh_days(tables, [day], stored, POLICY)
    assert RF.read_days(spark, stored).count() > 0
    none = {n: df.limit(0) if n in ("player_session", "check", "reservation", "jackpot") else df for n, df in tables.items()}
    RF.refresh_days(none, [day], stored, POLICY)
    assert RF.read_days(spark, stored).count() == 0


def _moved(tables):
    """Sessions moved by a day, and a card that changed hands."""
    moved, card = F.col("SessionID") % 97 == 5, F.col("member_id") == 100_010
    sessions = tables["player_session"].withColumn("GamingDate", F.when(moved, F.date_add("GamingDate", 1)).otherwise(F.col("GamingDate")))
    members = tables["member"].withColumn("player_id", F.when(card, F.lit(11).cast("bigint")).otherwise(F.col("player_id")))
    return {**tables, "player_session": sessions, "member": members}, sessions.where(moved), members.where(card)


def test_moved_rows_and_members_equal_a_full_rebuild(spark, tmp_path):
    tables = dict(sample.landed_tables(spark, SMALL))
    stored, places = str(tmp_path / "days"), str(tmp_path / "places")
    RF.write_days(guest_activity(stage_all(tables, POLICY), POLICY), stored)
    RF.write_row_days(tables, places, POLICY)
    after, sessions, members = _moved(tables)
    for name, changed in (("player_session", sessions), ("member", members)):
        old = spark.read.parquet(places)
        RF.refresh_days(after, RF.touched_days(changed, name, POLICY, old), stored, POLICY)
    whole = guest_activity(stage_all(after, POLICY), POLICY)
    assert rows(RF.read_days(spark, stored).select(*whole.columns)) == rows(whole)


def test_files_per_day_are_bounded(spark, tmp_path):
    stored = tmp_path / "days"
    few = spark.range(20 * 500).selectExpr("date_add(DATE'2000-01-01', int(id % 20)) AS activity_date", "id AS player_id")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        RF.write_days(few, str(stored))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list(stored.glob("activity_date=*/*.parquet"))) <= 64 + 20


def test_raw_ranges_follow_runs_of_days():
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    assert runs_of([day(3), day(-700), day(1), day(2), day(5)]) == [(day(-700), day(-700)), (day(1), day(3)), (day(5), day(5))]
