"""Incremental entity-days: recompute the business days that newly landed rows touch.

The stored table has one partition per business day.  A refresh finds the touched days,
recomputes them in full from the landed tables, and overwrites just their partitions.  It
never reads the stored table, so repeating it after a failure gives the same result.  Late rows
are right because whole days are recomputed; a row that moved to another day or guest, or a
membership that changed hands, is right where the places rows counted before are stored too
(``write_row_days``), because the old days are then recomputed as well.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accolade.plans.activity import activity_day, guest_activity, on_days
from accolade.policy import Policy
from accolade.sources.readers import flag_columns
from accolade.sources.staging import stage, stage_all

DAY = "activity_date"
MARKER = "is_day_marker"
#: Column that identifies a row of each table with activity.
ROW_IDS = {"player_session": "session_id", "check": "check_id", "reservation": "reservation_id", "jackpot": "jackpot_id"}


def write_days(activity: DataFrame, path: str, days: Sequence[dt.date] = ()) -> None:
    """Store entity-days by day, replacing the days present in ``activity`` and those named.

    A named day gets a marker row that readers skip, so a day whose rows have all gone is
    replaced too.  Tasks take ranges of (day, guest), so a task writes the days of its range and
    there are about as many files as days and tasks together.
    """
    rows = activity.withColumn(MARKER, F.lit(False))
    if days:
        spark = activity.sparkSession
        marks = spark.range(1).select(
            F.explode(F.array(*[F.lit(d) for d in days])).alias(DAY), F.lit(True).alias(MARKER)
        )
        rows = rows.unionByName(marks, allowMissingColumns=True)
    (
        rows.repartitionByRange(DAY, "player_id").sortWithinPartitions(DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(~F.col(MARKER)).drop(MARKER)


def row_days(staged: Mapping[str, DataFrame], name: str, policy: Policy) -> DataFrame:
    """(source, row_id, member_id, day): where each activity row of one staged table counts."""
    rows = staged[name]
    member = F.col("member_id") if "member_id" in rows.columns else F.lit(None).cast("bigint")
    return rows.select(
        F.lit(name).alias("source"), F.col(ROW_IDS[name]).cast("bigint").alias("row_id"),
        member.cast("bigint").alias("member_id"), activity_day(name, policy).alias("day"),
    )


def write_row_days(landed: Mapping[str, DataFrame], path: str, policy: Policy) -> None:
    """Store where every row counts, beside the entity-days; a refresh looks old places up here.

    One folder per source, overwritten as a whole: a full build writes it, and each refresh adds
    the new places of changed rows, so an id may have several, all of which are touched.
    """
    staged = stage_all(landed, policy)
    places = reduce(DataFrame.unionByName, [row_days(staged, name, policy) for name in ROW_IDS])
    places.where(F.col("day").isNotNull()).write.mode("overwrite").partitionBy("source").parquet(path)


def touched_days(changed: DataFrame, name: str, policy: Policy, places: DataFrame | None = None) -> list[dt.date]:
    """Business days that changed rows of one landed table touch; the calendar bounds the list.

    Soft-deleted rows count too, so the filter on them is left out here.  With ``places`` (what
    ``write_row_days`` stored), the days a row counted on before are touched as well, and a
    changed member touches all days of the member's checks.
    """
    live = changed.drop(*flag_columns(changed, policy.deleted_flags))
    rows = stage(name, live, policy)
    parts = []
    if name in ROW_IDS:
        parts.append(rows.select(activity_day(name, policy).alias("day")))
        if places is not None:
            ids = rows.select(F.col(ROW_IDS[name]).cast("bigint").alias("row_id")).distinct()
            parts.append(places.where(F.col("source") == name).join(ids, "row_id", "left_semi").select("day"))
    elif name == "member" and places is not None:
        members = rows.select(F.col("member_id").cast("bigint").alias("member_id")).distinct()
        parts.append(places.join(members, "member_id", "left_semi").select("day"))
    else:
        raise ValueError(f"{name} has no activity days of its own; give the stored places of rows")
    days = reduce(DataFrame.union, parts).distinct().collect()
    return sorted(r["day"] for r in days if r["day"] is not None)


def refresh_days(landed: Mapping[str, DataFrame], days: list[dt.date], path: str, policy: Policy) -> None:
    """Recompute the given days from the landed tables and replace them in the stored table."""
    if days:
        staged = stage_all(landed, policy)
        write_days(guest_activity(on_days(staged, days, policy), policy), path, days)


def stream_refresh(
    changes: DataFrame, name: str, landed: Mapping[str, DataFrame], path: str, checkpoint: str, policy: Policy,
    places_path: str | None = None,
) -> StreamingQuery:
    """Refresh after each micro-batch of newly landed rows of one table, until none are left.

    ``landed`` must already hold the rows of ``changes``, as when both read the same folder.
    With ``places_path``, old places of changed rows are refreshed too and new ones are added.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        places = batch.sparkSession.read.parquet(places_path) if places_path else None
        refresh_days(landed, touched_days(batch, name, policy, places), path, policy)
        if places_path and name in ROW_IDS:  # after the days, so that a repeated batch finds the old places again
            staged = {name: stage(name, batch.drop(*flag_columns(batch, policy.deleted_flags)), policy)}
            new = row_days(staged, name, policy).where(F.col("day").isNotNull())
            new.write.mode("append").partitionBy("source").parquet(places_path)

    return (
        changes.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
