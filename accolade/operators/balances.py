"""Opening balances: what an entity's running windows carry from one stretch of days to the next.

A balance holds, for every entity active up to a day, its totals, its last active day, its first and
last day with a visit, and the month in which its present run of visited months began.  Running
windows over the days after it, started from it, give the same rows as windows over all days, so
a day's run reads the days since a balance and not the history before it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade.functions.dates import month_index
from accolade.operators.windows import days_within


def days_after(daily: DataFrame, opened: dt.date | None, last: dt.date | None = None, day: str = "activity_date") -> DataFrame:
    """Entity-days after ``opened`` and up to ``last``."""
    return days_within(daily, day, opened and opened + dt.timedelta(days=1), last)


def closing_balance(
    daily: DataFrame,
    metric_map: Mapping[str, str],
    active: Column,
    through: dt.date,
    opening: DataFrame | None = None,
    opened: dt.date | None = None,
    key: str = "player_id",
    day: str = "activity_date",
) -> DataFrame:
    """The balance at the end of ``through``, from all days or from the balance of ``opened``.

    One aggregate over the days in between, without windows: the open run follows from the set
    of visited months, which the calendar bounds.  Merged by a full join on the entity, on which
    both sides are grouped.
    """
    month = month_index(F.col(day))
    months = F.collect_set(F.when(active, month))
    since = days_after(daily, opened, through, day).groupBy(key).agg(
        *[F.sum(measure).alias(f"new_{metric}") for metric, measure in metric_map.items()],
        F.max(day).alias("new_last_day"), F.min(F.when(active, F.col(day))).alias("new_first_visit"),
        F.max(F.when(active, F.col(day))).alias("new_seen_day"), months.alias("months"),
    )
    starts = F.filter("months", lambda m: ~F.array_contains("months", m - 1))
    since = since.withColumn("new_run_start", F.array_max(starts)).drop("months")
    if opening is None:
        return since.select(
            key, *[F.col(f"new_{m}").alias(f"cum_{m}") for m in metric_map], F.col("new_last_day").alias("open_last_day"),
            F.col("new_first_visit").alias("open_first_visit"), F.col("new_seen_day").alias("open_seen_day"),
            F.col("new_run_start").alias("open_run_start"),
        )
    # The last new run goes on from the open one if it starts in the same month or the one after it.
    goes_on = F.col("new_run_start") - month_index(F.col("open_seen_day")) <= 1
    run = F.when(F.col("new_run_start").isNull() | goes_on, F.coalesce("open_run_start", "new_run_start")).otherwise(F.col("new_run_start"))
    return opening.join(since, key, "full").select(
        key,
        *[(F.coalesce(F.col(f"cum_{m}"), F.lit(0)) + F.coalesce(F.col(f"new_{m}"), F.lit(0))).alias(f"cum_{m}") for m in metric_map],
        F.coalesce("new_last_day", "open_last_day").alias("open_last_day"),
        F.coalesce("open_first_visit", "new_first_visit").alias("open_first_visit"),
        F.coalesce("new_seen_day", "open_seen_day").alias("open_seen_day"), run.alias("open_run_start"),
    )
