"""Metric events: everything as (entity, event_date, metric_name, metric_value, prior_value)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade.functions.dates import add_years, days_ago

EVENT_COLUMNS = ("player_id", "event_date", "metric_name", "metric_value", "prior_value")


def event_columns(key: Column, day: Column, metric: str, value: Column, prior: Column) -> list[Column]:
    """The five event columns in their fixed types."""
    return [
        key.alias("player_id"),
        day.alias("event_date"),
        F.lit(metric).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        prior.cast("double").alias("prior_value"),
    ]


def event(metric: str, day: Column, value: Column, prior: Column) -> Column:
    """One event as a struct, in the fixed types."""
    return F.struct(
        day.alias("event_date"),
        F.lit(metric).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        prior.cast("double").alias("prior_value"),
    )


def emit(rows: DataFrame, key: Column, candidates: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Turn each row into the events whose condition holds: ``name -> (condition, event)``.

    One pass for all kinds of events; rows without any are dropped before they are expanded.
    """
    conditions = [c for c, _ in candidates.values()]
    events = F.array(*[F.when(condition, e) for condition, e in candidates.values()])
    return (
        rows.where(reduce(lambda a, b: a | b, conditions))
        .select(key.alias("player_id"), F.explode(events).alias("event"))
        .where(F.col("event").isNotNull())
        .select("player_id", "event.*")
    )


def cumulative_candidates(metric_map: Mapping[str, str], day: str) -> dict[str, tuple[Column, Column]]:
    """A running total is an event on the days its measure grew; the prior value is the total before."""
    return {
        metric: (
            F.col(measure) > 0,
            event(metric, F.col(day), F.col(f"cum_{metric}"), F.col(f"cum_{metric}") - F.col(measure)),
        )
        for metric, measure in metric_map.items()
    }


def unpivot_cumulative(
    totals: DataFrame, metric_map: Mapping[str, str], key: str = "player_id", day: str = "activity_date"
) -> DataFrame:
    """Wide running totals to long events, only for days on which the measure grew."""
    return emit(totals, F.col(key), cumulative_candidates(metric_map, day))


def _anniversaries(
    rows: DataFrame, key: str, since: str, as_of: dt.date, window_days: int
) -> DataFrame:
    """Each date's anniversaries of last, this and next year that fall near ``as_of``, with the
    number of years reached.  Rows are expanded in place; no join, no exchange."""
    first, last = days_ago(as_of, window_days), days_ago(as_of, -window_days)
    years = F.col("year") - F.year(since)
    return (
        rows.where(F.col(since).isNotNull())
        .select(F.col(key).alias("player_id"), since, F.explode(F.array(*[F.lit(as_of.year + y) for y in (-1, 0, 1)])).alias("year"))
        .select("player_id", add_years(F.col(since), years).alias("event_date"), years.alias("n"))
        .where(F.col("event_date").between(first, last))
    )


def birthday_events(
    people: DataFrame, as_of: dt.date, window_days: int, key: str = "player_id", born: str = "date_of_birth"
) -> DataFrame:
    """A yearly birthday event and the age reached, within ``window_days`` of ``as_of``."""
    day, n, always = F.col("event_date"), F.col("n"), F.lit(True)
    return emit(_anniversaries(people, key, born, as_of, window_days), F.col("player_id"), {
        "birthday": (always, event("birthday", day, F.lit(1), F.lit(0))),
        "age_at_birthday": (always, event("age_at_birthday", day, n, n - 1)),
    })


def membership_events(
    members: DataFrame, as_of: dt.date, window_days: int, key: str = "player_id", joined: str = "enroll_date"
) -> DataFrame:
    """Membership anniversaries from the first on, within ``window_days`` of ``as_of``."""
    day, n = F.col("event_date"), F.col("n")
    near = _anniversaries(members, key, joined, as_of, window_days)
    return near.where(n >= 1).select(*event_columns(F.col("player_id"), day, "membership_years", n, n - 1))


def metric_events(*branches: DataFrame) -> DataFrame:
    """All event branches as one long table."""
    return reduce(DataFrame.unionByName, [b.select(*EVENT_COLUMNS) for b in branches])
