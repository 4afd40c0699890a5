"""Entity-day facts: many event sources, one dense measure list per entity and day."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accolade.functions.dates import month_index, month_start


@dataclass(frozen=True)
class Contribution:
    """What one source's row adds: the entity, the day, and the measures it knows, as SQL
    expressions on the row."""

    rows: DataFrame
    key: str
    day: str
    measures: Mapping[str, str]


def zero_filled(measures: Sequence[str], known: Mapping[str, str]) -> list[str]:
    """One SQL column per registered measure; 0 where the source has none or holds NULL."""
    unknown = set(known) - set(measures)
    if unknown:
        raise ValueError(f"measure(s) not registered: {', '.join(sorted(unknown))}")
    return [f"coalesce({known[m]}, 0) AS {m}" if m in known else f"0 AS {m}" for m in measures]


def entity_day(
    contributions: Sequence[Contribution],
    measures: Sequence[str],
    flag_measures: Sequence[str],
    key: str = "player_id",
    day: str = "activity_date",
    flag: str = "visit_flag",
    step: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """One row per entity and day, summed over all sources.

    The sources are stacked as raw zero-filled rows and grouped once.  Spark sums each input
    split before the exchange, so an entity with a third of all rows sends at most one row
    per split and day.

    With ``step``, each source's days are summed by themselves first, with its own measures only, and
    handed to ``step``, which may store them: the exchanges that make a source's rows are then off
    the disk before the next source is read and before the stacked days are exchanged.
    """

    def summed(sources: Sequence[Contribution]) -> DataFrame:
        stacked = reduce(
            DataFrame.unionByName,
            [
                c.rows.selectExpr(f"{c.key} AS {key}", f"{c.day} AS {day}", *zero_filled(measures, c.measures))
                for c in sources
            ],
        )
        return stacked.groupBy(key, day).agg(*[F.sum(m).alias(m) for m in measures])

    daily = summed(contributions)
    if step:
        types = daily.schema
        days = [step(source_days(c, key, day), f"days_{i}") for i, c in enumerate(contributions)]
        own = [Contribution(d, key, day, {m: m for m in c.measures}) for c, d in zip(contributions, days, strict=True)]
        daily = summed(own).select(*[F.col(f.name).cast(f.dataType) for f in types])
    return with_activity_flag(daily, flag_measures, flag)


def source_days(source: Contribution, key: str, day: str) -> DataFrame:
    """One row per entity and day of one source, with its own measures."""
    names = list(source.measures)
    rows = source.rows.selectExpr(f"{source.key} AS {key}", f"{source.day} AS {day}", *zero_filled(names, source.measures))
    return rows.groupBy(key, day).agg(*[F.sum(m).alias(m) for m in names])


def with_activity_flag(daily: DataFrame, flag_measures: Sequence[str], flag: str = "visit_flag") -> DataFrame:
    """Add a 0/1 flag: did any of the flag measures move?"""
    return daily.withColumn(flag, F.expr(f"int({' + '.join(flag_measures)} > 0)"))


def running_totals(
    daily: DataFrame,
    metric_map: Mapping[str, str],
    key: str = "player_id",
    day: str = "activity_date",
    prior: str = "prior_activity_date",
    opening: DataFrame | None = None,
) -> DataFrame:
    """Add ``cum_<metric>`` per registered metric, and the previous active day.

    One window specification serves all of them: one exchange on the key, one sort.  The
    rows of a key are its active days, so the calendar bounds each window group.

    With ``opening`` (a balance, see ``balances``), ``daily`` holds the days after it only; totals
    and previous days go on from there, and the balance's other columns stay for ``with_streaks``.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {f"cum_{metric}": F.sum(measure).over(so_far) for metric, measure in metric_map.items()}
    last = F.lag(day).over(by_day)
    if opening is None:
        return daily.withColumns({**totals, prior: last})
    carried = daily.join(opening.select(key, *[F.col(f"cum_{m}").alias(f"open_{m}") for m in metric_map], *CARRIED), key, "left")
    grown = {c: F.coalesce(F.col(c.replace("cum_", "open_", 1)), F.lit(0)) + total for c, total in totals.items()}
    return carried.withColumns({**grown, prior: F.coalesce(last, "open_last_day")}).drop(
        *[f"open_{m}" for m in metric_map], "open_last_day")


#: What a balance carries over besides the totals: the last active day, the last day with a visit, and
#: the month in which the run of months of that visit began.
CARRIED = ("open_last_day", "open_seen_day", "open_run_start")


def with_streaks(
    daily: DataFrame, active: Column, key: str = "player_id", day: str = "activity_date", into: str = "streak_months"
) -> DataFrame:
    """Add the length of the run of active months, on the first active day of each month.

    Other rows get NULL.  Only running windows over (key, day) are used, so next to
    ``running_totals`` this costs neither an exchange nor a sort.  Where ``daily`` has a balance's
    columns, the run that was open then goes on.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    month = month_index(F.col(day))
    seen = F.last(F.when(active, F.col(day)), ignorenulls=True).over(
        by_day.rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = "open_seen_day" in daily.columns
    months_since = month - month_index(F.col("_seen"))  # NULL before the first active day
    first_in_month = active & (F.col("_seen").isNull() | (months_since > 0))
    run_starts = active & (F.col("_seen").isNull() | (months_since > 1))
    run_start = F.max(F.when(run_starts, month)).over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        daily.withColumn("_seen", F.coalesce(seen, "open_seen_day") if carried else seen)
        .withColumn("_run_start", F.coalesce(run_start, "open_run_start") if carried else run_start)
        .withColumn(into, F.when(first_in_month, month - F.col("_run_start") + 1))
        .drop("_seen", "_run_start", "open_seen_day", "open_run_start")
    )


def month_streaks(
    daily: DataFrame, active: Column, key: str = "player_id", day: str = "activity_date"
) -> DataFrame:
    """Consecutive active calendar months: one row per entity and month with its streak so far."""
    return (
        with_streaks(daily, active, key, day)
        .where(F.col("streak_months").isNotNull())
        .select(
            key, month_start(F.col(day)).alias("visit_month"), F.col(day).alias("first_visit_in_month"), "streak_months"
        )
    )
