"""Per-entity signals: behaviour against the entity's own baseline, and recent spending."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.functions.dates import days_ago
from accolade.operators.windows import days_within, within_trailing
from accolade.policy import Policy


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def anomaly_aggregates(day: str, as_of: dt.date, policy: Policy) -> dict[str, Column]:
    """Recent and baseline totals as conditional aggregates over entity-days.

    They carry their own windows, so they can share one grouping with other aggregates.
    """
    d = F.col(day)
    recent = within_trailing(d, as_of, policy.rg_recent_days)
    normal = within_trailing(d, as_of, policy.rg_baseline_days, lag_days=policy.rg_recent_days) & (
        F.col("gaming_sessions") > 0
    )
    return {
        "recent_days": F.count_if(recent),
        "recent_loss_usd": F.sum(F.when(recent, F.col("actual_win"))),
        "max_minutes_in_a_day": F.max(F.when(recent, F.col("gaming_minutes"))),
        "normal_loss_usd": F.sum(F.when(normal, F.col("actual_win"))),
        "normal_days": F.count_if(normal),
    }


def anomaly_columns(policy: Policy) -> dict[str, Column]:
    """Flag and reason from the totals of ``anomaly_aggregates``.

    The baseline average is a division of exact totals, so it does not depend on row order.
    """
    average = F.when(
        F.col("normal_days") > 0, F.col("normal_loss_usd").cast("double") / F.col("normal_days")
    )
    floor = F.greatest(F.coalesce(F.col("avg_daily_loss_90d"), F.lit(0.0)), F.lit(1.0))
    loss = F.col("recent_loss_usd").cast("double")
    long_play = F.col("max_minutes_in_a_day") >= policy.rg_max_minutes
    heavy_loss = (loss >= policy.rg_min_loss_usd) & (loss >= policy.rg_loss_multiple * floor)
    return {
        "avg_daily_loss_90d": average,
        "rg_review_flag": F.coalesce(long_play | heavy_loss, F.lit(False)),
        "rg_reason": F.when(long_play, P.REASON_LONG_PLAY).when(heavy_loss, P.REASON_HEAVY_LOSS),
    }


def with_anomaly(totals: DataFrame, policy: Policy) -> DataFrame:
    cols = anomaly_columns(policy)
    average = {"avg_daily_loss_90d": cols.pop("avg_daily_loss_90d")}
    return totals.withColumns(average).withColumns(cols)


ANOMALY_OUTPUT = (
    "recent_loss_usd", "max_minutes_in_a_day", "avg_daily_loss_90d", "rg_review_flag", "rg_reason",
)


def baseline_anomaly(
    daily: DataFrame, as_of: dt.date, policy: Policy, key: str = "player_id", day: str = "activity_date"
) -> DataFrame:
    """Entities active in the recent window, flagged against their own trailing baseline.

    Both windows lie within the baseline's days, so only those entity-days are read, and both
    come out of one grouping.
    """
    reach = max(policy.rg_baseline_days, policy.rg_recent_days)
    totals = (
        days_within(daily, day, as_of - dt.timedelta(days=reach - 1), as_of)
        .groupBy(key)
        .agg(*[c.alias(n) for n, c in anomaly_aggregates(day, as_of, policy).items()])
        .where(F.col("recent_days") > 0)
    )
    return with_anomaly(totals, policy).select(key, *ANOMALY_OUTPUT)


def trailing_budget(
    spend: DataFrame,
    as_of: dt.date,
    policy: Policy,
    key: str = "member_id",
    day: str = "comp_date",
    amount: str = "comp_amount",
) -> DataFrame:
    """Per entity what was spent inside the cooldown and the budget window, and when last."""
    d, usd = F.col(day), F.col(amount)
    return (
        spend.where(d <= F.lit(as_of))
        .groupBy(key)
        .agg(
            sum_when(d > days_ago(as_of, policy.cooldown_days), usd).alias("comps_cooldown_usd"),
            sum_when(d > days_ago(as_of, policy.budget_window_days), usd).alias("comps_window_usd"),
            F.max(d).alias("last_comp_date"),
        )
    )
