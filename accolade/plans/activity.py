"""Guest-day activity from the staged tables, for all days or for a few."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.functions.dates import business_day, in_business_days
from accolade.operators.entity_day import Contribution, entity_day
from accolade.policy import Policy

# Which column of a staged table dates its activity, and whether it is a local timestamp.
ACTIVITY_DATES = {
    "player_session": ("gaming_date", False),
    "check": ("closed_at", True),
    "reservation": ("arrival_date", False),
    "jackpot": ("jackpot_at", True),
}


def activity_day(name: str, policy: Policy) -> Column:
    """The business day a staged row belongs to."""
    column, is_timestamp = ACTIVITY_DATES[name]
    return business_day(F.col(column), policy.day_start_hour) if is_timestamp else F.col(column)


def runs_of(days: Sequence[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """First and last day of each run of adjacent days."""
    runs: list[tuple[dt.date, dt.date]] = []
    for day in sorted(set(days)):
        if runs and (day - runs[-1][1]).days == 1:
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def on_days(staged: Mapping[str, DataFrame], days: Sequence[dt.date], policy: Policy) -> dict[str, DataFrame]:
    """The staged tables with activity rows of the given days only.

    Dates are compared as literals and timestamps by raw ranges as well, one for each run of
    adjacent days, so both reach the scans and prune files, and one late day does not open the
    years before it.
    """
    cut = dict(staged)
    for name, (column, is_timestamp) in ACTIVITY_DATES.items():
        rows = staged[name]
        if is_timestamp:
            inside = F.lit(False)
            for first, last in runs_of(days):
                inside = inside | in_business_days(F.col(column), first, last, policy.day_start_hour)
            rows = rows.where(inside)
        cut[name] = rows.where(activity_day(name, policy).isin(list(days)))
    return cut


def dining_days(staged: Mapping[str, DataFrame], policy: Policy) -> DataFrame:
    """Closed checks of members, summed per member and business day before the member join: a
    member with a third of all checks enters the join as a few thousand days."""
    checks = staged["check"].where((F.col("check_status") == P.CLOSED_CHECK) & F.col("member_id").isNotNull())
    per_day = checks.groupBy("member_id", activity_day("check", policy).alias("day")).agg(
        F.count("*").alias("checks"), F.sum("subtotal").alias("spend")
    )
    return per_day.join(staged["member"].select("member_id", "player_id"), "member_id")


def guest_activity(
    staged: Mapping[str, DataFrame], policy: Policy, step: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """One row per guest and business day with gaming, dining, hotel or jackpot activity; ``step`` may
    store the days of each source, see ``entity_day``."""
    stays = staged["reservation"].where(
        F.col("player_id").isNotNull() & F.col("reservation_status").isin(*P.STAY_STATUSES)
    )
    sources = [
        Contribution(staged["player_session"], "player_id", "gaming_date", {
            "gaming_sessions": "1",
            "gaming_minutes": "minutes_played",
            "theo_win": "theoretical_win",
            "actual_win": "actual_win",
            "cash_in": "cash_in",
            "points_earned": "points_awarded",
        }),
        Contribution(dining_days(staged, policy), "player_id", "day", {
            "dining_checks": "checks", "dining_spend": "spend",
        }),
        Contribution(stays, "player_id", "arrival_date", {
            "hotel_stays": "1", "hotel_nights": "nights", "hotel_revenue": "IF(is_comp, NULL, nights * nightly_rate)",
        }),
        Contribution(staged["jackpot"], "player_id", "gaming_date", {
            "jackpot_count": "1", "jackpot_amount": "jackpot_amount",
        }),
    ]
    return entity_day(sources, policy.activity_measures, policy.visit_measures, step=step)
