"""Staging views: one lazy projection per landed table.

Every view names the columns it keeps, so contact details and identity numbers never leave
the scan, and Catalyst prunes the parquet read to the same list.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.functions.dates import business_day, days_between
from accolade.policy import Policy
from accolade.sources.readers import LazyTables, live_rows, select_normalized

# The columns of each landed table that the analytics use.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "player": (
        "player_id", "first_name", "last_name", "date_of_birth", "home_property_id", "player_status", "vip_flag",
        "created_at",
    ),
    "player_session": (
        "session_id", "player_id", "property_id", "game_category", "gaming_date", "start_time", "end_time",
        "minutes_played", "cash_in", "cash_out", "coin_in_or_action", "average_bet", "theoretical_win", "actual_win",
        "points_awarded",
    ),
    "jackpot": ("jackpot_id", "asset_id", "player_id", "jackpot_date_time", "amount", "jackpot_type"),
    "member": (
        "member_id", "player_id", "member_number", "tier_id", "enroll_date", "enroll_property_id", "points_balance",
        "tier_credits_ytd", "member_status", "last_activity_date", "email_opt_in", "sms_opt_in",
    ),
    "tier": ("tier_id", "tier_name", "tier_credits_required", "point_multiplier"),
    "tier_history": ("tier_history_id", "member_id", "old_tier_id", "new_tier_id", "change_date", "change_reason"),
    "comp": (
        "comp_id", "member_id", "property_id", "comp_date_time", "comp_category", "comp_amount",
        "authorized_by_employee_id",
    ),
    "check": (
        "check_id", "outlet_id", "member_id", "opened_at", "closed_at", "guest_count", "subtotal", "total_amount",
        "check_status",
    ),
    "outlet": ("outlet_id", "property_id", "outlet_name", "outlet_type"),
    "reservation": (
        "reservation_id", "player_id", "property_id", "arrival_date", "departure_date", "nightly_rate", "is_comp",
        "reservation_status",
    ),
    "property": ("property_id", "property_code", "property_name"),
}


def _landed(name: str, raw: DataFrame, policy: Policy) -> DataFrame:
    required = SOURCE_SYSTEMS[name] in policy.deleted_flag_required
    return select_normalized(live_rows(raw, policy.deleted_flags, required), SOURCE_COLUMNS[name])


def _false_if_null(df: DataFrame, *flags: str) -> DataFrame:
    return df.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def _stage_player(df: DataFrame, policy: Policy) -> DataFrame:
    return (
        _false_if_null(df, "vip_flag")
        .withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))
        .withColumnRenamed("vip_flag", "is_vip")
    )


def _stage_jackpot(df: DataFrame, policy: Policy) -> DataFrame:
    """Anonymous wins belong to nobody and are dropped."""
    return (
        df.where(F.col("player_id").isNotNull())
        .withColumn("gaming_date", business_day(F.col("jackpot_date_time"), policy.day_start_hour))
        .withColumnsRenamed({"jackpot_date_time": "jackpot_at", "amount": "jackpot_amount"})
    )


def _stage_member(df: DataFrame, policy: Policy) -> DataFrame:
    return _false_if_null(df, "email_opt_in", "sms_opt_in")


def _stage_comp(df: DataFrame, policy: Policy) -> DataFrame:
    """Comps keep the calendar date, not the business day."""
    return df.withColumn("comp_date", F.col("comp_date_time").cast("date")).withColumnRenamed(
        "comp_date_time", "comp_at"
    )


def _stage_reservation(df: DataFrame, policy: Policy) -> DataFrame:
    return _false_if_null(df, "is_comp").withColumn(
        "nights", days_between(F.col("arrival_date"), F.col("departure_date"))
    )


_SHAPERS: Mapping[str, Callable[[DataFrame, Policy], DataFrame]] = {
    "player": _stage_player,
    "jackpot": _stage_jackpot,
    "member": _stage_member,
    "comp": _stage_comp,
    "reservation": _stage_reservation,
}


def stage(name: str, raw: DataFrame, policy: Policy) -> DataFrame:
    """The staging view of one landed table."""
    landed = _landed(name, raw, policy)
    shaper = _SHAPERS.get(name)
    return shaper(landed, policy) if shaper else landed


def stage_all(raw: Mapping[str, DataFrame], policy: Policy) -> LazyTables:
    """All staging views, lazily; raises if a landed table is missing."""
    missing = set(SOURCE_COLUMNS) - set(raw)
    if missing:
        raise KeyError(f"landed tables missing: {', '.join(sorted(missing))}")
    return LazyTables({name: lambda name=name: stage(name, raw[name], policy) for name in SOURCE_COLUMNS})


# The source system each landed table belongs to; ``ref`` has no freshness rule.
SOURCE_SYSTEMS: dict[str, str] = {
    "player": "cms", "player_session": "cms", "jackpot": "cms",
    "member": "loy", "tier": "loy", "tier_history": "loy", "comp": "loy",
    "check": "pos", "outlet": "pos",
    "reservation": "hotel",
    "property": "ref",
}
