"""Guest 360: one row per guest as of a date, with eligibility."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.functions.dates import age_on
from accolade.functions.recognition import ineligible_reason, is_eligible
from accolade.operators.asof import value_on
from accolade.operators.signals import anomaly_aggregates, sum_when, with_anomaly
from accolade.operators.windows import best_per_key, favorite_code, latest_in_interval, latest_value, moment_order, value_codes, within_trailing
from accolade.policy import Policy


def snapshot_reach(policy: Policy) -> int:
    """Days before the as-of day that the snapshot looks at one by one."""
    return max(policy.trailing_days, policy.rg_baseline_days, policy.rg_recent_days)


def guest_snapshot(activity: DataFrame, as_of: dt.date, policy: Policy, opening: DataFrame | None = None) -> DataFrame:
    """Everything the 360 and the gaming signals need from the entity-days, in one grouping.

    The running total at the latest day up to ``as_of`` is the sum of the days up to it, so
    no window and no second pass over the entity-days is needed.  With ``opening``, a balance
    older than every window, ``activity`` holds the days after it only.
    """
    day, visited = F.col("activity_date"), F.col("visit_flag") == 1
    so_far = day <= F.lit(as_of)
    year = within_trailing(day, as_of, policy.trailing_days)
    lifetime = {m: sum_when(so_far, F.col(measure)) for m, measure in policy.cumulative_metrics.items()}
    aggregates = {
        **lifetime,
        "last_visit_date": F.max(F.when(so_far, day)),
        "first_visit_date": F.min(F.when(visited, day)),
        "theo_win_12m": sum_when(year, F.col("theo_win")),
        "visit_days_12m": sum_when(year, F.col("visit_flag")),
        "active_today": F.bool_or((day == F.lit(as_of)) & visited),
        **anomaly_aggregates("activity_date", as_of, policy),
    }
    grouped = activity.groupBy("player_id").agg(*[c.alias(n) for n, c in aggregates.items()])
    if opening is not None:
        grouped = _continued(opening, grouped, policy)
    return with_anomaly(grouped, policy)


def _continued(opening: DataFrame, grouped: DataFrame, policy: Policy) -> DataFrame:
    """A balance and the aggregates of the days after it, as if of all days."""
    zero, none = F.lit(0), F.lit(0).cast("bigint")
    merged = opening.join(grouped, "player_id", "full")
    return merged.withColumns({
        **{m: F.coalesce(F.col(f"cum_{m}"), zero) + F.coalesce(F.col(m), zero) for m in policy.cumulative_metrics},
        "last_visit_date": F.coalesce("last_visit_date", "open_last_day"),
        "first_visit_date": F.coalesce("open_first_visit", "first_visit_date"),
        "recent_days": F.coalesce("recent_days", none), "normal_days": F.coalesce("normal_days", none),
    }).select(*grouped.columns)


def _favorite_first() -> list[Column]:
    return [F.col("minutes").desc_nulls_last(), F.col("favorite_game_category").asc_nulls_last()]


def favorite_game(sessions: DataFrame, as_of: dt.date, policy: Policy) -> DataFrame:
    """Game category with the most minutes over the trailing year.

    Minutes are summed per guest and game first, so the ranking sees a row for each game of a guest.
    """
    recent = sessions.where(within_trailing(F.col("gaming_date"), as_of, policy.trailing_days))
    per_game = recent.groupBy("player_id", F.col("game_category").alias("favorite_game_category")).agg(
        F.sum("minutes_played").alias("minutes")
    )
    return best_per_key(per_game, "player_id", _favorite_first()).select("player_id", "favorite_game_category")


def guest_sessions(sessions: DataFrame, as_of: dt.date, policy: Policy) -> DataFrame:
    """Favourite game, and where the guest last played on the as-of day, from one read of the sessions.

    One grouping by guest and game serves both: each game keeps its last property of the day beside
    the minutes, and the window that ranks a guest's games takes the latest of these.
    """
    recent = sessions.where(within_trailing(F.col("gaming_date"), as_of, policy.trailing_days))
    today = F.when(F.col("gaming_date") == F.lit(as_of), moment_order(sessions, "end_time", "session_id"))
    per_game = recent.groupBy("player_id", F.col("game_category").alias("favorite_game_category")).agg(
        F.sum("minutes_played").alias("minutes"), F.max(today).alias("last_"), F.max_by("property_id", today).alias("property_"),
    )
    of_guest = Window.partitionBy("player_id").orderBy(*_favorite_first())
    whole = of_guest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = per_game.withColumns({
        "rank_": F.row_number().over(of_guest), "playing_property_id": F.max_by("property_", "last_").over(whole),
    })
    return ranked.where("rank_ = 1").select("player_id", "favorite_game_category", "playing_property_id")


def favorite_outlet(checks: DataFrame, members: DataFrame, outlets: DataFrame) -> DataFrame:
    """Outlet with the highest closed spend per guest, over all time.

    Spend is summed per member and outlet first: the joins then see one row per pair.  Outlets of one
    name and type count as one; they travel as a code of the outlet table.  One exchange on the
    guest then serves both remaining groupings and the join to the guest.
    """
    paid = checks.where((F.col("check_status") == P.CLOSED_CHECK) & F.col("member_id").isNotNull())
    per_outlet = paid.groupBy("member_id", "outlet_id").agg(F.sum("subtotal").alias("spend"))
    values = ["favorite_outlet_name", "favorite_outlet_type"]
    named = outlets.select("outlet_id", F.col("outlet_name").alias(values[0]), F.col("outlet_type").alias(values[1]))
    codes = value_codes(named, values)
    coded = named.join(codes.select("code", *[F.col(v).alias(f"{v}_c") for v in values]), [F.col(v).eqNullSafe(F.col(f"{v}_c")) for v in values])
    spend = (
        per_outlet.join(coded.select("outlet_id", "code"), "outlet_id")
        .join(members.select("member_id", "player_id"), "member_id")
        .repartition("player_id")
        .groupBy("player_id", "code")
        .agg(F.sum("spend").alias("spend"))
    )
    return favorite_code(spend, "player_id", "code", "spend").join(codes, "code").select("player_id", *values)


def property_today(sessions: DataFrame, as_of: dt.date) -> DataFrame:
    """Property of each guest's last session on the as-of day."""
    today = sessions.where(F.col("gaming_date") == F.lit(as_of))
    return latest_value(today, "player_id", "end_time", "session_id", "property_id")


def in_house(reservations: DataFrame, as_of: dt.date) -> DataFrame:
    """Guests with a stay that covers the as-of night, and where."""
    stays = reservations.where(F.col("reservation_status").isin(*P.STAY_STATUSES)).select(
        "reservation_id", "player_id", "property_id", "arrival_date", "departure_date"
    )
    return latest_in_interval(stays, "player_id", "arrival_date", "departure_date", as_of, "reservation_id", "property_id")


def members_on(staged: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """The members enrolled by a day, each with the tier of that day.

    A member whose history says nothing keeps the present tier.  Statuses and balances have no
    landed history and stay as they are now.
    """
    enrolled = staged["member"].where(F.col("enroll_date") <= F.lit(as_of))
    moves = staged["tier_history"].where(F.col("member_id").isNotNull())
    then = value_on(moves, "member_id", "change_date", "tier_history_id", "old_tier_id", "new_tier_id", as_of, "tier_then")
    return enrolled.join(then, "member_id", "left").withColumn("tier_id", F.coalesce("tier_then", "tier_id")).drop("tier_then")


def guest_profile(
    staged: Mapping[str, DataFrame], activity: DataFrame, as_of: dt.date, policy: Policy, opening: DataFrame | None = None,
) -> DataFrame:
    """The 360 together with the gaming signals, one row per guest.

    Every large side is grouped by guest beforehand, so the star of left joins runs on one
    common partitioning; tiers and properties are dimensions and do not disturb it.
    """
    today = F.lit(as_of)
    members = (members_on(staged, as_of) if policy.strict_as_of else staged["member"]).select(
        "player_id", "member_id", "member_number", "member_status", "enroll_date", "tier_id", "points_balance",
        "email_opt_in", "sms_opt_in",
    )
    tiers = staged["tier"].select("tier_id", "tier_name")
    properties = staged["property"].select("property_id", "property_name")
    homes, currents = (
        properties.withColumnsRenamed({c: f"{role}_{c}" for c in properties.columns}) for role in ("home", "current")
    )
    stays = in_house(staged["reservation"], as_of).withColumnRenamed("property_id", "staying_property_id").withColumn(
        "staying", F.lit(True)
    )
    joined = (
        staged["player"].drop("created_at")
        .join(members, "player_id", "left")
        .join(guest_snapshot(activity, as_of, policy, opening), "player_id", "left")
        .join(guest_sessions(staged["player_session"], as_of, policy), "player_id", "left")
        .join(favorite_outlet(staged["check"], staged["member"], staged["outlet"]), "player_id", "left")
        .join(stays, "player_id", "left")
        .join(tiers, "tier_id", "left")
        .join(homes, "home_property_id", "left")
        .withColumn(
            "current_property_id", F.coalesce("playing_property_id", "staying_property_id", "home_property_id")
        )
        .join(currents, "current_property_id", "left")
        .withColumns({
            "age_years": age_on(F.col("date_of_birth"), today),
            "member_years": age_on(F.col("enroll_date"), today),
        })
    )
    eligibility = (
        F.col("member_id"), F.col("player_status"), F.col("member_status"), F.col("age_years"), policy.min_age
    )
    return joined.select(
        "player_id", "member_id", "member_number", "first_name", "last_name", "full_name", "age_years", "is_vip",
        "player_status", "member_status", "enroll_date", "member_years", "tier_id", "tier_name", "points_balance",
        "email_opt_in", "sms_opt_in", "home_property_id", "home_property_name", "current_property_id",
        "first_visit_date", "last_visit_date",
        F.datediff(today, "last_visit_date").alias("days_since_last_visit"),
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in policy.cumulative_metrics],
        F.coalesce("theo_win_12m", F.lit(0)).alias("theo_win_12m"),
        F.coalesce("visit_days_12m", F.lit(0)).alias("visit_days_12m"),
        "favorite_game_category", "favorite_outlet_name", "favorite_outlet_type",
        F.coalesce("active_today", F.lit(False)).alias("on_property_today"),
        F.coalesce("staying", F.lit(False)).alias("in_house_tonight"),
        today.alias("as_of_date"),
        "current_property_name",
        ineligible_reason(*eligibility).alias("ineligible_reason"),
        is_eligible(*eligibility).alias("is_eligible"),
        F.coalesce("rg_review_flag", F.lit(False)).alias("rg_review_flag"),
        "rg_reason",
    )


SIGNAL_COLUMNS = ("rg_review_flag", "rg_reason")


def entity_360(profile: DataFrame) -> DataFrame:
    """The 360 table proper: the profile without the gaming signals."""
    return profile.drop(*SIGNAL_COLUMNS)
