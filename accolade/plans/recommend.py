"""From milestones to the ranked worklist: enrich, score, decide, word, rank."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.functions import recognition as R
from accolade.operators.rules import actionable
from accolade.operators.windows import fold_rest, top_n
from accolade.policy import Policy

GUEST_COLUMNS = (
    "player_id", "first_name", "last_name", "full_name", "tier_id", "tier_name", "is_vip", "is_eligible",
    "on_property_today", "in_house_tonight", "current_property_id", "current_property_name", "favorite_outlet_name",
    "favorite_game_category", "visit_days_12m", "lifetime_theo_win", "lifetime_visit_days", "member_years",
    "rg_review_flag", "rg_reason",
)


def enrich(
    open_milestones: DataFrame, profile: DataFrame, budgets: DataFrame, guardrails: DataFrame, policy: Policy
) -> DataFrame:
    """Open milestones with their guest, recent comps and tier budget."""
    spent = budgets.select("player_id", "comps_cooldown_usd", "comps_window_usd")
    caps = guardrails.select("tier_id", "max_reward_usd_30d")
    cap = F.coalesce("max_reward_usd_30d", F.lit(policy.default_budget_usd))
    return (
        open_milestones.join(profile.select(*GUEST_COLUMNS), "player_id")
        .join(spent, "player_id", "left")
        .join(caps, "tier_id", "left")
        .withColumns({
            "comps_cooldown_usd": F.coalesce(F.col("comps_cooldown_usd").cast("double"), F.lit(0.0)),
            "comps_window_usd": F.coalesce(F.col("comps_window_usd").cast("double"), F.lit(0.0)),
        })
        .withColumn("remaining_budget_usd", cap - F.col("comps_window_usd"))
        .drop("max_reward_usd_30d")
    )


def decide(enriched: DataFrame, policy: Policy) -> DataFrame:
    """Add the unrounded score and the recommendation status."""
    present = F.col("on_property_today") | F.col("in_house_tonight")
    score = R.priority_score(
        F.col("priority_weight"), F.coalesce("tier_id", F.lit(1)), F.col("days_since_event"), present, F.col("is_vip"),
        policy.weights,
    )
    status = R.recommendation_status(
        F.col("is_eligible"), F.col("rg_review_flag"), F.col("comps_cooldown_usd"), F.col("score"),
        F.col("reward_budget_usd"), F.col("remaining_budget_usd"), policy,
    )
    return enriched.withColumn("score", score).withColumn("recommendation_status", status)


def talking_point(policy: Policy) -> Column:
    """The rule's text with the guest's name and value, or the check-in script."""
    check_in = F.col("recommendation_status") == P.RG_CHECK_IN
    name = F.col("first_name")
    return F.when(check_in, R.render_template(F.lit(policy.check_in_text), first_name=name)).otherwise(
        R.render_template(F.col("talking_point"), first_name=name, value=R.whole_number_text(F.col("achieved_value")))
    )


def recommendations(
    milestones: DataFrame,
    profile: DataFrame,
    budgets: DataFrame,
    guardrails: DataFrame,
    as_of: dt.date,
    policy: Policy,
) -> DataFrame:
    """One row per milestone open on ``as_of``, with status, action, reward and wording."""
    decided = decide(enrich(actionable(milestones, as_of), profile, budgets, guardrails, policy), policy)
    status = F.col("recommendation_status")
    check_in = status == P.RG_CHECK_IN
    return decided.select(
        F.col("milestone_id").alias("recommendation_id"),
        F.lit(as_of).alias("as_of_date"),
        "player_id", "first_name", "last_name", "full_name", "tier_id", "tier_name", "is_vip",
        "current_property_id", "current_property_name", "on_property_today", "in_house_tonight",
        "rule_id", "milestone_family", "milestone_name", "achieved_value", "event_date", "days_since_event",
        F.date_add("event_date", F.col("recognition_window_days")).alias("actionable_through"),
        "recommendation_status", "rg_review_flag", "rg_reason",
        F.round("score", 1).alias("priority_score"),
        F.when(check_in, policy.check_in_action).otherwise(F.col("recommended_action")).alias("final_action"),
        F.when(check_in, "PersonalNote").otherwise(F.col("reward_type")).alias("final_reward_type"),
        R.capped_reward(status, F.col("reward_budget_usd"), F.col("remaining_budget_usd")).alias("approved_reward_usd"),
        "action_owner",
        talking_point(policy).alias("talking_point"),
        "favorite_outlet_name", "favorite_game_category", "visit_days_12m", "lifetime_visit_days",
        "lifetime_theo_win", "member_years", "comps_cooldown_usd", "comps_window_usd", "remaining_budget_usd",
    )


def listing_order() -> list[Column]:
    """Check-ins first, then by score; the id makes the order total."""
    check_in_first = F.when(F.col("recommendation_status") == P.RG_CHECK_IN, 0).otherwise(1)
    return [check_in_first.asc(), F.col("priority_score").desc_nulls_last(), F.col("recommendation_id").asc()]


def headlines(recs: DataFrame) -> DataFrame:
    """Per guest the best showable recommendation, the names of the others folded in."""
    shown = recs.where(F.col("recommendation_status").isin(P.RECOMMEND, P.RG_CHECK_IN))
    return fold_rest(shown, "player_id", listing_order(), "milestone_name", "other_milestones")


def worklist(recs: DataFrame, policy: Policy) -> DataFrame:
    """What a host reads: one row per guest, the best ranked rows per property."""
    ranked = top_n(
        headlines(recs), "current_property_id", listing_order(), policy.worklist_size, "worklist_rank",
        salt_by="recommendation_id",
    )
    return ranked.select(
        "as_of_date",
        F.col("current_property_id").alias("property_id"),
        F.col("current_property_name").alias("property_name"),
        "worklist_rank", "recommendation_id", "player_id",
        F.col("full_name").alias("guest_name"),
        "tier_name",
        R.presence(F.col("in_house_tonight"), F.col("on_property_today")).alias("presence"),
        "recommendation_status", "rg_reason",
        F.col("milestone_name").alias("headline_milestone"),
        F.col("final_action").alias("recommended_action"),
        "action_owner",
        F.col("final_reward_type").alias("reward_type"),
        "approved_reward_usd", "talking_point", "other_milestones", "actionable_through", "priority_score",
        R.context_text(
            F.col("member_years"), F.col("lifetime_visit_days"), F.col("favorite_outlet_name")
        ).alias("guest_context"),
    )


def worklist_for(worklist_rows: DataFrame, property_name: str) -> DataFrame:
    """One property's list as a host would read it, in rank order."""
    return (
        worklist_rows.where(F.col("property_name") == property_name)
        .select(
            "worklist_rank", "guest_name", "tier_name", "presence", "headline_milestone", "recommended_action",
            "action_owner", "approved_reward_usd", "talking_point", "other_milestones",
        )
        .orderBy("worklist_rank")
    )
