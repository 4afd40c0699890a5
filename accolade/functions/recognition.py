"""Scoring, reward and text expressions of the recognition policy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.policy import Policy, ScoreWeights

def surrogate_key(*cols: Column, null_tag: str = "_null_") -> Column:
    """MD5 of the columns' text joined by ``-``; NULL parts are tagged, never skipped."""
    parts = [F.coalesce(c.cast("string"), F.lit(null_tag)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def clamp(value: Column, low: Column | float, high: Column | float) -> Column:
    low_c = low if isinstance(low, Column) else F.lit(low)
    high_c = high if isinstance(high, Column) else F.lit(high)
    return F.least(F.greatest(value, low_c), high_c)


def priority_score(
    base: Column,
    tier: Column,
    days_since: Column,
    present: Column,
    vip: Column,
    weights: ScoreWeights = ScoreWeights(),
) -> Column:
    """Rule weight plus tier, presence and VIP bonuses, minus a penalty for lateness."""
    lateness = clamp(days_since, 0, weights.late_days_cap)
    bonus = F.when(present, weights.present).otherwise(0.0) + F.when(vip, weights.vip).otherwise(0.0)
    return base + tier * weights.per_tier + bonus - lateness * weights.per_day_late


def recommendation_status(
    eligible: Column,
    flagged: Column,
    recent_comps: Column,
    score: Column,
    rule_budget: Column,
    remaining: Column,
    policy: Policy,
) -> Column:
    """First matching status wins; the order of the branches is the policy."""
    cooling = (recent_comps >= policy.cooldown_min_usd) & (score < policy.cooldown_override_score)
    exhausted = (rule_budget > 0) & (remaining <= 0)
    return (
        F.when(~eligible, P.INELIGIBLE)
        .when(flagged, P.RG_CHECK_IN)
        .when(cooling, P.SUPPRESSED_COOLDOWN)
        .when(exhausted, P.SUPPRESSED_BUDGET)
        .otherwise(P.RECOMMEND)
    )


def capped_reward(status: Column, rule_budget: Column, remaining: Column) -> Column:
    """What may be spent: the rule's budget, held to what the tier has left."""
    return F.when(status == P.RECOMMEND, clamp(rule_budget, 0.0, F.greatest(remaining, F.lit(0.0)))).otherwise(0.0)


def whole_number_text(value: Column) -> Column:
    """Rounded half away from zero, without decimals (BIGINT, so large totals fit)."""
    return F.round(value, 0).cast("bigint").cast("string")


def render_template(template: Column, **values: Column) -> Column:
    """Replace each ``{name}`` placeholder by its value; NULL values give NULL."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def presence(in_house: Column, on_property: Column) -> Column:
    return (
        F.when(in_house, P.PRESENCE_IN_HOUSE)
        .when(on_property, P.PRESENCE_ON_PROPERTY)
        .otherwise(P.PRESENCE_ABSENT)
    )


def context_text(member_years: Column, visits: Column, spot: Column) -> Column:
    """One line about the guest; NULL only if the membership or visit count is NULL.

    Fixed values: the words of the line, which consumers of the list read as they are.
    """
    return F.concat(
        F.lit("Member "), member_years.cast("string"), F.lit(" yrs - "),
        visits.cast("string"), F.lit(" visits - favorite spot: "), F.coalesce(spot, F.lit("n/a")),
    )


def ineligible_reason(
    member_id: Column, player_status: Column, member_status: Column, age: Column, min_age: int
) -> Column:
    return (
        F.when(member_id.isNull(), P.REASON_NO_MEMBER)
        .when(player_status != P.ACTIVE, F.concat(F.lit(P.REASON_PLAYER_STATUS), player_status))
        .when(member_status != P.ACTIVE, F.concat(F.lit(P.REASON_MEMBER_STATUS), member_status))
        .when(age < min_age, P.REASON_UNDER_AGE)
    )


def is_eligible(
    member_id: Column, player_status: Column, member_status: Column, age: Column, min_age: int
) -> Column:
    """True only if every condition is known to hold; NULL inputs give false."""
    holds = (
        member_id.isNotNull()
        & (player_status == P.ACTIVE)
        & (member_status == P.ACTIVE)
        & (age >= min_age)
    )
    return F.coalesce(holds, F.lit(False))
