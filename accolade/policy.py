"""Policy values and metric registries that drive every operator.

Nothing here touches Spark.  A ``Policy`` is frozen, so one run sees one set of
values; back-tests and tuning go through ``dataclasses.replace``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --- Fixed values: names and labels that appear in the output tables ----------

RECOMMEND = "RECOMMEND"
RG_CHECK_IN = "RG_CHECK_IN"
SUPPRESSED_COOLDOWN = "SUPPRESSED_COOLDOWN"
SUPPRESSED_BUDGET = "SUPPRESSED_BUDGET"
INELIGIBLE = "INELIGIBLE"
STATUSES = (RECOMMEND, RG_CHECK_IN, SUPPRESSED_COOLDOWN, SUPPRESSED_BUDGET, INELIGIBLE)

REWARD_TYPES = ("PersonalNote", "NonGaming", "GamingOffer", "Experience")

METRIC_NAMES = (
    "lifetime_theo_win",
    "lifetime_visit_days",
    "lifetime_hotel_nights",
    "lifetime_dining_spend",
    "consecutive_visit_months",
    "days_since_prior_visit",
    "daily_jackpot_total",
    "tier_level",
    "membership_years",
    "birthday",
    "age_at_birthday",
)

ACTIVITY_MEASURES = (
    "gaming_sessions",
    "gaming_minutes",
    "theo_win",
    "actual_win",
    "cash_in",
    "points_earned",
    "dining_checks",
    "dining_spend",
    "hotel_stays",
    "hotel_nights",
    "hotel_revenue",
    "jackpot_count",
    "jackpot_amount",
)
VISIT_MEASURES = ("gaming_sessions", "dining_checks", "hotel_stays")

CUMULATIVE_METRICS = {
    "lifetime_theo_win": "theo_win",
    "lifetime_visit_days": "visit_flag",
    "lifetime_hotel_nights": "hotel_nights",
    "lifetime_dining_spend": "dining_spend",
}

ACTIVE = "Active"
CLOSED_CHECK = "Closed"
STAY_STATUSES = ("InHouse", "CheckedOut")

REASON_LONG_PLAY = "extended play time"
REASON_HEAVY_LOSS = "losses well above guest norm"
REASON_NO_MEMBER = "not a loyalty member"
REASON_PLAYER_STATUS = "player status: "
REASON_MEMBER_STATUS = "member status: "
REASON_UNDER_AGE = "under minimum age"

PRESENCE_IN_HOUSE = "In house tonight"
PRESENCE_ON_PROPERTY = "On property today"
PRESENCE_ABSENT = "Not on property yet"


@dataclass(frozen=True)
class ScoreWeights:
    """Weights of the linear priority score."""

    per_tier: float = 3.0
    present: float = 15.0
    vip: float = 5.0
    per_day_late: float = 1.5
    late_days_cap: int = 14


@dataclass(frozen=True)
class Policy:
    """Every tunable of a run; defaults are the shipped policy."""

    # calendar
    as_of_date: dt.date | None = None
    utc_offset_hours: int = -7
    day_start_hour: int = 6

    # who may be recognised, and how often
    min_age: int = 21
    cooldown_days: int = 14
    cooldown_min_usd: float = 25.0
    cooldown_override_score: float = 90.0
    budget_window_days: int = 30
    default_budget_usd: float = 100.0
    calendar_window_days: int = 45

    # a back-test sees the tiers and the members of its day; by default it sees today's
    strict_as_of: bool = False

    worklist_size: int = 25

    # responsible gaming
    rg_recent_days: int = 2
    rg_baseline_days: int = 90
    rg_min_loss_usd: float = 2500.0
    rg_loss_multiple: float = 3.0
    rg_max_minutes: int = 600

    # preferences and value look-back
    trailing_days: int = 365

    # text used instead of the rule's own when a guest is flagged, and a phrase of it that checks look for
    check_in_text: str = (
        "{first_name}, a word in private: the advisers at our welcome desk set play limits and time-outs "
        "on request, at any hour and in confidence. Shall I walk you over?"
    )
    check_in_action: str = (
        "Speak with the guest alone and make no offer of any kind. Say that advisers are at the welcome desk "
        "and what they can set up, then leave the choice to the guest."
    )
    check_in_phrase: str = "play limits and time-outs"

    weights: ScoreWeights = ScoreWeights()

    # names of soft-delete columns a landed table may carry (* stands for a loader's own word), and
    # the systems whose every table must carry one
    deleted_flags: tuple[str, ...] = ("_deleted", "is_deleted", "_*_deleted")
    deleted_flag_required: frozenset[str] = frozenset()

    # metric registries: add a line here to add a measure or a cumulative metric
    activity_measures: tuple[str, ...] = ACTIVITY_MEASURES
    visit_measures: tuple[str, ...] = VISIT_MEASURES
    cumulative_metrics: dict[str, str] = field(default_factory=lambda: dict(CUMULATIVE_METRICS))
