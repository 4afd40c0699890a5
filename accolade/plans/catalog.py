"""Every operator and model as a named query over the sample tables.

Each query takes a session and the folder of the sample tables, runs over whole tables, and
returns a lazy DataFrame.  Outputs use BIGINT, DOUBLE, DATE, TIMESTAMP, STRING and BOOLEAN
only; sums are taken in DECIMAL and widened at the very end, so they do not depend on order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accolade import policy as P
from accolade.functions import dates as D
from accolade.functions import recognition as R
from accolade.operators import asof as AO
from accolade.operators import entity_day as ED
from accolade.operators import joins as J
from accolade.operators import quality as Q
from accolade.operators import rules as RU
from accolade.operators import windows as W
from accolade.operators.balances import days_after
from accolade.operators.entity_day import zero_filled
from accolade.operators.events import unpivot_cumulative
from accolade.plans import balance_book as BB
from accolade.plans import guest360 as G
from accolade.plans import recommend as RE
from accolade.plans.pipeline import LAYERS, STAGED_WORKLIST, CutBySteps, Keep, Recognition, cutting, lazily, publish_staging
from accolade.plans.rolling import RollingMilestones
from accolade.policy import Policy
from accolade.sources import readers, sample, sinks
from accolade.sources.staging import SOURCE_COLUMNS
from accolade.streaming.refresh import touched_days

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = sample.AS_OF
FRESHNESS_NOW = dt.datetime(2024, 1, 31, 0, 0, 0)
LISTED_PROPERTY = "EUROPE"

# The entity-days feed several later tables: they are written once and read back.
CUT_LABELS = ("guest_activity_daily",)


def published(df: DataFrame) -> DataFrame:
    """Output types: exact decimals become DOUBLE, integers BIGINT."""
    wide = {T.IntegerType: "bigint", T.ShortType: "bigint", T.DecimalType: "double"}
    return df.select(*[
        F.col(f"`{f.name}`").cast(wide[type(f.dataType)]).alias(f.name) if type(f.dataType) in wide
        else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def recognition_run(spark: SparkSession, sf_dir: str, keep: Keep = lazily, policy: Policy | None = None) -> Recognition:
    """A run over the sample tables with the sample rules."""
    return Recognition(
        sample.landed_tables(spark, sf_dir),
        readers.shipped_seed(spark, "sample_rules.csv", readers.RULE_SCHEMA),
        readers.shipped_seed(spark, "tier_budgets.csv", readers.BUDGET_SCHEMA),
        policy or Policy(as_of_date=AS_OF),
        keep,
    )


def _of_run(pick: Callable[[Recognition], DataFrame], *labels: str) -> Query:
    """A query on a run's tables; ``labels`` are written to the shared folder on the way."""
    keep = cutting(*labels) if labels else lazily
    return lambda spark, sf_dir: published(pick(recognition_run(spark, sf_dir, keep)))


# --- scans, sources, sinks ---------------------------------------------------------


def scan_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = sample.registry(sf_dir)
    counted = [
        readers.read_source(spark, reg, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("source"), "n_rows")
        for t in ("region", "nation", "customer", "orders", "lineitem")
    ]
    return published(reduce(DataFrame.unionByName, counted))


def select_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.landed_tables(spark, sf_dir)["player_session"]
    return published(readers.select_normalized(raw, ["session_id", "player_id", "gaming_date", "minutes_played"]))


def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.landed_tables(spark, sf_dir)["player"]
    return published(readers.live_rows(raw).select("playerid", "_deleted"))


def minimize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.landed_tables(spark, sf_dir)["player"]
    return published(readers.select_normalized(raw, SOURCE_COLUMNS["player"]))


def rules_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule of the catalog with the number of events that cross it."""
    run = recognition_run(spark, sf_dir, cutting(*CUT_LABELS))
    fired = RU.cross_thresholds(run.metric_events, run.rules).groupBy("rule_id").agg(F.count("*").alias("n"))
    return published(
        run.rules.join(fired, "rule_id", "left").select(
            "rule_id", "milestone_family", "metric_name", "threshold", "lead_days", "recognition_window_days",
            "reward_type", "reward_budget_usd", "is_active", F.coalesce("n", F.lit(0)).alias("n_events"),
        )
    )


def budget_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tier's budget with its number of members."""
    run = recognition_run(spark, sf_dir)
    members = run.staged["member"].groupBy("tier_id").agg(F.count("*").alias("n"))
    return published(
        run.guardrails.join(members, "tier_id", "left").select(
            "tier_id", "tier_name", "max_reward_usd_30d", F.coalesce("n", F.lit(0)).alias("n_members")
        )
    )


def table_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks written partitioned by status, read back and summed."""
    checks = recognition_run(spark, sf_dir).staged["check"].select("check_id", "check_status", "subtotal")
    path = sinks.fresh_path(spark, "checks")
    sinks.write_table(checks, path, ["check_status"])
    back = spark.read.parquet(path)
    return published(back.groupBy("check_status").agg(F.count("*").alias("n"), F.sum("subtotal").alias("subtotal")))


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(readers.freshness_report(spark, sample.registry(sf_dir), sample.SYSTEMS, FRESHNESS_NOW))


def staging_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guests and live members per status, asked in SQL of the registered staging views."""
    publish_staging(recognition_run(spark, sf_dir), "sample_")
    return published(spark.sql("""
        SELECT player_status, count(*) AS n_guests, count(m.member_id) AS n_members
        FROM sample_stg_player p LEFT JOIN sample_stg_member m ON m.player_id = p.player_id
        GROUP BY player_status"""))


#: A moment of the as-of day by the policy's clock rules, though its date in UTC is the day after.
CLOCK = dt.datetime(2000, 3, 16, 12, 59, 59, tzinfo=dt.timezone.utc)


def clock_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guests active on the business day that a clock handed in falls on."""
    day = D.resolve_as_of(Policy(), CLOCK)
    run = recognition_run(spark, sf_dir, policy=Policy(as_of_date=day))
    return published(
        run.activity.where(F.col("activity_date") == F.lit(run.as_of)).select("player_id", "activity_date", "visit_flag"))


def _staged(name: str) -> Query:
    return _of_run(lambda run: run.staged[name])


# --- projections, predicates, scalar functions ---------------------------------------


def stage_projection(run: Recognition) -> DataFrame:
    return run.staged["jackpot"].join(
        run.staged["player"].select("player_id", "full_name", "is_vip"), "player_id"
    ).select("jackpot_id", "player_id", "full_name", "is_vip", "gaming_date", "jackpot_amount")


def filter_status_in(run: Recognition) -> DataFrame:
    stays = run.staged["reservation"]
    return stays.where(
        F.col("player_id").isNotNull() & F.col("reservation_status").isin(*P.STAY_STATUSES)
    ).select("reservation_id", "player_id", "reservation_status")


def zero_fill(run: Recognition) -> DataFrame:
    """Checks as zero-filled measure rows."""
    known = {"dining_checks": "1", "dining_spend": "subtotal"}
    return run.staged["check"].selectExpr("check_id", *zero_filled(run.policy.activity_measures, known))


def business_day(run: Recognition) -> DataFrame:
    """Business day of every check, and whether it is the as-of day by the raw-timestamp form."""
    closed = F.col("closed_at")
    return run.staged["check"].select(
        "check_id", D.business_day(closed, 6).alias("business_day"),
        D.in_business_days(closed, AS_OF, AS_OF, 6).alias("is_today"),
    )


def date_arith(run: Recognition) -> DataFrame:
    day, today = F.col("arrival_date"), F.lit(AS_OF)
    return run.staged["reservation"].select(
        "reservation_id",
        D.days_between(day, today).alias("days"),
        D.year_boundaries(day, today).alias("years"),
        D.add_years(day, 4).alias("four_years_on"),
        F.date_add(day, 45).alias("days_on"),
        D.month_start(day).alias("month_start"),
        D.month_index(day).alias("month_index"),
        F.dayofmonth(day).alias("day_of_month"),
    )


def age_on(run: Recognition) -> DataFrame:
    guests = run.staged["player"].join(run.staged["member"].select("player_id", "enroll_date"), "player_id", "left")
    return guests.select(
        "player_id",
        D.age_on(F.col("date_of_birth"), F.lit(AS_OF)).alias("age_years"),
        D.age_on(F.col("enroll_date"), F.lit(AS_OF)).alias("member_years"),
    )


def _case_inputs(run: Recognition) -> DataFrame:
    """Scoring inputs that cover every branch, one row per check."""
    key = F.col("check_id")
    return run.staged["check"].select(
        "check_id",
        (key % 11 != 0).alias("eligible"),
        (key % 7 == 0).alias("flagged"),
        (key % 60).cast("double").alias("recent_comps"),
        (key % 1000 * 0.5 - 100).alias("rule_budget"),
        (key % 700 - 200.0).alias("remaining"),
        (key % 66 + 30).alias("base"),
        (key % 5 + 1).alias("tier"),
        (key % 30 - 5).alias("days_since"),
        (key % 3 == 0).alias("present"),
        F.when(key % 13 != 0, key % 4 == 0).alias("vip"),
    )


def _score() -> Column:
    return R.priority_score(*[F.col(c) for c in ("base", "tier", "days_since", "present", "vip")])


def priority_score(run: Recognition) -> DataFrame:
    return _case_inputs(run).select("check_id", F.round(_score(), 1).alias("priority_score"))


def _status() -> Column:
    cols = [F.col(c) for c in ("eligible", "flagged", "recent_comps", "score", "rule_budget", "remaining")]
    return R.recommendation_status(*cols, Policy())


def status_cascade(run: Recognition) -> DataFrame:
    return _case_inputs(run).withColumn("score", _score()).select(
        "check_id", _status().alias("recommendation_status")
    )


def capped_reward(run: Recognition) -> DataFrame:
    decided = _case_inputs(run).withColumn("score", _score()).withColumn("status", _status())
    return decided.select(
        "check_id", R.capped_reward(F.col("status"), F.col("rule_budget"), F.col("remaining")).alias("approved_reward_usd")
    )


def render_template(run: Recognition) -> DataFrame:
    guests = run.staged["player"].select("player_id", F.col("full_name").alias("name"))
    paid = run.staged["check"].where(F.col("member_id").isNotNull()).groupBy("member_id").agg(
        F.sum("subtotal").alias("spend")
    )
    spent = paid.join(run.staged["member"].select("member_id", "player_id"), "member_id")
    text = R.render_template(
        F.lit("{first_name}, it's {value} in all"), first_name=F.col("name"), value=R.whole_number_text(F.col("spend"))
    )
    return guests.join(spent, "player_id").select("player_id", text.alias("talking_point"))


def context_text(run: Recognition) -> DataFrame:
    years = D.age_on(F.col("enroll_date"), F.lit(AS_OF))
    spot = F.when(F.col("player_id") % 3 != 0, F.col("last_name"))
    return run.staged["player"].join(run.staged["member"].select("player_id", "enroll_date"), "player_id", "left").select(
        "player_id", R.context_text(years, F.col("player_id") % 40, spot).alias("guest_context")
    )


def surrogate_key(run: Recognition) -> DataFrame:
    return run.staged["check"].select(
        "check_id",
        R.surrogate_key(F.col("check_id"), F.col("member_id"), F.col("closed_at").cast("date")).alias("key"),
    )


def actionable_window(run: Recognition) -> DataFrame:
    return RU.actionable(run.milestones, run.as_of).select(
        "milestone_id", "player_id", "rule_id", "event_date", "days_since_event"
    )


# --- joins ------------------------------------------------------------------------------


def inner_equi_join(run: Recognition) -> DataFrame:
    """Checks with their member, through the join that isolates hot keys."""
    checks = run.staged["check"].select("check_id", "member_id", "subtotal")
    return J.lookup_join(checks, run.staged["member"].select("member_id", "player_id", "tier_id"), "member_id")


def left_outer_join(run: Recognition) -> DataFrame:
    checks = run.staged["check"].select("check_id", "member_id")
    return J.lookup_join(checks, run.staged["member"].select("member_id", "player_id"), "member_id", "left")


def role_playing_dim(run: Recognition) -> DataFrame:
    """Property joined twice: where the guest lives and where the member enrolled."""
    prop = run.staged["property"]
    role = lambda r: prop.select(F.col("property_id").alias(f"{r}_property_id"), F.col("property_name").alias(f"{r}_name"))
    return (
        run.staged["player"].select("player_id", "home_property_id")
        .join(run.staged["member"].select("player_id", "enroll_property_id"), "player_id")
        .join(role("home"), "home_property_id", "left")
        .join(role("enroll"), "enroll_property_id", "left")
        .select("player_id", "home_name", "enroll_name")
    )


def threshold_crossing(run: Recognition) -> DataFrame:
    return RU.cross_thresholds(run.metric_events, run.rules)


def comp_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent comps per guest where some guests hold two memberships."""
    run = recognition_run(spark, sf_dir)
    cards = Recognition(
        sample.with_second_cards(sample.landed_tables(spark, sf_dir)), run.rules, run.guardrails, run.policy)
    return published(cards.comp_budget)


# --- aggregates and windows ----------------------------------------------------------------


def trailing_window(run: Recognition) -> DataFrame:
    """Theoretical win and visits of the trailing year, per guest."""
    return W.trailing_agg(
        run.activity, "player_id", "activity_date", run.as_of, run.policy.trailing_days,
        {"theo_win_12m": F.sum("theo_win"), "visit_days_12m": F.sum("visit_flag")},
    )


def latest_snapshot(run: Recognition) -> DataFrame:
    wanted = ["player_id", "activity_date"] + [f"cum_{m}" for m in run.policy.cumulative_metrics]
    return W.latest_per_key(run.cumulative.select(*wanted), "player_id", "activity_date", run.as_of)


def presence_flags(run: Recognition) -> DataFrame:
    return run.guest_360.select("player_id", "on_property_today", "in_house_tonight", "current_property_id")


def eligibility(run: Recognition) -> DataFrame:
    guests = run.staged["player"].join(
        run.staged["member"].select("player_id", "member_id", "member_status"), "player_id", "left"
    ).withColumn("age_years", D.age_on(F.col("date_of_birth"), F.lit(run.as_of)))
    args = [F.col(c) for c in ("member_id", "player_status", "member_status", "age_years")]
    return guests.select(
        "player_id", R.is_eligible(*args, run.policy.min_age).alias("is_eligible"),
        R.ineligible_reason(*args, run.policy.min_age).alias("ineligible_reason"),
    )


def headline_per_entity(run: Recognition) -> DataFrame:
    shown = run.recommendations.where(F.col("recommendation_status").isin(P.RECOMMEND, P.RG_CHECK_IN))
    return W.best_per_key(shown, "player_id", RE.listing_order()).select(
        "player_id", "recommendation_id", "recommendation_status", "priority_score", "milestone_name"
    )


def fold_others(run: Recognition) -> DataFrame:
    return RE.headlines(run.recommendations).select("player_id", "milestone_name", "other_milestones")


def topn_per_partition(run: Recognition) -> DataFrame:
    """The 25 largest closed checks of each outlet, ranked."""
    checks = run.staged["check"].where(F.col("check_status") == P.CLOSED_CHECK).select(
        "outlet_id", "check_id", "subtotal"
    )
    order = [F.col("subtotal").desc_nulls_last(), F.col("check_id").asc()]
    return W.top_n(checks, "outlet_id", order, run.policy.worklist_size, "rank", salt_by="check_id")


def worklist_for_property(run: Recognition) -> DataFrame:
    return RE.worklist_for(run.worklist, LISTED_PROPERTY)


# --- back-tests -------------------------------------------------------------------------


def tier_on_day(run: Recognition) -> DataFrame:
    """Members enrolled by the as-of day with the tier they had on it."""
    return G.members_on(run.staged, run.as_of).select("member_id", "tier_id")


def strict_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guest 360 of a back-test that sees the tiers and members of its day."""
    return published(recognition_run(spark, sf_dir, policy=Policy(as_of_date=AS_OF, strict_as_of=True)).guest_360)


def check_tier(run: Recognition) -> DataFrame:
    """Every check with the tier its member had on its business day."""
    moves = run.staged["tier_history"].where(F.col("member_id").isNotNull())
    stretches = AO.intervals(moves, "member_id", "change_date", "tier_history_id", "old_tier_id", "new_tier_id", "tier_then")
    checks = run.staged["check"].select("check_id", "member_id", D.business_day(F.col("closed_at"), run.policy.day_start_hour).alias("day"))
    return AO.as_of_join(checks, "member_id", "day", stretches, "tier_then")


# --- balances ---------------------------------------------------------------------------

#: Ends of months before the as-of day: inside the rules' reach, and older than the 360's look-back.
BALANCE_DAY, OLD_BALANCE_DAY = BB.month_end(AS_OF, 2), BB.month_end(AS_OF, 14)


def _with_book(spark: SparkSession, sf_dir: str) -> Recognition:
    """A run with balances of its stored entity-days."""
    run = recognition_run(spark, sf_dir, cutting(*CUT_LABELS))
    run.balances = BB.BalanceBook(spark, sinks.fresh_path(spark, "balances"))
    run.balances.close(run.activity, [OLD_BALANCE_DAY, BALANCE_DAY], run.policy)
    return run


def opening_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each guest's balance at the end of a month, carried on from the one a year before."""
    return published(_with_book(spark, sf_dir).balances.before(AS_OF)[1])


def continued_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals and streaks of the days after a balance, from that balance."""
    run = _with_book(spark, sf_dir)
    opened, opening = run.balances.before(AS_OF)
    totals = ED.running_totals(days_after(run.activity, opened), run.policy.cumulative_metrics, opening=opening)
    kept = [f"cum_{m}" for m in run.policy.cumulative_metrics]
    return published(
        ED.with_streaks(totals, F.col("visit_flag") == 1).select("player_id", "activity_date", *kept, "prior_activity_date", "streak_months"))


def recommendations_from_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(_with_book(spark, sf_dir).recommendations)


LATE_DAYS = 20


def refreshed_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The milestone history built without some sessions of the last days, refreshed when they land."""
    late = (F.col("SessionID") % 5 == 0) & (F.col("GamingDate") >= F.lit(AS_OF - dt.timedelta(days=LATE_DAYS)))
    whole = recognition_run(spark, sf_dir, cutting(*CUT_LABELS))
    landed = sample.landed_tables(spark, sf_dir)
    sessions = landed["player_session"]
    before = Recognition(
        {**landed, "player_session": sessions.where(~late)}, whole.rules, whole.guardrails, whole.policy, cutting(*CUT_LABELS))
    history = RollingMilestones(sinks.fresh_path(spark, "milestones"), BB.BalanceBook(spark, sinks.fresh_path(spark, "balances")))
    history.build(before)
    whole.balances = history.book
    history.refresh(whole, touched_days(sessions.where(late), "player_session", whole.policy), before.as_of)
    return published(history.milestones())


# --- data quality -------------------------------------------------------------------------------


def dq_unique(run: Recognition) -> DataFrame:
    """Players with more than one hotel stay: as many violations of uniqueness."""
    return Q.check_unique(run.staged["reservation"], "player_id")


def dq_not_null(run: Recognition) -> DataFrame:
    return Q.check_not_null(run.staged["check"], "member_id").select("check_id", "check_status")


def dq_accepted_values(run: Recognition) -> DataFrame:
    return Q.check_accepted_values(run.staged["player"], "player_status", ["Active", "Inactive"])


def dq_relationships(run: Recognition) -> DataFrame:
    """Comps of members that do not exist."""
    return Q.check_relationships(run.staged["comp"], "member_id", run.staged["member"], "member_id")


def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.read_source(spark, sample.registry(sf_dir), "lineitem")
    return published(Q.check_unique(lines, "l_orderkey", "l_linenumber"))


def dq_one_row_per_key(run: Recognition) -> DataFrame:
    """Member and outlet pairs with more than one check."""
    return Q.check_one_row_per_key(run.staged["check"], "outlet_id", "member_id")


def _as_if_unguarded(run: Recognition) -> DataFrame:
    """The recommendations as they would be without the flagged-guest branch: each check has
    violations to find."""
    recs = run.recommendations
    return recs.withColumns({
        "final_reward_type": F.when(F.col("rg_review_flag"), "GamingOffer").otherwise(F.col("final_reward_type")),
        "approved_reward_usd": F.col("approved_reward_usd") + F.when(F.col("rg_review_flag"), 1000.0).otherwise(0.0),
        "talking_point": F.when(
            F.col("recommendation_status") == P.RG_CHECK_IN, F.col("milestone_name")
        ).otherwise(F.col("talking_point")),
    })


def dq_no_incentive_when_flagged(run: Recognition) -> DataFrame:
    return Q.check_no_incentive_when_flagged(_as_if_unguarded(run))


def dq_reward_within_budget(run: Recognition) -> DataFrame:
    return Q.check_reward_within_budget(_as_if_unguarded(run))


def dq_script_match(run: Recognition) -> DataFrame:
    return Q.check_script_match(_as_if_unguarded(run), run.policy.check_in_phrase)


def dq_excludes_ineligible(run: Recognition) -> DataFrame:
    """All recommendations taken as a list: the barred guests among them."""
    return Q.check_excludes_ineligible(run.recommendations, run.guest_360)


# Tables that the report reads several times; the 360 is read from the profile, which the recommendations need too.
REPORT_LABELS = ("guest_activity_daily", "guest_metric_events", "guest_profile", "guest_milestones", "recommendations",
                 STAGED_WORKLIST)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the run, a layer at a time, as a build checks them.

    The counts of a layer are stored before the tables of the next are made, so the disk holds the
    exchanges of one step only.  The profile is made before the metric events take their room.
    """
    keep = CutBySteps(*REPORT_LABELS)
    run = recognition_run(spark, sf_dir, keep)
    counts = []
    for layer in LAYERS:
        if layer == "intermediate":
            run.profile  # noqa: B018 - built on first use
        counts.append(keep.step(run.check_report([layer]), f"report_{layer}")[0])
    return published(reduce(DataFrame.unionByName, counts))


def _whole_cut(pick: Callable[[Recognition], DataFrame]) -> Query:
    return _of_run(pick, *CUT_LABELS)


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    out: dict[str, Query] = {
        f.__name__: f
        for f in (scan_sources, select_normalized, live_rows, minimize_columns, rules_catalog, budget_catalog,
                  table_sink_roundtrip, source_freshness, staging_views, clock_day, dq_unique_combination,
                  strict_360, opening_balances, continued_totals, recommendations_from_balances, refreshed_milestones,
                  dq_report)
    }
    out.update({f"stg_{name}": _staged(name) for name in SOURCE_COLUMNS})
    on_staging = (
        stage_projection, filter_status_in, zero_fill, business_day, date_arith, age_on, priority_score,
        status_cascade, capped_reward, render_template, context_text, surrogate_key, inner_equi_join,
        left_outer_join, role_playing_dim, eligibility, topn_per_partition, dq_unique, dq_not_null,
        dq_accepted_values, dq_relationships, dq_one_row_per_key, trailing_window, latest_snapshot,
        tier_on_day, check_tier,
    )
    out.update({f.__name__: _of_run(f) for f in on_staging})
    out.update({
        "entity_day_activity": _of_run(lambda r: r.activity),
        "visit_flag": _of_run(lambda r: r.activity.select("player_id", "activity_date", "visit_flag")),
        "running_totals": _of_run(lambda r: r.cumulative),
        "visit_streaks": _of_run(lambda r: r.streaks),
        "calendar_events": _of_run(lambda r: r.calendar),
        "unpivot_cumulative": _of_run(lambda r: unpivot_cumulative(r.cumulative, r.policy.cumulative_metrics)),
        "baseline_anomaly": _of_run(lambda r: r.rg_signals),
        "comp_budget": comp_budget,
        "favorite_game": _of_run(lambda r: G.favorite_game(r.staged["player_session"], r.as_of, r.policy)),
        "favorite_outlet": _of_run(
            lambda r: G.favorite_outlet(r.staged["check"], r.staged["member"], r.staged["outlet"])
        ),
        "property_today": _of_run(lambda r: G.property_today(r.staged["player_session"], r.as_of)),
        "in_house": _of_run(lambda r: G.in_house(r.staged["reservation"], r.as_of)),
        "metric_events": _whole_cut(lambda r: r.metric_events),
        "milestones": _whole_cut(lambda r: r.milestones),
        "entity_360": _of_run(lambda r: r.guest_360),
        "recommendations": _whole_cut(lambda r: r.recommendations),
        "worklist": _whole_cut(lambda r: r.worklist),
        "presence_flags": _of_run(presence_flags),
    })
    on_recs = (
        actionable_window, threshold_crossing, headline_per_entity, fold_others, worklist_for_property,
        dq_no_incentive_when_flagged, dq_reward_within_budget, dq_script_match, dq_excludes_ineligible,
    )
    out.update({f.__name__: _whole_cut(f) for f in on_recs})
    return out
