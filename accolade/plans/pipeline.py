"""One recognition run: landed tables in, every intermediate and mart table out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.functions.dates import resolve_as_of
from accolade.operators import entity_day as ED
from accolade.operators import events as EV
from accolade.operators import quality as Q
from accolade.operators import rules as RU
from accolade.operators import signals as SG
from accolade.operators.balances import days_after
from accolade.operators.windows import days_within
from accolade.plans import guest360 as G
from accolade.plans import recommend as RE
from accolade.plans.activity import guest_activity
from accolade.plans.balance_book import BalanceBook
from accolade.policy import Policy
from accolade.sources.sinks import cut, fresh_path, release, save_table, shuffles_removed, smaller_splits, write_table
from accolade.sources.staging import stage_all

Keep = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, label: str) -> DataFrame:
    """Leave every table as a plan."""
    return df


def cutting(*labels: str) -> Keep:
    """Write the named tables to the shared folder and go on from there.

    The entity-days are bucketed by guest: that exchange is paid once, and the running
    windows, the snapshot and the signals all read their buckets in place.
    """

    def keep(df: DataFrame, label: str) -> DataFrame:
        if label not in labels:
            return df
        if label == "guest_activity_daily":
            return cut(df, label, "player_id", ("player_id", "activity_date"))
        return cut(df, label)

    return keep


class CutBySteps:
    """Writes the named tables to the shared folder like ``cutting``, with little on disk at a time.

    The entity-days are made in steps, each stored before the next: the days of each source, the days
    of all, their buckets.  A step's exchanges and what only it has read are removed when it is stored.
    Bad rows are counted by the pass that writes, so a table of ``SPENT`` is removed with the last
    table that is made from it.
    """

    #: Tables that are removed when another has been stored.
    SPENT = {"guest_milestones": "guest_metric_events"}
    #: Parts into which a split of a table is cut that the next step reads.
    PARTS_A_SPLIT = 4

    def __init__(self, *labels: str):
        self.labels = labels
        #: Folders by label.
        self.paths: dict[str, str] = {}

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        return self.watched(df, label, {})[0]

    def step(self, df: DataFrame, label: str, watch: Mapping[str, Column] | None = None) -> tuple[DataFrame, dict[str, int]]:
        """Store a table whatever its label, without its exchanges."""
        spark = df.sparkSession
        self.paths[label] = fresh_path(spark, label)
        with shuffles_removed(spark), smaller_splits(spark, self.PARTS_A_SPLIT):
            counts = write_table(df, self.paths[label], watch=watch)
        return spark.read.schema(df.schema).parquet(self.paths[label]), counts

    def source_days(self, df: DataFrame, label: str) -> DataFrame:
        return self.step(df, label)[0]

    def watched(self, df: DataFrame, label: str, watch: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
        """Store a table, if it is a named one, and count the rows that meet each predicate on the way."""
        if label not in self.labels:
            return df, {}
        before = [name for name in self.paths if name.startswith("days_")] if label == "guest_activity_daily" else []
        stored, counts = self.step(df, label, watch)
        self._remove(df, *before)
        if label == "guest_activity_daily":
            with shuffles_removed(df.sparkSession), smaller_splits(df.sparkSession, self.PARTS_A_SPLIT):
                stored = cut(stored, label, "player_id", ("player_id", "activity_date"))
            self._remove(df, label)
        if label in self.SPENT:
            self._remove(df, self.SPENT[label])
        return stored, counts

    def _remove(self, df: DataFrame, *labels: str) -> None:
        release(df.sparkSession, [self.paths.pop(label) for label in labels if label in self.paths])


# Tables read by several later ones or by consumers, and the schema each belongs to.
INTERMEDIATE = (
    "guest_activity_daily", "guest_cumulative_daily", "guest_visit_streaks", "guest_calendar_events",
    "guest_metric_events", "guest_rg_signals", "guest_comp_budget",
)
STAGED_WORKLIST = "daily_worklist_staged"
#: Columns of staged tables that must be there and unique.
STAGED_KEYS = {
    "player": ("player_id",), "member": ("member_id", "player_id"), "player_session": ("session_id",),
    "check": ("check_id",), "reservation": ("reservation_id",),
}
LAYERS = ("staged", "intermediate", "marts")
MARTS = ("guest_profile", "guest_360", "guest_milestones", "recommendations", "daily_worklist")


class Recognition:
    """The tables of one run as attributes, each built on first use.

    ``keep`` sees every table with its label and may store it; by default all stay lazy.
    ``activity`` stands in for the entity-days where they are already stored.  With ``balances`` of
    them, the day's recommendations read the days since a balance and not the history before.
    """

    def __init__(
        self,
        landed: Mapping[str, DataFrame],
        rules: DataFrame,
        guardrails: DataFrame,
        policy: Policy = Policy(),
        keep: Keep = lazily,
        activity: DataFrame | None = None,
        balances: BalanceBook | None = None,
    ):
        self.policy = policy
        self.as_of: dt.date = resolve_as_of(policy)
        self.rules = rules
        self.guardrails = guardrails
        self.staged = stage_all(landed, policy)
        self._keep = keep
        self._activity = activity
        self.balances = balances
        #: Labels that ``keep`` has stored, and bad rows it has counted in the pass that wrote them.
        self.stored: set[str] = set()
        self.counted: dict[str, dict[str, int]] = {}

    def _store(self, df: DataFrame, label: str) -> DataFrame:
        """Hand a table to ``keep``; one that can watch counts the table's bad rows as it writes."""
        watch = self.row_checks.get(label)
        if watch and hasattr(self._keep, "watched"):
            kept, self.counted[label] = self._keep.watched(df, label, watch)
        else:
            kept = self._keep(df, label)
        if kept is not df:
            self.stored.add(label)
        return kept

    # --- intermediate ------------------------------------------------------------

    @cached_property
    def _member_ids(self) -> DataFrame:
        return self.staged["member"].select("member_id", "player_id")

    @cached_property
    def activity(self) -> DataFrame:
        """One row per guest and business day, computed or as handed in."""
        if self._activity is not None:
            return self._activity
        step = getattr(self._keep, "source_days", None)
        return self._store(guest_activity(self.staged, self.policy, step), "guest_activity_daily")

    @cached_property
    def cumulative(self) -> DataFrame:
        totals = ED.running_totals(self.activity, self.policy.cumulative_metrics)
        return self._store(totals, "guest_cumulative_daily")

    @cached_property
    def streaks(self) -> DataFrame:
        return self._store(ED.month_streaks(self.activity, F.col("visit_flag") == 1), "guest_visit_streaks")

    @cached_property
    def calendar(self) -> DataFrame:
        """Birthdays come from the guests alone; anniversaries are cut to the window before
        they are matched to live guests."""
        guests, members = self.staged["player"], self.staged["member"]
        near = (self.as_of, self.policy.calendar_window_days)
        birthdays = EV.birthday_events(guests, *near)
        anniversaries = EV.membership_events(members, *near).join(guests.select("player_id"), "player_id", "left_semi")
        return self._store(EV.metric_events(birthdays, anniversaries), "guest_calendar_events")

    def _day_events(self, totals: DataFrame) -> DataFrame:
        """Running totals, streaks, comebacks and big wins: all from one pass over the guest's days.

        The gap of a comeback counts from any earlier active day.
        """
        col, day = F.col, F.col("activity_date")
        visited = col("visit_flag") == 1
        gap, streak = F.datediff(day, "prior_activity_date"), col("streak_months")
        history = ED.with_streaks(totals, visited)
        return EV.emit(history, col("player_id"), {
            **EV.cumulative_candidates(self.policy.cumulative_metrics, "activity_date"),
            "streak": (streak.isNotNull(), EV.event("consecutive_visit_months", day, streak, streak - 1)),
            "comeback": (
                visited & col("prior_activity_date").isNotNull(),
                EV.event("days_since_prior_visit", day, gap, F.lit(0)),
            ),
            "win": (
                col("jackpot_amount") > 0, EV.event("daily_jackpot_total", day, col("jackpot_amount"), F.lit(0))
            ),
        })

    def _tier_events(self) -> DataFrame:
        """Upgrades; equal moves of one member and day travel as one counted row, so a member with
        a third of the history enters the join as at most a few rows per day."""
        old, new = F.col("old_tier_id"), F.col("new_tier_id")
        moves = (
            self.staged["tier_history"].where(old.isNotNull() & (new > old))
            .groupBy("member_id", "change_date", "old_tier_id", "new_tier_id")
            .agg(F.count("*").alias("n"))
        )
        return (
            moves.join(self._member_ids, "member_id")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select(*EV.event_columns(F.col("player_id"), F.col("change_date"), "tier_level", new, old))
        )

    @cached_property
    def metric_events(self) -> DataFrame:
        """The one long table every milestone is looked up in."""
        return self._store(
            EV.metric_events(self._day_events(self.cumulative), self._tier_events(), self.calendar), "guest_metric_events"
        )

    def _near_events(self) -> DataFrame:
        """The metric events inside the widest rule window.

        An event of a day needs the guest's earlier days, but only of guests with a day inside the
        window.  They are found from a range of days, which reaches the scan, and the history is
        cut to them before any window runs; both sides share the buckets of the entity-days.
        """
        first, last = self._widest_window
        return self.events_between(first, last).where(F.col("event_date").between(F.lit(first), F.lit(last)))

    def _opened(self, first: dt.date) -> tuple[dt.date | None, DataFrame | None]:
        """The newest balance closed before a day, if there is one."""
        return (self.balances and self.balances.before(first)) or (None, None)

    def events_between(self, first: dt.date, last: dt.date | None = None) -> DataFrame:
        """All metric events of the days from ``first`` to ``last`` (others may come with them), from
        the days since the balance before ``first``."""
        opened, opening = self._opened(first)
        active = days_within(self.activity, "activity_date", first, last).select("player_id")
        history = days_after(self.activity, opened, last).join(active, "player_id", "left_semi")
        totals = ED.running_totals(history, self.policy.cumulative_metrics, opening=opening)
        return EV.metric_events(self._day_events(totals), self._tier_events(), self.calendar)

    @cached_property
    def rg_signals(self) -> DataFrame:
        signals = SG.baseline_anomaly(self.activity, self.as_of, self.policy)
        return self._store(signals, "guest_rg_signals")

    @cached_property
    def comp_budget(self) -> DataFrame:
        """Comps are summed per member before the member join, then over the guest's memberships."""
        spent = SG.trailing_budget(self.staged["comp"].where(F.col("member_id").isNotNull()), self.as_of, self.policy)
        per_guest = spent.join(self._member_ids, "member_id").groupBy("player_id").agg(
            F.sum("comps_cooldown_usd").alias("comps_cooldown_usd"),
            F.sum("comps_window_usd").alias("comps_window_usd"),
            F.max("last_comp_date").alias("last_comp_date"),
        )
        return self._store(per_guest, "guest_comp_budget")

    # --- marts --------------------------------------------------------------------

    @cached_property
    def profile(self) -> DataFrame:
        """Guest 360 and gaming signals side by side, as the recommendations need them."""
        opened, opening = self._opened(self.as_of - dt.timedelta(days=G.snapshot_reach(self.policy) - 1))
        days = days_after(self.activity, opened)
        profile = G.guest_profile(self.staged, days, self.as_of, self.policy, opening)
        return self._store(profile, "guest_profile")

    @cached_property
    def guest_360(self) -> DataFrame:
        return self._store(G.entity_360(self.profile), "guest_360")

    @cached_property
    def catalog(self) -> RU.Catalog | None:
        """The rules as an index, unless there are too many."""
        return RU.Catalog.of(self.rules)

    @cached_property
    def milestones(self) -> DataFrame:
        return self._store(RU.milestones(self.metric_events, self.rules, catalog=self.catalog), "guest_milestones")

    @cached_property
    def _widest_window(self) -> tuple[dt.date, dt.date]:
        """Earliest and latest event date any rule can still act on."""
        if self.catalog:
            back, ahead = self.catalog.widest
        else:
            back, ahead = (n or 0 for n in self.rules.agg(F.max("recognition_window_days"), F.max("lead_days")).first())
        return self.as_of - dt.timedelta(days=back), self.as_of + dt.timedelta(days=ahead)

    @cached_property
    def recommendations(self) -> DataFrame:
        """From the events of the widest rule window alone: a day's list does not go through the
        history of guests who did nothing in it.  Milestones that this run has stored are read by
        their day instead."""
        if "guest_milestones" in self.stored:
            near = days_within(self.milestones, "event_date", *self._widest_window)
        else:
            near = RU.milestones(self._near_events(), self.rules, catalog=self.catalog)
        recs = RE.recommendations(near, self.profile, self.comp_budget, self.guardrails, self.as_of, self.policy)
        return self._store(recs, "recommendations")

    @cached_property
    def listed(self) -> DataFrame:
        """The worklist before it is published: what the checks look at, and what is published then.
        Where tables are stored it is stored under a name of its own, so it is computed once."""
        return self._store(RE.worklist(self.recommendations, self.policy), STAGED_WORKLIST)

    @cached_property
    def worklist(self) -> DataFrame:
        return self._store(self.listed, "daily_worklist")

    # --- quality --------------------------------------------------------------------

    @cached_property
    def row_checks(self) -> dict[str, dict[str, Column]]:
        """By table, what makes a row bad on its own."""
        null = lambda *columns: {f"not_null({c})": F.col(c).isNull() for c in columns}
        return {
            **{name: null(*columns) for name, columns in STAGED_KEYS.items()},
            "rules": {
                **null("rule_id", "reward_budget_usd"),
                "accepted_values(reward_type)": Q.outside("reward_type", P.REWARD_TYPES),
                "accepted_values(metric_name)": Q.outside("metric_name", P.METRIC_NAMES),
            },
            "guardrails": null("tier_id"),
            "guest_activity_daily": null("player_id"),
            "guest_metric_events": null("metric_name"),
            "guest_rg_signals": null("player_id"),
            "guest_360": null("player_id", "is_eligible"),
            "guest_milestones": null("milestone_id"),
            "recommendations": {
                **null("recommendation_id"),
                "accepted_values(recommendation_status)": Q.outside("recommendation_status", P.STATUSES),
                "no_incentive_when_flagged": Q.incentive_while_flagged(),
                "reward_within_budget": Q.reward_over_budget(),
                "script_match": Q.wrong_script(self.policy.check_in_phrase),
            },
            STAGED_WORKLIST: null("recommendation_id", "player_id"),
        }

    def checks(self, layers: Collection[str] = LAYERS) -> list[Q.TableChecks]:
        """Column, key and business-rule checks of the run's layers, in the order they depend on each other."""

        def table(
            label: str, df: DataFrame, *unique: tuple[str, ...], name: str = "", refers: Mapping[str, Q.Refers] | None = None
        ) -> Q.TableChecks:
            return Q.TableChecks(
                name or label, df, self.row_checks[label], unique, refers=refers or {}, counted=self.counted.get(label, {})
            )

        out: list[Q.TableChecks] = []
        if "staged" in layers:
            out += [table(name, self.staged[name], *[(c,) for c in columns]) for name, columns in STAGED_KEYS.items()]
            out += [table("rules", self.rules, ("rule_id",)), table("guardrails", self.guardrails, ("tier_id",))]
        elif "marts" in layers:
            out.append(Q.TableChecks("rules", self.rules))  # only referred to
        if "intermediate" in layers:
            out += [
                table("guest_activity_daily", self.activity, ("player_id", "activity_date")),
                table("guest_metric_events", self.metric_events),
                table("guest_rg_signals", self.rg_signals, ("player_id",)),
            ]
        if "marts" in layers:
            barred = Q.Refers("player_id", "guest_360", "player_id", barred=True, where=~F.col("is_eligible"))
            out += [
                table("guest_360", self.guest_360, ("player_id",)),
                table("guest_milestones", self.milestones, ("milestone_id",), refers={
                    "relationships(rule_id)": Q.Refers("rule_id", "rules", "rule_id"),
                }),
                table("recommendations", self.recommendations, ("recommendation_id",)),
                table(STAGED_WORKLIST, self.listed, ("recommendation_id",), ("player_id",), ("property_id", "player_id"),
                      name="daily_worklist", refers={"excludes_ineligible": barred}),
            ]
        return out

    def check_report(self, layers: Collection[str] = LAYERS) -> DataFrame:
        return Q.run_checks(self.checks(layers))

    def violations(self, warn_only: Collection[str] = (), layers: Collection[str] = LAYERS) -> list[str]:
        """Checks that fail, as ``table.check: rows``; those in ``warn_only`` are left out.  The report
        has a row for each check, so the list is short whatever the data."""
        failed = self.check_report(layers).where(F.col("violations") > 0).collect()
        named = [(f"{r['table']}.{r['check']}", r["violations"]) for r in failed]
        return [f"{name}: {n}" for name, n in sorted(named) if name not in warn_only]


class TablesKept:
    """Stores every table in the catalog, one schema per layer, overwritten on each run.

    Tables with one guest per row, or a guest's days, are bucketed by guest: the entity-day exchange
    is paid once, and later windows, groupings and joins on the guest read their buckets in place.
    Those with a day lie in folders of months as well, so a range of days opens its months' files
    only.  The worklist has a folder for each property, the unit in which it is read.
    """

    DAYS = {
        "guest_activity_daily": "activity_date", "guest_cumulative_daily": "activity_date",
        "guest_metric_events": "event_date", "guest_milestones": "event_date",
    }

    def __init__(self, prefix: str = "accolade", buckets: int | None = None, root: str | None = None):
        self.prefix, self.buckets, self.root = prefix, buckets, root

    def schema_of(self, label: str) -> str:
        return f"{self.prefix}_{'recognition' if label in MARTS else 'intermediate'}"

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        return self.watched(df, label, {})[0]

    def watched(self, df: DataFrame, label: str, watch: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
        """Store a table and count the rows that meet each predicate on the way."""
        schema = self.schema_of(label)
        where = f" LOCATION '{self.root}/{schema}'" if self.root else ""
        df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")
        name, day = f"{schema}.{label}", self.DAYS.get(label)
        if label == "daily_worklist":
            return save_table(df, name, partition_by=("property_name",), watch=watch)
        if label == STAGED_WORKLIST:
            return save_table(df, name, watch=watch)
        sort = ["player_id"] + ([day] if day else [])
        return save_table(df, name, "player_id", sort, self.buckets, month_of=day, watch=watch)


def publish_staging(run: Recognition, prefix: str = "") -> None:
    """Register the staging views of a run in the session."""
    for name, df in run.staged.items():
        df.createOrReplaceTempView(f"{prefix}stg_{name}")


class ChecksFailed(Exception):
    """A build stopped before publishing its worklist; the message names the failed checks."""


def build(
    run: Recognition,
    only: Iterable[str] = ("worklist", "guest_360", "rg_signals", "streaks", "milestones"),
    warn_only: Collection[str] = (),
    freshness: DataFrame | None = None,
) -> None:
    """Build the named tables and all they depend on, through the run's ``keep``.

    Each layer is checked before the next is written: the landed tables' age (``freshness``, a
    ``freshness_report``) and the staged tables before anything, the intermediate tables before the
    marts, and everything the worklist is made of, itself included, before it is published.  A
    failed check stops the build there, and what was published before stays.  ``warn_only``
    names checks, as ``table.check``, that may fail; a source that is only late enough to warn passes.
    """
    names = list(only)

    def gate(layer: str) -> None:
        if failed := run.violations(warn_only, [layer]):
            raise ChecksFailed("; ".join(failed))

    if freshness is not None:
        stale = sorted(f"{r['source']}: newest row {r['newest']}" for r in freshness.where("status = 'error'").collect())
        if stale:
            raise ChecksFailed("; ".join(stale))
    gate("staged")
    if {"worklist", "guest_360", "milestones"} & set(names):
        gate("intermediate")
    for name in names:
        if name != "worklist":
            getattr(run, name)
    if "worklist" in names:
        gate("marts")
        run.worklist  # noqa: B018 - built on first use
