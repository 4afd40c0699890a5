"""Opening balances: what is continued from one equals what is computed from all days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from accolade.operators import entity_day as ED
from accolade.operators.balances import closing_balance, days_after
from accolade.plans import catalog
from accolade.plans.balance_book import BalanceBook, month_end
from accolade.plans.pipeline import Recognition, cutting
from accolade.plans.rolling import RollingMilestones
from accolade.sources import sample, sinks
from accolade.streaming.refresh import touched_days

METRICS = {"spend": "spend", "visits": "visit"}
VISITED = "visit = 1"


def random_days(spark, seed):
    """Guests with gaps, runs of months over every border, days without a visit, and negative amounts."""
    draw, out = random.Random(seed), []
    for guest in range(60):
        for day in sorted(draw.sample(range(420), draw.randrange(0, 60))):
            out.append((guest, dt.date(1999, 1, 1) + dt.timedelta(days=day), draw.randrange(-50, 100), draw.randrange(2)))
    return spark.createDataFrame(out, "player_id long, activity_date date, spend long, visit int")


def history(daily, opening=None):
    return ED.with_streaks(ED.running_totals(daily, METRICS, opening=opening), F.expr(VISITED))


@pytest.mark.parametrize("opened", [dt.date(1998, 12, 1), dt.date(1999, 1, 31), dt.date(1999, 6, 15), dt.date(1999, 12, 31), dt.date(2001, 1, 1)])
def test_windows_go_on_from_a_balance(spark, opened):
    daily = random_days(spark, 1)
    opening = closing_balance(daily, METRICS, F.expr(VISITED), opened)
    whole = days_after(history(daily), opened)
    assert rows(history(days_after(daily, opened), opening), *whole.columns) == rows(whole)


def test_a_balance_closed_from_the_one_before_equals_one_closed_from_all_days(spark):
    for seed in range(3):
        daily = random_days(spark, seed)
        stops = [dt.date(1999, 2, 28), dt.date(1999, 3, 1), dt.date(1999, 7, 15), dt.date(2000, 1, 31)]
        opened, opening = None, None
        for stop in stops:
            opening = closing_balance(daily, METRICS, F.expr(VISITED), stop, opening, opened)
            opened = stop
            assert rows(opening) == rows(closing_balance(daily, METRICS, F.expr(VISITED), stop).select(*opening.columns))


def test_month_ends():
    assert month_end(dt.date(2000, 3, 15)) == dt.date(2000, 2, 29)
    assert month_end(dt.date(2000, 3, 15), 3) == dt.date(1999, 12, 31)
    assert month_end(dt.date(2000, 3, 31), 14) == dt.date(1999, 1, 31)


def book_of(spark, run, days):
    book = BalanceBook(spark, sinks.fresh_path(spark, "balances"))
    book.close(run.activity, days, run.policy)
    return book


def test_void_balances_fall_back(spark):
    run = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
    ends = [month_end(run.as_of, n) for n in (1, 2, 14)]
    book = book_of(spark, run, ends)
    assert book.closed() == sorted(ends)
    assert book.before(run.as_of)[0] == ends[0] and book.before(ends[0])[0] == ends[1] and book.before(ends[2]) is None
    assert book.void([]) == [] and book.void([ends[0] + dt.timedelta(days=1)]) == []
    assert book.void([ends[1], run.as_of]) == [ends[1], ends[0]]
    assert book.closed() == [ends[2]]


def test_an_unfinished_balance_is_not_seen(spark):
    run = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
    book = book_of(spark, run, [month_end(run.as_of, 2)])
    spark.range(1).write.parquet(f"{book.path}/through=2000-02-29")
    sinks.release(spark, [f"{book.path}/through=2000-02-29/_SUCCESS"])
    assert book.closed() == [month_end(run.as_of, 2)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_daily_list_reads_the_days_since_the_balance(spark):
    """Every scan of the entity-days is cut to days after a balance, and the rows are those of the full run."""
    run = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
    balanced = catalog.recognition_run(spark, SMALL)
    balanced._activity = run.activity
    near, old = month_end(run.as_of, 2), month_end(run.as_of, 14)
    balanced.balances = book_of(spark, run, [old, near])
    recs = balanced.recommendations
    assert rows(recs) == rows(run.recommendations.select(*recs.columns))
    scans = [line for line in plan(recs).splitlines() if "FileScan" in line and "theo_win" in line and "activity_date" in line and "through=" not in line]
    assert scans and all(f"GreaterThanOrEqual(activity_date,{d + dt.timedelta(days=1)})" in line for line in scans for d in [near if str(near + dt.timedelta(days=1)) in line else old])


def late_sessions(spark, first):
    landed = sample.landed_tables(spark, SMALL)
    late = (F.col("SessionID") % 3 == 0) & (F.col("GamingDate") >= F.lit(first)) & (F.col("GamingDate") < F.lit(first + dt.timedelta(days=40)))
    return landed, late


@pytest.mark.parametrize("back", [25, 700])
def test_refresh_equals_a_rebuild(spark, back):
    """Sessions that land late, before or after the balances, and as many that are deleted again."""
    whole = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
    landed, late = late_sessions(spark, whole.as_of - dt.timedelta(days=back))
    sessions = landed["player_session"]
    fewer = Recognition({**landed, "player_session": sessions.where(~late)}, whole.rules, whole.guardrails, whole.policy, cutting("guest_activity_daily"))
    stored = RollingMilestones(sinks.fresh_path(spark, "milestones"), BalanceBook(spark, sinks.fresh_path(spark, "balances")))
    stored.build(fewer)
    assert rows(stored.milestones(), *fewer.milestones.columns) == rows(fewer.milestones)
    days = touched_days(sessions.where(late), "player_session", whole.policy)
    assert days
    for run in (whole, fewer):
        run.balances = stored.book
        first = stored.refresh(run, days, run.as_of)
        assert first <= min(days) and first.day == 1
        assert rows(stored.milestones(), *run.milestones.columns) == rows(run.milestones)


def test_refresh_leaves_earlier_months_alone(spark):
    whole = catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"))
    stored = RollingMilestones(sinks.fresh_path(spark, "milestones"), BalanceBook(spark, sinks.fresh_path(spark, "balances")))
    stored.build(whole)
    before = set(spark.read.parquet(stored.path).inputFiles())
    whole.balances = stored.book
    first = stored.refresh(whole, [whole.as_of], whole.as_of)
    after = set(spark.read.parquet(stored.path).inputFiles())
    month = lambda f: dt.date.fromisoformat(f.split("event_month=")[1][:10])
    assert {f for f in before if month(f) < first} == {f for f in after if month(f) < first}
    assert not {f for f in before if month(f) >= first} & after


def test_the_next_day_needs_no_history(spark):
    """The as-of day moves on: birthdays leave and enter the window."""
    day = catalog.AS_OF
    run = lambda d: catalog.recognition_run(spark, SMALL, cutting("guest_activity_daily"), catalog.Policy(as_of_date=d))
    first, later = run(day), run(day + dt.timedelta(days=9))
    stored = RollingMilestones(sinks.fresh_path(spark, "milestones"), BalanceBook(spark, sinks.fresh_path(spark, "balances")))
    stored.build(first)
    later.balances = stored.book
    stored.refresh(later, [], first.as_of)
    assert rows(stored.milestones(), *later.milestones.columns) == rows(later.milestones)
