"""Milestone history kept up to date from balances: work follows the change, not the history.

The milestones lie in one folder for each month of their event, beside a book of balances.  A
refresh takes the days whose entity-days changed, voids the balances that hold any, and computes
the months from the first changed one on, starting from the newest balance that still stands.
Earlier months are neither read nor written.  Birthdays and anniversaries depend on the as-of day
as well: months that the calendar window of the run or of the one before it reaches are computed
again too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.operators import rules as RU
from accolade.plans.balance_book import BalanceBook, month_end
from accolade.plans.pipeline import Recognition
from accolade.sources.sinks import read_partitions, replace_partitions

MONTH = "event_month"
#: Month ends to hold balances of, counted back from the as-of day: one inside which the daily list
#: falls, one before what the calendar window reaches, and one older than every look-back of the guest 360.
MONTHS_BACK = (1, 3, 14)


class RollingMilestones:
    """The stored history of a run's milestones under ``path``."""

    def __init__(self, path: str, book: BalanceBook, months_back: Sequence[int] = MONTHS_BACK):
        self.path, self.book, self.months_back = path, book, months_back

    def _close(self, run: Recognition) -> None:
        wanted = {month_end(run.as_of, n) for n in self.months_back}
        missing = wanted - set(self.book.closed())
        self.book.close(run.activity, missing, run.policy)

    def build(self, run: Recognition) -> None:
        """All months from all days, and the balances."""
        replace_partitions(run.milestones, self.path, {MONTH: F.trunc("event_date", "MM")}, fresh=True)
        self._close(run)

    def refresh(self, run: Recognition, changed: Sequence[dt.date], as_of_before: dt.date) -> dt.date:
        """Compute again what the changed days reach; returns the first day computed.

        Run again after a failure it gives the same rows: it reads the entity-days and the balances
        before the change only, and replaces whole months.
        """
        self.book.void(changed)
        reach = dt.timedelta(days=run.policy.calendar_window_days)
        first = min([*changed, as_of_before - reach, run.as_of - reach]).replace(day=1)
        events = run.events_between(first).where(F.col("event_date") >= F.lit(first))
        rows = RU.milestones(events, run.rules, catalog=run.catalog)
        replace_partitions(rows, self.path, {MONTH: F.trunc("event_date", "MM")}, since=first)
        self._close(run)
        return first

    def milestones(self) -> DataFrame:
        return read_partitions(self.book.spark, self.path).drop(MONTH)
