"""Stored opening balances, one folder for each day they were closed on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accolade.operators.balances import closing_balance
from accolade.policy import Policy

PREFIX = "through="


def month_end(day: dt.date, months_back: int = 1) -> dt.date:
    """Last day of the month ``months_back`` months before that of ``day``."""
    months = day.year * 12 + day.month - 1 - (months_back - 1)
    return dt.date(months // 12, months % 12 + 1, 1) - dt.timedelta(days=1)


class BalanceBook:
    """Balances of the entity-days, closed on days of the caller's choice.

    Closing a day reads the entity-days since the newest balance before it.  A change of a day on or
    before a balance makes that balance void: ``void`` removes it, and readers fall back to the
    one before the change, or to the whole history.  A balance is complete when Spark has
    marked its folder, so one whose writer was lost is not seen.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _folder(self, day: dt.date) -> str:
        return f"{self.path}/{PREFIX}{day.isoformat()}"

    def closed(self) -> list[dt.date]:
        """Days with a complete balance, oldest first; read from folder names alone."""
        if not self._files.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._root)]
        days = [dt.date.fromisoformat(n.removeprefix(PREFIX)) for n in names if n.startswith(PREFIX)]
        done = lambda d: self._files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(d)}/_SUCCESS"))
        return sorted(d for d in days if done(d))

    def before(self, day: dt.date) -> tuple[dt.date, DataFrame] | None:
        """The newest balance closed before ``day``, with the day it was closed on."""
        earlier = [d for d in self.closed() if d < day]
        return (earlier[-1], self.spark.read.parquet(self._folder(earlier[-1]))) if earlier else None

    def close(self, activity: DataFrame, through: Iterable[dt.date], policy: Policy) -> None:
        """Store a balance at the end of each of the given days, each from the one before it.

        Rows lie in ranges of the guest, so that a balance joined to few guests prunes."""
        for day in sorted(set(through)):
            opened, opening = self.before(day) or (None, None)
            balance = closing_balance(activity, policy.cumulative_metrics, F.col("visit_flag") == 1, day, opening, opened)
            balance.repartitionByRange("player_id").sortWithinPartitions("player_id").write.mode("overwrite").parquet(self._folder(day))

    def void(self, changed: Iterable[dt.date]) -> list[dt.date]:
        """Remove the balances that hold any of the changed days; returns their days."""
        days = list(changed)
        gone = [d for d in self.closed() if days and d >= min(days)]
        for d in gone:
            self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(d)), True)
        return gone
