"""Ranks under any order, by ranges of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from accolade.llm.common import shuffle_partitions
from accolade.sources.sinks import cut


def ranked_in_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str], label: str, rank: str = "rank_") -> DataFrame:
    """``df`` with each row's rank (from 0) in its group under ``order``.

    Ranges of (group, order) go to tasks and are written with their number, so a group may have any
    share of the rows: it lies in a run of ranges, and a range's ranks follow on from the counts of
    the group's ranges before it.  Rows equal in all these columns are spread by a number drawn
    for each; their ranks are interchangeable.
    """
    n = shuffle_partitions(df.sparkSession)
    keys = [*group, *order]
    spread = df.withColumn("spread_", F.rand(7))
    ranged = cut(
        spread.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in keys], "spread_").withColumn("range_", F.spark_partition_id()),
        label,
    )
    parts = ranged.withColumn("all_", F.lit(0))
    inside = [*(group or ["all_"]), "range_"]
    counts = parts.groupBy(*inside).agg(F.count(F.lit(1)).alias("in_range_"))
    before = Window.partitionBy(*inside[:-1]).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"{c}k_") for c in inside], F.coalesce(F.sum("in_range_").over(before), F.lit(0)).alias("before_"))
    within = Window.partitionBy(*inside).orderBy(*[F.col(c).asc_nulls_first() for c in order], "spread_")
    joined = parts.join(offsets, [F.col(c).eqNullSafe(F.col(f"{c}k_")) for c in inside])
    ranks = joined.withColumn(rank, F.col("before_") + F.row_number().over(within) - 1)
    return ranks.select(*df.columns, rank)
