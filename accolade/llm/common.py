"""Helpers that several operators of the subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

#: Rows of one Arrow batch.  A batch holds whole texts, so it is kept small; the setting stays
#: with the session, because Spark reads it when the returned DataFrame runs.
ARROW_ROWS = 256


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def over_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with state per task: ``make()`` runs once in each task."""

    def run(batches):
        step = make()
        for batch in batches:
            out = step(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)


def rank_within(
    df: DataFrame, group: Sequence[str], spread: Column, order: Sequence[Column], buckets: int,
    rank: str = "rank0", total: str | None = None, counted: DataFrame | None = None,
) -> DataFrame:
    """Rank (from 0) of each row in its group without bringing a group into one task.

    ``spread`` is a double in [0, 1) that never falls along ``order``; it cuts a group into
    ``buckets`` runs.  Rows are ranked inside a run, runs are offset by the counts of the runs
    before them, of which a group has at most ``buckets + 1``.  ``counted`` may give the same
    groups and spreads from a narrower scan for the counts.  ``total`` adds the group's size.
    """
    run = F.floor(spread * buckets).cast("int")
    cut = df.withColumn("run_", run)
    keys = [*group, "run_"]
    counts = (df if counted is None else counted).withColumn("run_", run).groupBy(*keys).agg(F.count(F.lit(1)).alias("in_run_"))
    every = Window.partitionBy(*group)
    before = every.orderBy("run_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        *[F.col(k).alias(f"{k}_k") for k in keys],
        (F.sum("in_run_").over(before) - F.col("in_run_")).alias("before_"),
        *([F.sum("in_run_").over(every).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        cut.join(offsets, [F.col(k).eqNullSafe(F.col(f"{k}_k")) for k in keys])
        .withColumn(rank, F.col("before_") + F.row_number().over(inside) - 1)
        .drop("before_", "run_", *[f"{k}_k" for k in keys])
    )
