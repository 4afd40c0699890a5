"""Table sinks and the shared-folder cut used between stages of a run."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Spark's setting that removes the shuffle files of an execution when it ends, and the one that bounds a split.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes inside leave no shuffle files behind.

    For tables that are read back from where they are written, so nothing asks for these files again.
    Left to itself, Spark removes them when the driver's garbage collection finds their plan, which on
    a large heap may be after the whole run: the exchanges of all tables would then be on disk together.
    """
    return _setting(spark, SHUFFLE_CLEANUP, "true")


def smaller_splits(spark: SparkSession, parts: int) -> AbstractContextManager[None]:
    """Writes inside read splits of a part of the usual size: a stored table has more rows to the
    byte than its wide sums, or the rows of its exchange, have room for in one task."""
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return _setting(spark, SPLIT_BYTES, str(max(1, most // parts)))


def _watching(df: DataFrame, watch: Mapping[str, Column] | None) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Rows that count those that meet each predicate as they are written, and the counts to ask for after that."""
    if not watch:
        return df, dict
    seen = Observation()
    rows = df.observe(seen, *[F.count_if(c).alias(f"watch_{i}") for i, c in enumerate(watch.values())])
    return rows, lambda: {check: seen.get.get(f"watch_{i}", 0) for i, check in enumerate(watch)}


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", watch: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Full overwrite of one table folder, optionally partitioned for pruned reads; returns the counts of
    ``watch``, as ``save_table`` does."""
    rows, counts = _watching(df, watch)
    writer = rows.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return counts()


#: Marks the row that stands for a partition whose rows have all gone.
GONE = "is_gone_marker"


def partition_days(spark: SparkSession, path: str, column: str) -> list[dt.date]:
    """Days that name the partition folders of a table, from the folder names alone."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root)]
    return sorted(dt.date.fromisoformat(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}="))


def replace_partitions(
    df: DataFrame, path: str, partition: Mapping[str, Column], since: dt.date | None = None, fresh: bool = False,
) -> None:
    """Write rows into folders of one day-valued expression, replacing the folders they fall in.

    Folders from ``since`` on that get no row are replaced too, by a marker that ``read_partitions``
    skips.  ``fresh`` replaces the whole table.  Spark sorts what a task holds by folder, and small
    partitions are joined before, so a folder gets few files.
    """
    ((column, value),) = partition.items()
    rows = df.withColumns({column: value, GONE: F.lit(False)})
    stored = [] if fresh else [d for d in partition_days(df.sparkSession, path, column) if since and d >= since]
    if stored:
        marks = df.sparkSession.createDataFrame([(d, True) for d in stored], f"{column} date, {GONE} boolean")
        rows = rows.unionByName(marks, allowMissingColumns=True)
    writer = rows.hint("rebalance", column).write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "static" if fresh else "dynamic").parquet(path)


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(~F.col(GONE)).drop(GONE)


def month_column(day: str) -> str:
    """Name of the column that holds the first day of a day's month, where a table has folders of months."""
    return f"{day}_month"


def save_table(
    df: DataFrame,
    name: str,
    bucket_by: str | None = None,
    sort_by: Sequence[str] = (),
    buckets: int | None = None,
    path: str | None = None,
    month_of: str | None = None,
    partition_by: Sequence[str] = (),
    watch: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Full overwrite of a catalog table; returns the stored table and the counts of ``watch``.

    With ``bucket_by``, rows are hash-partitioned by an entity key to the bucket count first, so later
    joins, groupings and windows on the key need no exchange.  With ``month_of``, a bucket is cut
    into folders by the month of that day as well: a range of days (``days_within``) then opens the
    files of its months only.  A task writes one file for each folder of its bucket.

    ``watch`` names predicates; the rows that meet them are counted by the pass that writes, below
    every exchange, so a task that runs again counts once.
    """
    spark = df.sparkSession
    folders = [*partition_by]
    rows = df
    if month_of:
        folders.append(month_column(month_of))
        rows = rows.withColumn(folders[-1], F.trunc(month_of, "MM"))
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:
        rows = rows.repartition(n, F.col(bucket_by))
    elif folders:
        rows = rows.hint("rebalance", *folders)
    rows, counts = _watching(rows, watch)
    writer = rows.write
    if folders:
        writer = writer.partitionBy(*folders)
    if bucket_by:
        writer = writer.bucketBy(n, bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    if path:
        writer = writer.option("path", path)
    writer.mode("overwrite").format("parquet").saveAsTable(name)
    stored = spark.table(name).select(*df.columns, *[c for c in folders if c not in df.columns])
    return stored, counts()


#: Folders that ``cut`` and its callers wrote in this process, oldest first.
_WRITTEN: list[str] = []
#: Holds the catalog entry of a bucketed cut while it is written; never the user's own schema.
SCRATCH_SCHEMA = "accolade_scratch"


#: Folder of each local application that named none.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session, or the checkpoint
    folder the caller set on its context.

    Only where neither is set and the master is local, as in tests, one folder of this machine
    is made for the application; a cluster session has to name its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="accolade-")
    return _LOCAL_FOLDERS[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder, which ``release`` removes."""
    path = f"{shared_folder(spark)}/accolade/{label}_{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cut(df: DataFrame, label: str, bucket_by: str | None = None, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends at a columnar table that survives lost executors, and each reader of it
    prunes to its own columns.  With ``bucket_by``, later groupings, windows and joins on
    that key need no exchange.  The files stay until ``release`` or the end of a ``scratch``
    block, since results may still be read from them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if not bucket_by:
        write_table(df, path)
        return spark.read.schema(df.schema).parquet(path)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {SCRATCH_SCHEMA}")
    name = f"{SCRATCH_SCHEMA}.{path.rpartition('/')[2]}"
    stored, _ = save_table(df, name, bucket_by, sort_by, path=path)
    spark.sql(f"DROP TABLE {name}")  # the plan holds files and buckets; the entry is not needed to read them
    return stored


def release(spark: SparkSession, paths: Sequence[str] | None = None) -> None:
    """Remove folders of cuts, by default all of this process; results that read them end with it."""
    for path in list(_WRITTEN if paths is None else paths):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was cut inside: for runs whose results are stored or collected there."""
    before = set(_WRITTEN)
    try:
        yield
    finally:
        release(spark, [p for p in _WRITTEN if p not in before])
