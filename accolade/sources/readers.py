"""Source scans: logical names, name-insensitive projection, soft deletes, seeds, freshness."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"

RULE_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("milestone_family", T.StringType()),
        T.StructField("milestone_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("lead_days", T.IntegerType()),
        T.StructField("recognition_window_days", T.IntegerType()),
        T.StructField("reward_type", T.StringType()),
        T.StructField("reward_budget_usd", T.DoubleType()),
        T.StructField("action_owner", T.StringType()),
        T.StructField("priority_weight", T.IntegerType()),
        T.StructField("recommended_action", T.StringType()),
        T.StructField("talking_point", T.StringType()),
        T.StructField("is_active", T.IntegerType()),
    ]
)

BUDGET_SCHEMA = T.StructType(
    [
        T.StructField("tier_id", T.IntegerType()),
        T.StructField("tier_name", T.StringType()),
        T.StructField("max_reward_usd_30d", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class FreshnessRule:
    """When the newest load of a system's tables is late; ``columns`` differ from ``loaded_at`` by table."""

    loaded_at: str
    warn_hours: float = 2
    error_hours: float = 24
    columns: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Registry:
    """Where logical tables live, and what is expected of their systems.

    ``freshness`` has a rule for each system that loads on a schedule; others are exempt.

    A table resolves to ``identifiers[name]`` (default: the name itself), placed under
    ``root`` for file formats, or under ``schemas[system]`` for ``fmt="table"``.
    """

    root: str = ""
    fmt: str = "parquet"
    suffix: str = ""
    identifiers: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)
    freshness: Mapping[str, FreshnessRule] = field(default_factory=dict)

    def locate(self, name: str, system: str | None = None) -> str:
        ident = self.identifiers.get(name, name)
        if self.fmt == "table":
            schema = self.schemas.get(system or "", self.root)
            return f"{schema}.`{ident}`" if schema else f"`{ident}`"
        base = self.schemas.get(system or "", self.root).rstrip("/")
        return f"{base}/{ident}{self.suffix}"


def read_source(spark: SparkSession, registry: Registry, name: str, system: str | None = None) -> DataFrame:
    """Scan one landed table by its logical name."""
    where = registry.locate(name, system)
    if registry.fmt == "table":
        return spark.table(where)
    return spark.read.format(registry.fmt).load(where)


class LazyTables(Mapping[str, DataFrame]):
    """Named tables, each planned once and only when asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def read_sources(spark: SparkSession, registry: Registry, systems: Mapping[str, str | None]) -> LazyTables:
    """All landed tables of a registry, given as logical name -> source system."""
    return LazyTables({n: lambda n=n, s=s: read_source(spark, registry, n, s) for n, s in systems.items()})


def _plain(name: str) -> str:
    return name.lower().replace("_", "")


def normalized(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Find each requested snake_case column whatever the landed case or underscores."""
    landed = {_plain(c): c for c in df.columns}
    missing = [c for c in columns if _plain(c) not in landed]
    if missing:
        raise ValueError(f"column(s) {', '.join(missing)} not found; columns present: {', '.join(df.columns)}")
    return [F.col(f"`{landed[_plain(c)]}`").alias(c) for c in columns]


def select_normalized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Allow-list projection: only the named columns survive, so scans prune the rest."""
    return df.select(*normalized(df, columns))


def flag_columns(df: DataFrame, flags: str | Sequence[str]) -> list[str]:
    """Columns that one of the flag names means: whatever their case or underscores, or as a
    pattern where the name has a ``*``."""
    names = [flags] if isinstance(flags, str) else flags
    plain, patterns = {_plain(f) for f in names if "*" not in f}, [f.lower() for f in names if "*" in f]
    return [c for c in df.columns if _plain(c) in plain or any(fnmatchcase(c.lower(), p) for p in patterns)]


def live_rows(df: DataFrame, flags: str | Sequence[str] = "_deleted", required: bool = False) -> DataFrame:
    """Drop rows that any of the soft-delete flags marks; a NULL flag counts as live.

    A table may land without a flag, unless its system declares that all its tables carry one
    (``required``).
    """
    found = flag_columns(df, flags)
    if required and not found:
        raise ValueError(f"no soft-delete flag found; columns present: {', '.join(df.columns)}")
    for c in found:
        df = df.where(~F.coalesce(F.col(f"`{c}`"), F.lit(False)))
    return df


def read_seed(spark: SparkSession, path: str | Path, schema: T.StructType) -> DataFrame:
    """Reference data in CSV (RFC 4180 quoting; lines starting with # are comments)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("comment", "#")
        .option("mode", "FAILFAST")
        .csv(str(path))
    )


def shipped_rows(name: str, schema: T.StructType) -> list[dict]:
    """Typed rows of a catalog that ships inside the package."""
    text = (SEED_DIR / name).read_text(encoding="utf-8").splitlines(keepends=True)
    casts = {"string": str, "double": float, "int": int}
    types = {f.name: casts[f.dataType.simpleString()] for f in schema}
    rows = csv.DictReader(line for line in text if not line.startswith("#"))
    return [{c: types[c](v) if v != "" else None for c, v in row.items()} for row in rows]


def shipped_seed(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A packaged catalog as a local relation: its size is known to the optimizer, and executors
    need no copy of the package's files."""
    return spark.createDataFrame(pa.Table.from_pylist(shipped_rows(name, schema))).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    )


def freshness(
    df: DataFrame, loaded_at: str, now: dt.datetime, warn_hours: float = 2, error_hours: float = 24
) -> DataFrame:
    """One row: newest load time, its age, and pass / warn / error."""
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9
    late = F.col("age_hours")
    status = (
        F.when(late.isNull() | (late > error_hours), "error").when(late > warn_hours, "warn").otherwise("pass")
    )
    return (
        df.agg(F.max(loaded_at).alias("newest"))
        .withColumn("age_hours", age)
        .withColumn("status", status)
    )


def freshness_report(
    spark: SparkSession, registry: Registry, systems: Mapping[str, str | None], now: dt.datetime
) -> DataFrame:
    """(source, newest, age_hours, status) of every table whose system has a freshness rule."""
    parts = []
    for name, system in systems.items():
        rule = registry.freshness.get(system or "")
        if rule is not None:
            column = rule.columns.get(name, rule.loaded_at)
            late = freshness(read_source(spark, registry, name, system), column, now, rule.warn_hours, rule.error_hours)
            parts.append(late.select(F.lit(name).alias("source"), "newest", "age_hours", "status"))
    if not parts:
        raise ValueError("no system of the registry has a freshness rule")
    return reduce(DataFrame.unionByName, parts)
