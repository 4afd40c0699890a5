"""Trailing windows, favourites, latest rows, best rows and ranked top-N."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accolade.functions.dates import days_ago
from accolade.sources.sinks import month_column


def within_trailing(day: Column, as_of: dt.date, days: int, lag_days: int = 0) -> Column:
    """``day`` in the half-open window ``(as_of - days, as_of - lag_days]``.

    Both ends are literals, so the comparison is pushed to the scan.
    """
    return (day > days_ago(as_of, days)) & (day <= days_ago(as_of, lag_days))


def days_within(df: DataFrame, day: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, either end open if None.

    Days are compared with literals, which reach the scan; where the table has folders of months,
    these are cut too, so that no file of another month is opened.
    """
    month = month_column(day)
    for bound, cut in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            df = df.where(cut(F.col(day), F.lit(bound)))
            if month in df.columns:
                df = df.where(cut(F.col(month), F.lit(bound.replace(day=1))))
    return df


def trailing_agg(
    df: DataFrame,
    key: str | Sequence[str],
    day: str,
    as_of: dt.date,
    days: int,
    aggs: Mapping[str, Column],
    lag_days: int = 0,
) -> DataFrame:
    """Aggregates per entity over one trailing window."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        days_within(df, day, as_of - dt.timedelta(days=days - 1), as_of - dt.timedelta(days=lag_days))
        .groupBy(*keys)
        .agg(*[expr.alias(name) for name, expr in aggs.items()])
    )


#: Places of a decimal that a code or an id takes in a packed order, and the weight that NULL counts as.
CODE_SPACE, ID_SPACE, NO_WEIGHT = 10**9, 2**64, -(10**28)


def _whole(weight: Column, kind: T.DataType) -> Column:
    """A weight as an integer of the same order."""
    if isinstance(kind, T.DecimalType):
        return (weight * F.lit(10**kind.scale)).cast("decimal(38,0)")
    if isinstance(kind, T.IntegralType):
        return weight.cast("decimal(38,0)")
    raise ValueError(f"an order is packed from integers and decimals, not from {kind.simpleString()}")


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def value_codes(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """The distinct values with a code in their order, NULL last.  For columns of few values, such as
    the names of a dimension: the distinct ones are numbered as a whole."""
    order = [F.col(v).asc_nulls_last() for v in values]
    return rows.select(*values).distinct().withColumn("code", F.row_number().over(Window.orderBy(*order)))


def favorite_code(weights: DataFrame, key: str, code: str, weight: str) -> DataFrame:
    """Per key the code with the largest weight, the smaller code of equal ones; NULL weighs least.

    Weight and code are packed into one number, so this is a hash aggregate that combines before
    the exchange.
    """
    whole = F.coalesce(_whole(F.col(weight), weights.schema[weight].dataType), _number(NO_WEIGHT))
    packed = whole * F.lit(CODE_SPACE) + (F.lit(CODE_SPACE - 1) - F.col(code)).cast("decimal(10,0)")
    return weights.groupBy(key).agg(F.max_by(code, packed.cast("decimal(38,0)")).alias(code))


def favorite(weights: DataFrame, key: str, values: Sequence[str], weight: str, codes: DataFrame | None = None) -> DataFrame:
    """Per key the value columns with the largest weight; ties go to the first value.

    ``weights`` holds one row per key and value.  Values travel as codes and are looked up at the end.
    """
    codes = value_codes(weights, values) if codes is None else codes
    coded = codes.select("code", *[F.col(v).alias(f"{v}_c") for v in values])
    same = [F.col(v).eqNullSafe(F.col(f"{v}_c")) for v in values]
    best = favorite_code(weights.join(coded, same).select(key, "code", weight), key, "code", weight)
    return best.join(codes, "code").select(key, *values)


def moment_order(df: DataFrame, at: str, tie_break: str) -> Column:
    """A date or time and an id packed into one number of their order; NULL comes first."""
    moment = F.unix_date(at) if isinstance(df.schema[at].dataType, T.DateType) else F.unix_micros(F.col(at).cast("timestamp"))
    first = F.coalesce(moment.cast("decimal(19,0)"), F.lit(-(2**61)).cast("decimal(19,0)"))
    second = F.coalesce(F.col(tie_break).cast("decimal(19,0)"), F.lit(-(2**63)).cast("decimal(19,0)"))
    return (first * _number(ID_SPACE).cast("decimal(20,0)") + second).cast("decimal(38,0)")


def latest_value(df: DataFrame, key: str, at: str, tie_break: str, value: str) -> DataFrame:
    """Per key ``value`` of the row with the latest ``at``, the largest ``tie_break`` of equal ones.

    Both are packed into one number and the value is of fixed width, so this is a hash aggregate; a
    hot key costs one row per split.
    """
    return df.groupBy(key).agg(F.max_by(value, moment_order(df, at, tie_break)).alias(value))


def latest_per_key(
    df: DataFrame, key: str, day: str, as_of: dt.date | None = None, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Per key the row with the latest ``day`` (not after ``as_of``); NULL sorts first.

    The row without a later one, by a window over (key, day): rows that were made by such a window,
    as running totals are, need neither an exchange nor a sort for it.  A key's rows are its
    days, so the calendar bounds each window group.
    """
    rows = df if as_of is None else df.where(F.col(day) <= F.lit(as_of))
    later = F.lead(F.lit(True)).over(Window.partitionBy(key).orderBy(day, *tie_break))
    return rows.withColumn("_later", later).where(F.col("_later").isNull()).drop("_later")


def latest_in_interval(
    df: DataFrame, key: str, start: str, end: str, as_of: dt.date, tie_break: str, value: str | None = None
) -> DataFrame:
    """Per key the latest-starting row whose ``[start, end)`` contains ``as_of``; of a row, only
    ``value`` if that is given.  Whole rows are fetched by their id, ``tie_break``."""
    present = df.where(F.col(key).isNotNull() & (F.col(start) <= F.lit(as_of)) & (F.col(end) > F.lit(as_of)))
    best = latest_value(present, key, start, tie_break, value or tie_break)
    return best if value else present.join(best, [key, tie_break], "left_semi")


def rank_within(df: DataFrame, partition: str | Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    keys = [partition] if isinstance(partition, str) else list(partition)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_n(
    df: DataFrame, partition: str, order: Sequence[Column], n: int, rank: str, salt_by: str, salts: int = 256
) -> DataFrame:
    """The first ``n`` rows per partition under a total order, with their rank.

    Spark prunes each input split to ``n`` rows per partition before the exchange as long as
    ``n`` is within its group-limit threshold.  Beyond it, rows are first ranked within
    salts, so no task receives a whole hot partition.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
        df = rank_within(salted, [partition, "_salt"], order, "_r").where(F.col("_r") <= n).drop("_salt", "_r")
    return rank_within(df, partition, order, rank).where(F.col(rank) <= n)


def best_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Per key the first row under ``order``."""
    return rank_within(df, key, order, "_rank").where(F.col("_rank") == 1).drop("_rank")


def fold_rest(df: DataFrame, key: str, order: Sequence[Column], text: str, into: str) -> DataFrame:
    """Per key the first row under ``order``, with ``text`` of the other rows joined in that order.

    One window gives both: the rank, and the texts of the key in order, gathered once for each key.
    ``into`` is NULL where there are no other rows.
    """
    ordered = Window.partitionBy(key).orderBy(*order)
    texts = F.collect_list(F.struct(text)).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rest = F.array_compact(F.transform(F.slice("_texts", 2, F.size("_texts")), lambda t: t[text]))
    return (
        df.withColumns({"_rank": F.row_number().over(ordered), "_texts": texts})
        .where(F.col("_rank") == 1)
        .withColumn(into, F.when(F.size(rest) > 0, F.array_join(rest, ", ")))
        .drop("_rank", "_texts")
    )
