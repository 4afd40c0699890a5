"""Values that change over time: what held on a day, and what held on each row's own day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accolade.operators.windows import moment_order


def value_on(changes: DataFrame, key: str, day: str, tie_break: str, old: str, new: str, on: dt.date, into: str) -> DataFrame:
    """Per key the value that held at the end of the day ``on``, from rows (key, day, old, new).

    The last change up to the day says what it changed to; where all changes are later, the first
    of them says what it changed from.  One grouping of packed orders, a hash aggregate: a key with
    a third of the changes is one row per split.  Of several changes on one day the largest
    ``tie_break`` is the last.
    """
    when, order = F.col(day), moment_order(changes, day, tie_break)
    before = F.max_by(new, F.when(when <= F.lit(on), order))
    after = F.min_by(old, F.when(when > F.lit(on), order))
    dated = changes.where(when.isNotNull())
    return dated.groupBy(key).agg(before.alias("before_"), after.alias("after_"), F.bool_or(when <= F.lit(on)).alias("any_")).select(
        key, F.when(F.col("any_"), F.col("before_")).otherwise(F.col("after_")).alias(into)
    )


def intervals(changes: DataFrame, key: str, day: str, tie_break: str, old: str, new: str, into: str) -> DataFrame:
    """(key, valid_from, valid_to, into): the stretches of days ``[from, to)`` between changes.

    The first stretch has no beginning and the last no end.  The window's groups are the changes of
    a key after those of one day have been reduced to the last one, so the calendar bounds them.
    """
    order = moment_order(changes, day, tie_break)
    daily = changes.where(F.col(day).isNotNull()).groupBy(key, day).agg(F.max_by(new, order).alias("new_"), F.min_by(old, order).alias("old_"))
    by_day = Window.partitionBy(key).orderBy(day)
    later = daily.select(key, F.col(day).alias("valid_from"), F.lead(day).over(by_day).alias("valid_to"), F.col("new_").alias(into))
    first = daily.groupBy(key).agg(F.min(day).alias("valid_to"), F.min_by("old_", day).alias(into))
    return later.unionByName(first.select(key, F.lit(None).cast("date").alias("valid_from"), "valid_to", into))


def as_of_join(facts: DataFrame, key: str, day: str, stretches: DataFrame, into: str) -> DataFrame:
    """Facts with the value that held for their key on their own day; NULL where none is known.

    An equi-join on the key with the stretch as residual condition: a fact meets its key's stretches
    only, of which one holds, so the join puts out one row for each fact, and Spark splits hot keys.
    Facts without a key or a day match nothing and skip the exchange.
    """
    known = F.col(key).isNotNull() & F.col(day).isNotNull()
    held = stretches.select(F.col(key).alias("key_"), "valid_from", "valid_to", into)
    inside = (
        (F.col(key) == F.col("key_"))
        & (F.col("valid_from").isNull() | (F.col(day) >= F.col("valid_from")))
        & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    )
    matched = facts.where(known).join(held, inside, "left").drop("key_", "valid_from", "valid_to")
    return matched.unionByName(facts.where(~known), allowMissingColumns=True)
