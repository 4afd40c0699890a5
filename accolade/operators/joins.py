"""Join helpers that decide by size, and that keep hot keys from filling one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(facts: DataFrame, key: str, share: float) -> list:
    """Key values that hold more than ``share`` of the rows.

    At most ``1 / share`` values can, so the list handed to the driver is bounded whatever
    the data.  Only the key column is read, and it is counted before the exchange.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    bar = counts.agg(F.sum("n") * share)
    return [r[0] for r in counts.where(F.col("n") > bar.scalar()).select(key).collect()]


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner", hot: Sequence = ()
) -> DataFrame:
    """Fact-to-lookup equi-join that survives a key holding a large share of the facts.

    ``hot`` names keys known to be hot (``hot_keys`` finds them, in a job of its own).  Their rows
    are joined by broadcast: ``lookup`` is unique per key, so that side has as many rows as
    there are hot keys.  All other facts take the normal exchange, whose skew Spark splits at run
    time.  ``how`` is ``inner`` or ``left``; in a left join, facts without a key match nothing and
    skip the exchange too.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    k = F.col(key)
    known = facts.where(k.isNotNull())
    if hot:
        is_hot = k.isin(list(hot))
        joined = known.where(~is_hot).join(lookup, key, how).unionByName(
            known.where(is_hot).join(F.broadcast(lookup.where(is_hot)), key, how)
        )
    else:
        joined = known.join(lookup, key, how)
    if how == "left":
        joined = joined.unionByName(facts.where(k.isNull()), allowMissingColumns=True)
    return joined
