"""What the two vector searches share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NO_ID = np.iinfo(np.int64).max  # stands for a null id: after all others


def finite(vector: str) -> Column:
    """Whether a vector has components, all of them finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd


def numbered(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, id, vec): usable vectors with a number of their own, as ids may repeat.

    The number is that of the row in its scan, the same each time the table is scanned.
    """
    every = rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"))
    return every.where(finite("vec"))


def is_query(every_nth: int) -> Column:
    return F.coalesce(F.col("id") % every_nth == 0, F.lit(False))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def first_k(found: DataFrame, k: int, score: str) -> DataFrame:
    """(query_id, rank, vec_id, score) from partial lists (q_row, query_id, vec_id, score)."""
    order = Window.partitionBy("q_row").orderBy(F.col(score).desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", score)
