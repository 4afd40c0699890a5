"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled by a seeded hash within their source and ranked; the row of rank r (from 0)
among n gets the place (r + phase) / n, the phase being a seeded number in [0, 1) of the source.
All rows are ordered by place and cut into equal runs.  Any stretch of places holds its exact
part of each source to within one row, so a shard differs from the mixture by that and by the
few rows by which its cuts are moved to make shards equal.

Both rankings are dealt out by cuts of the value they order by (``rank_within``), so a source
with a third of the rows, or a million sources of one row, is spread over all tasks.  Texts are
reduced to their size and checksum in the scan.

Defined results: a null text has size 1 and the checksum of no bytes; null sources are a source
of their own, apart from the empty name; null and repeated keys are ordered by size, then
checksum; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade.llm.common import rank_within, shuffle_partitions

SEED = "2026"
#: 60 bits of a digest, so that SQL engines without 64-bit unsigned arithmetic agree.
DIGITS, RANGE = 15, float(2**60)


def seeded(seed: str, value: Column) -> Column:
    """A shuffled 60-bit number of a value; null counts as the empty text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")


def interleave(
    df: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", stratum: str = "source", seed: str = SEED
) -> DataFrame:
    """Shard and slot of each row: (key, size, text_crc32, shard, slot).

    Shard sizes in rows differ by one at most; slots count from 0 without gaps.
    """
    buckets = shuffle_partitions(df.sparkSession) * 4
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.lit(0).alias("all_"), F.col(key).alias("key_"),
        F.when(F.col(stratum).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(stratum).cast("string"))).alias("stratum_"),
        seeded(seed, F.col(key)).alias("h_"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )

    def placed(order: list[str]) -> DataFrame:
        spread = F.col("h_").cast("double") / RANGE
        shuffled = rank_within(rows, ["stratum_"], spread, [F.col(c) for c in order], buckets, "rank_", "of_")
        phase = seeded(seed, F.col("stratum_")).cast("double") / RANGE
        return shuffled.withColumn("place_", (F.col("rank_").cast("double") + phase) / F.col("of_").cast("double"))

    # Which of several equal keys comes first changes no place, so the counts need no text.
    order = [F.col(c) for c in ("place_", "stratum_", "rank_")]
    run = rank_within(
        placed(["h_", "key_", "size", "text_crc32"]), ["all_"], F.col("place_"), order, buckets, "pos_", "rows_",
        counted=placed(["h_"]),
    )
    shard = F.expr(f"(pos_ * {shards}) div rows_")
    first = F.expr(f"(shard_ * rows_ + {shards - 1}) div {shards}")
    return run.withColumn("shard_", shard).select(
        F.col("key_").alias(key), "size", "text_crc32", F.col("shard_").cast("int").alias("shard"),
        (F.col("pos_") - first).alias("slot"),
    )
