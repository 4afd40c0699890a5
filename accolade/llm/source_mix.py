"""Mixing sources to target weights by fitting word budgets with whole documents.

Every source has a target number of words.  The mix takes each of its documents ``target div
size of the source`` times; the rest of the target is a budget below the source's size, which a
subset of its documents has to fill.  Documents of one length are alike for that, so the subset
is sought over counts by exact length: an even share of every length first, for all of the budget
but the knapsack's ``WINDOW``, then the longest that still fit there, and the last stretch by a bounded-knapsack dynamic programme over the lengths
that are left, which comes as close as they can, from either side.  The chosen number of each length goes to the documents of that length with the
smallest seeded hashes.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the words of
all.  No target exceeds three times its source's size; what is above goes to the others by
weight, round after round until none is above.

In Spark: the scan reduces a text to its length.  Lengths are counted per source before any
exchange, and a source's fitting task receives one row for each distinct length, of which n
stand for n * n / 2 words at least.  The knapsack's table has ``4 * WINDOW`` sums at most: the
longest-first pass leaves the budget to it as soon as it is near ``WINDOW``, or when no remaining
length fits twice.  Documents are ranked within a length in cuts of their hash, so one length, or
one source, may have any share of the rows.  The driver sees three sums for each round of targets.

Defined results: a null text has size 0, and documents of size 0 are never taken; repeated rows
are documents of their own; null sources are one source, apart from the empty name; null ids
are ordered like any other; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade.llm.common import rank_within, shuffle_partitions
from accolade.llm.interleave_shards import RANGE, seeded
from accolade.llm.ranges import ranked_in_ranges
from accolade.sources.sinks import cut

WEIGHTS, MOST_TIMES, SEED = (5, 2, 1), 3, "mix"
#: Words that the longest-first pass leaves to the knapsack, whose table is bounded by four times that.
WINDOW = 1 << 16
WORD = r"[^ \t-\r]+"


def knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> dict[int, int]:
    """How many of each length come closest to the budget, the smaller sum if two are as close.

    Sums up to twice the budget are bits of one integer.  A length's copies are offered in powers
    of two; what an offer newly reaches is kept as a step back.  An exact fit ends the search.
    """
    reach, every, back = 1, (1 << (2 * budget + 1)) - 1, []
    for length, copies in sorted(zip(lengths.tolist(), left.tolist(), strict=True), reverse=True):
        copies, power = min(copies, 2 * budget // length), 1
        while copies and not reach >> budget & 1:
            take = min(power, copies)
            more = (reach << (take * length)) & every
            if more & ~reach:
                back.append((length, take, reach))
                reach |= more
            copies, power = copies - take, power * 2
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    over = budget + (above & -above).bit_length() if above else None
    at, taken = below if over is None or budget - below <= over - budget else over, {}
    for length, take, before in reversed(back):
        if not before >> at & 1:
            at -= take * length
            taken[length] = taken.get(length, 0) + take
    return taken


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length fill a budget below the sum of all, as an array."""
    total = int((lengths * counts).sum())
    even = max(0, budget - window)
    taken = np.array([int(c) * even // max(total, 1) for c in counts.tolist()], dtype=np.int64)
    rest = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        length, room = int(lengths[i]), int(counts[i] - taken[i])
        more = min(room, max(0, rest - window) // length)
        taken[i] += more
        rest -= more * length
    open_ = (counts > taken) & (lengths <= 2 * rest)
    if open_.any() and int(lengths[open_].min()) > window:  # no two fit together: the one that comes closest
        nearest = min(lengths[open_].tolist(), key=lambda length: (abs(rest - length), length))
        chosen = {nearest: 1} if abs(rest - nearest) < rest else {}
    else:
        chosen = knapsack(lengths[open_], (counts - taken)[open_], rest)
    for length, more in chosen.items():
        taken[np.flatnonzero(lengths == length)[0]] += more
    return taken


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Sources (stratum_, source_size) with their target.

    Each round hands what the capped sources leave to the others; it ends when it caps no more.
    """
    weighed = ranked_in_ranges(sources, [], ["stratum_"], "sources", rank="at_").withColumn(
        "weight_", F.element_at(F.array(*map(F.lit, weights)), (F.col("at_") % len(weights) + 1).cast("int"))
    )
    cap = F.col("source_size") * most_times
    level, known = None, -1
    while True:
        over = F.lit(False) if level is None else cap < F.col("weight_") * level
        row = weighed.agg(
            F.sum("source_size"), F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight_"))),
            F.count_if(over),
        ).first()
        words, capped, weight, n = (v or 0 for v in row)
        if n == known or not weight:
            break
        known, share = n, (words - capped, weight)
        level = share[0] / share[1]
    if level is None:
        return weighed.withColumn("target", F.lit(0.0))
    free = F.col("weight_") * F.lit(float(share[0])) / F.lit(float(share[1]))
    return weighed.withColumn("target", F.least(cap.cast("double"), free))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES, seed: str = SEED, window: int = WINDOW,
) -> DataFrame:
    """(key, source, size, source_size, target, taken) of each row: ``taken`` counts repeats."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), body)), 1, 15), 16, 10)
    rows = cut(docs.select(
        F.col(key).alias("key_"), stratum_name(F.col(stratum)).alias("stratum_"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"), digest.cast("long").alias("h_"),
    ), "sizes")
    counts = cut(rows.where("size > 0").groupBy("stratum_", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sources = rows.groupBy("stratum_").agg(F.sum("size").alias("source_size"))
    aimed = cut(targets(sources, weights, most_times).select("stratum_", "source_size", "target"), "targets")

    def choose(name, pdf):
        pdf = pdf.sort_values("size")
        lengths, number = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        whole, aim = int(pdf["source_size"].iloc[0]), int(round(pdf["target"].iloc[0]))
        some = fit(lengths, number, aim - aim // whole * whole, window)
        return pd.DataFrame({"stratum_": name[0], "size": lengths, "times_": aim // whole, "some_": some})

    chosen = counts.join(aimed, "stratum_").groupBy("stratum_").applyInPandas(
        choose, "stratum_ string, size long, times_ long, some_ long"
    )
    plan = cut(chosen, "chosen")
    spread = F.col("h_").cast("double") / RANGE
    order = [F.col("h_"), F.col("key_")]
    ranked = rank_within(rows, ["stratum_", "size"], spread, order, shuffle_partitions(spark), "rank_")
    extra = F.when(F.col("rank_") < F.col("some_"), 1).otherwise(0)
    times = F.coalesce(F.col("times_") + extra, F.lit(0))
    return (
        ranked.join(plan, ["stratum_", "size"], "left").join(aimed, "stratum_")
        .select(
            F.col("key_").alias(key), F.when(F.col("stratum_") != NO_SOURCE, F.expr("substring(stratum_, 2)")).alias(stratum),
            "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"),
        )
    )


#: Sorts after every name, which all begin with 0.
NO_SOURCE = "1"


def stratum_name(source: Column) -> Column:
    return F.when(source.isNull(), NO_SOURCE).otherwise(F.concat(F.lit("0"), source.cast("string")))
