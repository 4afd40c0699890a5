"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Components become integers, floor(scale * x).  Candidates are dealt into blocks of bounded
size, queries into packs, and each task gets one block and one pack.  The block is sorted once
in every dimension.  A query reads those lists from the end that its sign makes the better one,
deeper in each round; ids met for the first time are scored in full (random access).  The
threshold of a depth is the score of an imagined vector with the list values of that depth.
When it falls below the k-th best score, no unread id can enter, nor tie, and the query stops.

The k best of each block are merged by score, then smaller id.  Blocks and packs are dealt by a
hash of the row's number, so equal ids or equal vectors spread evenly.

Defined results: vectors that are null, empty, or hold null or non-finite components take no
part; a vector meets candidates of its own length; a row is never its own candidate, but other
rows with its id are; null ids come last in ties and are never queries; an empty table gives an
empty result; further columns are not read.  Products of any size are compared exactly; a
component or a best score of 2 ** 63 or more in magnitude is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.llm.vectors import NO_ID, best, first_k, is_query, numbered
from accolade.sources.sinks import cut

BLOCK, PACK = 4096, 1024
#: Depths of the rounds grow by this factor from this start.
FIRST_DEPTH, DEEPER = 8, 8
#: Products up to here are exact in double precision, up to there in 64-bit integers; beyond, Python's integers count.
EXACT, LONG = 2**53, 2**63


class SortedLists:
    """A block of integer vectors with its ids sorted in every dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.down = np.argsort(-vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.down, axis=0)

    def top(self, query: np.ndarray, k: int, skip: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the k best without place ``skip``, and the depth read."""
        n, used = len(self.ids), np.flatnonzero(query)
        up = query[used] < 0
        scores, seen = np.zeros(n, self.vectors.dtype), np.zeros(n, bool)
        depth = min(n, FIRST_DEPTH) if len(used) else n
        while True:
            if depth < n:
                reached = np.zeros(n, bool)
                reached[self.down[:depth, used[~up]]] = True
                reached[self.down[n - depth:, used[up]]] = True
            else:
                reached = np.ones(n, bool)
            fresh = np.flatnonzero(reached & ~seen)
            scores[fresh] = self.vectors[fresh] @ query
            seen |= reached
            if skip is not None:
                reached[skip] = False
            known = np.flatnonzero(reached)
            if depth >= n or seen.all():
                break
            if len(known) >= k:
                last = np.where(up, self.values[n - depth, used], self.values[depth - 1, used])
                if last @ query[used] < np.partition(scores[known], len(known) - k)[len(known) - k]:
                    break
            depth = min(n, depth * DEEPER)
        at = known[best(scores[known], self.ids[known], k)]
        return at, scores[at], depth


def search_block(table: pa.Table, k: int) -> pa.Table:
    """Top k of one block for each query of one pack."""
    rows, asked = table["row"].to_numpy(), table["asked"].to_numpy(zero_copy_only=False)
    ids = table["id"].fill_null(NO_ID).to_numpy()
    flat = table["vec"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    reach = int(np.abs(flat).max(initial=0)) ** 2 * flat.shape[1]
    flat = flat.astype(np.float64) if reach < EXACT else flat if reach < LONG else flat.astype(object)
    own = np.flatnonzero(~asked)
    out: dict[str, list] = {"q_row": [], "query_id": [], "vec_id": [], "score": []}
    if len(own):
        lists = SortedLists(ids[own], flat[own])
        place = {r: i for i, r in enumerate(rows[own].tolist())}
        for q in np.flatnonzero(asked):
            at, scores, _ = lists.top(flat[q], k, place.get(int(rows[q])))
            out["q_row"] += [int(rows[q])] * len(at)
            out["query_id"] += [int(ids[q])] * len(at)
            out["vec_id"] += lists.ids[at].tolist()
            # a block's loser may lie below all 64-bit integers; in the result it is an error
            out["score"] += (np.maximum(scores, -LONG) if scores.dtype == object else scores).astype(np.int64).tolist()
    vec = pa.array([None if i == NO_ID else i for i in out["vec_id"]], pa.int64())
    return pa.table({"q_row": pa.array(out["q_row"], pa.int64()), "query_id": pa.array(out["query_id"], pa.int64()),
                     "vec_id": vec, "score": pa.array(out["score"], pa.int64())})


def top_k(
    rows: DataFrame, k: int = 20, every_nth: int = 20, scale: int = 64, key: str = "vec_id", vector: str = "embedding",
    block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """The k best candidates of every row whose id ``every_nth`` divides."""

    def component(x):
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < float(LONG), F.floor(scaled)).otherwise(F.raise_error(F.lit("a component beyond 64-bit integers")))

    # written once: two scans of other inputs than files might number their rows differently
    whole = cut(numbered(rows, key, vector).withColumn("vec", F.transform("vec", component)), "topk_rows")
    n, asked = whole.agg(F.count(F.lit(1)), F.coalesce(F.sum(is_query(every_nth).cast("long")), F.lit(0))).first()
    blocks, packs = -(-n // block) or 1, -(-asked // pack) or 1
    spread = F.xxhash64("row")
    every_pack = F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    candidates = whole.select(F.pmod(spread, F.lit(blocks)).cast("int").alias("block"), every_pack.alias("pack"), F.lit(False).alias("asked"), "row", "id", "vec")
    queries = whole.where(is_query(every_nth)).select(every_block.alias("block"), F.pmod(spread, F.lit(packs)).cast("int").alias("pack"), F.lit(True).alias("asked"), "row", "id", "vec")
    dealt = candidates.unionByName(queries).withColumn("width", F.size("vec"))

    def search(table: pa.Table) -> pa.Table:
        return search_block(table, k)

    found = dealt.groupBy("block", "pack", "width").applyInArrow(search, "q_row long, query_id long, vec_id long, score long")
    score = F.when(F.col("score") > -LONG, F.col("score")).otherwise(F.raise_error(F.lit("a score beyond 64-bit integers")))
    return first_k(found, k, "score").withColumn("score", score)
