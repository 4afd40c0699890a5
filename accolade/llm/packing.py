"""Packing by shortest-pack-first over the length histogram.

A document's ids are cut at multiples of the capacity; full pieces fill a sequence each, the
rest is one shorter piece.  Piece lengths are counted.  Lengths are then placed longest first:
a length goes to the packs with the most room (the shortest packs), many equal packs at a time,
so the placement works on counts and never on documents.  Each step says that the pieces of
one length with ranks [r, r + c) go to the sequences [s, s + c) at one offset; pieces look
their step up by length and rank.

Bounds: the histogram has ``capacity`` entries at most and is all the driver receives; the
number of steps depends on the capacity and not on the number of documents.  Pieces are narrow
rows (no ids unless asked for) and are ranked within their length in cuts of a hash, so one
length may have any share of the rows.

Defined results: null and empty texts are the end id alone; repeated rows and repeated or null
keys are packed one by one; an empty table gives no pieces; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.llm.common import bounded_batches, over_batches, rank_within, shuffle_partitions
from accolade.llm.tokens import texts_of, word_bpe_path, word_ids
from accolade.sources.sinks import cut

CAPACITY, END_ID = 4096, 2
#: Ranks within a length stay below this, so length and rank fit one 64-bit key.
RANK_BITS = 48


def shortest_pack_first(lengths: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first rank, count, first sequence, offset) from counts of lengths."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: runs of equal packs
    steps, opened, widest = [], 0, 0
    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            while widest and not room[widest]:
                widest -= 1
            if widest >= length:
                first, packs = room[widest].pop()
                used, at = min(left, packs), widest
                if used < packs:
                    room[at].append((first + used, packs - used))
            else:
                first, used, at = opened, left, capacity
                opened += left
            steps.append((length, rank, used, first, capacity - at))
            room[at - length].append((first, used))
            widest = max(widest, at - length)
            rank, left = rank + used, left - used
    return steps


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
    text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Each text's ids and the end id, cut at multiples of the capacity."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc {kind}, start long, length int, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def make():
        words = word_ids(tokenizer)

        def step(batch):
            keys, rows = batch.column(0), []
            for i, body in enumerate(texts_of(batch.column(1))):
                ids = words.encode(body) + end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at:at + 4 * capacity]
                    rows.append((i, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part if with_ids else None))
            index, start, length, crc, total, part = zip(*rows, strict=True)
            columns = [
                keys.take(pa.array(index)), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                pa.array(crc, pa.int64()), pa.array(total, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(
                columns + ([pa.array(part, pa.binary())] if with_ids else []),
                names=["doc", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else []),
            )

        return step

    return over_batches(docs.select(key, text), make, schema)


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
    key: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces with their sequence and place in it.

    Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the piece's
    ids (little-endian, 32 bits each) ``with_ids``.
    """
    cutoff = cut(pieces(docs, tokenizer or word_bpe_path(), capacity, end_id, key, text, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in cutoff.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = sorted(shortest_pack_first(counts, capacity))
    length, rank, _, sequence, offset = (np.array(c, dtype=np.int64) for c in (zip(*steps, strict=True) if steps else [[]] * 5))
    starts = (length << RANK_BITS) + rank

    def place(batches):
        for pdf in batches:
            at = np.searchsorted(starts, (pdf["length"].to_numpy(np.int64) << RANK_BITS) + pdf["rank_"].to_numpy(), "right") - 1
            yield pd.DataFrame(
                {c: pdf[c] for c in pdf.columns if c != "rank_"}
                | {"sequence_id": sequence[at] + pdf["rank_"].to_numpy() - rank[at], "offset": offset[at]}
            )

    spread = F.xxhash64("doc", "start").bitwiseAND(F.lit(2**31 - 1)).cast("double") / float(2**31)
    hashed = cutoff.withColumn("spread_", spread)
    order = [F.col(c) for c in ("spread_", "doc", "start", "ids_crc32")]
    buckets = shuffle_partitions(docs.sparkSession)
    ranked = rank_within(hashed, ["length"], F.col("spread_"), order, buckets, "rank_").drop("spread_")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cutoff.schema)
    placed = ranked.select(*cutoff.columns, "rank_").mapInPandas(place, f"{kinds}, sequence_id long, offset long")
    return placed.select(
        F.col("doc").alias(key), "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        "sequence_id", "offset", *(["ids"] if with_ids else []),
    )
