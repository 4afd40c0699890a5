"""Approximate nearest neighbours by shifted Hilbert curves.

For each of several curves the vectors are projected by a random rotation to a few dimensions,
shifted, cut into a grid and keyed by their place on the Hilbert curve through it.  Spark range
partitions and sorts the vectors of all curves by (curve, key); each run of consecutive vectors is
one block.  A query's own key falls into a block, and its candidates on that curve are the blocks
in a window around it.  Candidates are scored by the inner product in double precision, the
windows of all curves merge, and the k best remain.

Equal vectors are one entry of a curve, which carries the k + 1 of its rows with the smallest ids:
no query can need more of them.  Queries with equal vectors ask once, for k + 1 rows, and each
leaves out its own.

For the largest inner product, candidates carry one more component that brings all of them to
one length, and queries a zero; then the nearest vector is the one with the largest product.
Candidates are parted into ranges of length, within which lengths differ by a factor of two at
most, and each range has curves and a grid of its own: a few very long vectors leave the grid of
the others as fine as it was.  A query, brought to the length of the range, asks in every range.

The window is a share of the curve's blocks.  The share decides recall: vectors in clusters need
little, directionless ones much (README gives measured figures).

Bounds: blocks hold up to ``block`` vectors; a table of T vectors has T / block blocks for each
curve, whose numbering is the only thing that one task orders.  The rows of a hot vector are cut
to k + 1 in ``SALTS`` parts before they meet.

Defined results: vectors that are null, empty, all zero, or hold null or non-finite components
take no part; vectors of each number of components have curves of their own and are compared among
themselves; any finite magnitude is ordered rightly, with products beyond double precision's range
counting as infinite or zero; a row is never its own candidate; null ids come last in ties and are
never queries; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from accolade.llm.common import bounded_batches, shuffle_partitions
from accolade.llm.vectors import NO_ID, best, is_query, numbered
from accolade.sources.sinks import cut

CURVES, DIMENSIONS, BITS = 8, 8, 7
WINDOW_SHARE = 0.2
MOST_IN_BLOCK, LEAST_BLOCKS = 2048, 64
SALTS = 16
SEED = 20260101


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates below ``2 ** bits``.

    Works downwards through the bit planes, undoing the reflections and exchanges of axes that
    each level of the curve makes; the Gray code of the rest, read across axes, is the place.
    """
    x = cells.T.astype(np.int64)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in x:
            swap = np.where(axis & bit, 0, (x[0] ^ axis) & low)
            flip = np.where(axis & bit, low, 0)
            x[0] ^= swap | flip
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> level & 1
    return key


def curve_keys(vectors: np.ndarray, extra: np.ndarray, longest: float, curve: int) -> np.ndarray:
    """Keys on one curve; ``extra`` is the component that brings vectors to one length."""
    width = vectors.shape[1] + 1
    rng = np.random.default_rng([SEED, curve])
    used = min(DIMENSIONS, width)
    rotation, _ = np.linalg.qr(rng.standard_normal((width, used)))
    at = np.column_stack([vectors, extra]) @ rotation * (math.sqrt(width) / (6 * longest)) + 0.5
    at += rng.uniform(-0.125, 0.125, used)
    return hilbert_key((np.clip(at, 0, 1 - 1e-9) * (1 << BITS)).astype(np.int64), BITS)


def _marked(rows: DataFrame, every_nth: int) -> DataFrame:
    """(row, id, asks, vec, mark): vectors in double precision, equal ones (0 and -0 are equal) with equal marks."""
    exact = F.transform("vec", lambda x: x.cast("double") + F.lit(0.0))
    marked = rows.select("row", "id", is_query(every_nth).alias("asks"), exact.alias("vec"))
    return marked.withColumn("mark", F.unhex(F.md5(F.array_join(F.transform("vec", lambda x: x.cast("string")), ",").cast("binary"))))


def _entries(marked: DataFrame, k: int) -> DataFrame:
    """(mark, vec, rows, ids, asks): each vector once with the ``k + 1`` of its rows whose ids are smallest."""
    few = marked.drop("asks").withColumn("salt", F.col("row") % SALTS)
    for keys in (["mark", "salt"], ["mark"]):
        order = Window.partitionBy(*keys).orderBy(F.col("id").asc_nulls_last(), "row")
        few = few.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k + 1)
    member = F.struct("row", F.coalesce("id", F.lit(int(NO_ID))).alias("id"))
    entries = few.groupBy("mark").agg(F.first("vec").alias("vec"), F.collect_list(member).alias("members"))
    asking = marked.where("asks").select(F.col("mark").alias("asking")).distinct()
    return entries.join(asking, F.col("mark") == F.col("asking"), "left").select(
        "mark", "vec", F.col("members.row").alias("rows"), F.col("members.id").alias("ids"), F.col("asking").isNotNull().alias("asks"))


def _log_norm(entries: DataFrame) -> DataFrame:
    """Add the logarithm (base 2) of a vector's length; its largest component is taken out before
    squaring, so that no finite vector overflows or vanishes.  That component is a column of its own,
    so it is found once for a vector."""
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + F.pow(x / F.col("top"), F.lit(2.0)))
    topped = entries.withColumn("top", F.array_max(F.transform("vec", lambda x: F.abs(x))))
    return topped.withColumn("log", F.log2("top") + F.log2(squares) / 2).drop("top")


def _keyed(entries: DataFrame, spaces: list[tuple[int, int, float]]) -> DataFrame:
    """Each vector on the curves of its space as candidate and, if rows with it are queries, on those of all spaces of its width as query.

    ``spaces`` has (width, range, longest); space number i has the curves from ``i * CURVES`` on.  A
    space's vectors are scaled by 2 ** -range, and ``longest`` is the longest of them then.
    """
    def keys(batches):
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            flat, starts = batch.column(1).flatten().to_numpy(), np.cumsum(sizes) - sizes
            asking = batch.column(4).to_numpy(zero_copy_only=False)
            ranges = batch.column(5).to_numpy()
            for width in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == width)
                vectors = flat[starts[rows, None] + np.arange(width)]
                top = np.abs(vectors).max(axis=1, keepdims=True)
                unit = vectors / top
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                body = pa.array([v.astype("<f8").tobytes() for v in vectors], pa.binary())
                asks = np.flatnonzero(asking[rows])
                for space, (wide, of, longest) in enumerate(spaces):
                    if wide != width:
                        continue
                    offers = np.flatnonzero(ranges[rows] == of)
                    scaled = np.ldexp(vectors[offers], -of)
                    lift = np.sqrt(np.maximum(longest**2 - np.square(scaled).sum(axis=1), 0))
                    for turn in range(CURVES):
                        for asked, some, key in ((False, offers, curve_keys(scaled, lift, longest, turn)),
                                                 (True, asks, curve_keys(unit[asks] * longest, np.zeros(len(asks)), longest, turn))):
                            part = batch.take(pa.array(rows[some]))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(some), space * CURVES + turn), pa.int32()), pa.array(key, pa.int64()),
                                 pa.array(np.full(len(some), asked)), part.column(0), part.column(2), part.column(3), body.take(pa.array(some))],
                                names=["curve", "key", "asked", "mark", "rows", "ids", "vec"])

    return entries.mapInArrow(keys, "curve int, key long, asked boolean, mark binary, rows array<long>, ids array<long>, vec binary")


_PACKED = "curve int, part int, idx int, asked boolean, n int, marks array<binary>, sizes binary, n_rows binary, ids binary, vecs binary"


def _blocks(most: list[int]):
    """Worker function: vectors sorted by (curve, key) to blocks and the queries that fall into them.

    ``most`` is the size of a block for each space.  Only candidates fill a block; queries beyond
    ``MOST_IN_BLOCK`` make a further pack of the same block.
    """
    schema = pa.schema([("curve", pa.int32()), ("part", pa.int32()), ("idx", pa.int32()), ("asked", pa.bool_()), ("n", pa.int32()),
                        ("marks", pa.list_(pa.binary())), ("sizes", pa.binary()), ("n_rows", pa.binary()), ("ids", pa.binary()), ("vecs", pa.binary())])

    def pack(batches):
        from pyspark import TaskContext

        part, curve, idx = TaskContext.get().partitionId(), None, 0
        held: dict[bool, list] = {False: [], True: []}

        def flush(asked):
            marks, rows, ids, vecs = zip(*held[asked], strict=True) if held[asked] else ((), (), (), ())
            held[asked] = []
            members = ((), ()) if asked else (rows, ids)  # queries are told by their mark alone
            sizes, n_rows, of_ids = [len(r) for r in members[0]], [x for r in members[0] for x in r], [x for r in members[1] for x in r]
            yield pa.RecordBatch.from_pylist(
                [{"curve": curve, "part": part, "idx": idx, "asked": asked, "n": len(marks), "marks": list(marks) if asked else [],
                  "sizes": np.array(sizes, "<i8").tobytes(), "n_rows": np.array(n_rows, "<i8").tobytes(),
                  "ids": np.array(of_ids, "<i8").tobytes(), "vecs": b"".join(vecs)}], schema=schema)

        for batch in batches:
            for c, asked, *entry in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if curve is not None and (c != curve or not asked and len(held[False]) >= most[c // CURVES]):
                    if held[True]:
                        yield from flush(True)
                    yield from flush(False)
                    idx += 1
                curve = c
                if asked and len(held[True]) >= MOST_IN_BLOCK:
                    yield from flush(True)
                held[asked].append(entry)
        if curve is not None:
            if held[True]:
                yield from flush(True)
            yield from flush(False)

    return pack


def nearest(
    rows: DataFrame, k: int = 20, every_nth: int = 20, key: str = "vec_id", vector: str = "embedding",
    window_share: float = WINDOW_SHARE,
) -> DataFrame:
    """The k nearest found of every row whose id ``every_nth`` divides."""
    spark = rows.sparkSession
    bounded_batches(spark)
    marked = cut(_marked(numbered(rows, key, vector).where(F.exists("vec", lambda x: x != 0)), every_nth), "hilbert_rows")
    entries = cut(_entries(marked, k), "hilbert_entries")
    ranged = _log_norm(entries).withColumn("range", F.round("log").cast("int"))  # round: vectors of length 1 are in one range
    sizes = ranged.groupBy(F.size("vec").alias("width"), "range").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.pow(F.lit(2.0), F.col("log") - F.col("range"))).alias("longest")).collect()
    here = sorted((r["width"], r["range"], r["longest"], r["n"]) for r in sizes)
    most = [min(MOST_IN_BLOCK, max(1, -(-n // LEAST_BLOCKS))) for *_, n in here]
    keyed = _keyed(ranged.drop("log"), [(width, of, longest) for width, of, longest, _ in here])
    sorted_rows = keyed.repartitionByRange(shuffle_partitions(spark), "curve", "key", "mark").sortWithinPartitions("curve", "key", "mark")
    packed = sorted_rows.select("curve", "asked", "mark", "rows", "ids", "vec").mapInArrow(_blocks(most), _PACKED)
    blocks = cut(packed, "hilbert_blocks")

    on_curve = Window.partitionBy("curve")
    filled = (F.col("n") > 0).cast("int")  # a stretch of queries alone lies at the filled block before it
    upto = on_curve.orderBy("part", "idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = blocks.where(~F.col("asked")).select(
        "curve", "part", "idx",
        F.greatest(F.lit(0), F.sum(filled).over(upto) - 1).alias("place"), F.sum(filled).over(on_curve).alias("of"))
    placed = blocks.join(places, ["curve", "part", "idx"])
    reach = F.ceil(F.col("of") * (window_share / 2)).cast("int")
    first = F.greatest(F.lit(0), F.least(F.col("place") - reach, F.col("of") - 1 - 2 * reach)).cast("int")
    last = F.least(F.col("of") - 1, first + 2 * reach).cast("int")
    asked = placed.where("asked").select("curve", F.explode(F.sequence(first, last)).alias("place"), "marks", "vecs")
    offered = placed.where("not asked and n > 0").select(
        F.col("curve").alias("curve"), F.col("place").cast("int").alias("place"),
        *[F.col(c).alias(c) for c in ("sizes", "n_rows", "ids", "vecs")])

    def score(block: pa.Table, packs: pa.Table) -> pa.Table:
        out: dict[str, list] = {"mark": [], "row": [], "vec_id": [], "score": []}
        for b in block.to_pylist():
            own, ids = np.frombuffer(b["n_rows"], "<i8"), np.frombuffer(b["ids"], "<i8")
            sizes = np.frombuffer(b["sizes"], "<i8")
            entry = np.repeat(np.arange(len(sizes)), sizes)
            vectors = np.frombuffer(b["vecs"], "<f8").reshape(len(sizes), -1)
            for p in packs.to_pylist():
                scores = np.frombuffer(p["vecs"], "<f8").reshape(len(p["marks"]), -1) @ vectors.T
                for i, mark in enumerate(p["marks"]):
                    line = scores[i][entry]
                    at = best(line, ids, k + 1)
                    out["mark"] += [mark] * len(at)
                    out["row"] += own[at].tolist()
                    out["vec_id"] += ids[at].tolist()
                    out["score"] += line[at].tolist()
        return pa.table({"mark": pa.array(out["mark"], pa.binary()), "row": pa.array(out["row"], pa.int64()),
                         "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    found = offered.groupBy("curve", "place").cogroup(asked.groupBy("curve", "place")).applyInArrow(
        score, "mark binary, row long, vec_id long, score double")
    merged = found.groupBy("mark", "row", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("mark").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = merged.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k + 1)
    answers = ranked.groupBy(F.col("mark").alias("of")).agg(F.sort_array(F.collect_list(F.struct("turn", "row", "vec_id", "score"))).alias("near"))
    asking = marked.where("asks").select("row", F.col("id").alias("query_id"), "mark")
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("row")), 1, k)
    each = asking.join(answers, F.col("mark") == F.col("of")).select("query_id", F.posexplode(others).alias("place", "one"))
    vec_id = F.when(F.col("one.vec_id") != int(NO_ID), F.col("one.vec_id"))
    return each.select("query_id", (F.col("place") + 1).alias("rank"), vec_id.alias("vec_id"), F.col("one.score").alias("score"))
