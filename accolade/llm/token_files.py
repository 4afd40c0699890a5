"""Token ids in binary blocks, with a minimal perfect hash index for keyed access.

Documents are dealt out by ranges of their key and sorted, and each task writes its range as
blocks.  A block holds the raw ids of consecutive documents (little-endian integers of 2 or 4
bytes) and an index over their keys: hash and displace.  Keys fall into buckets of about four;
for each bucket, largest first, the first seed is kept that sends its keys to free slots, so n
distinct keys get the slots 0 to n - 1.  A slot stores a 32-bit fingerprint, the place of the
key's ids and its number of documents.  A lookup hashes the key twice and reads one slot.

File format: Parquet rows, one block each, written by Spark, so that any store Spark reaches
will do, failed tasks leave nothing, and blocks outside a key range are skipped by statistics.

    shard, block   number of the key range; number of the block in it
    first_id       ids of the shard before this block
    n_ids, n_docs, key_min, key_max
    seeds          one 32-bit seed for each bucket
    slots          for each key: fingerprint u32, runs u32, first u64 (a run's place in `runs`)
    runs           for each document, in key order: start u64 (in the block), length u64
    keys           the keys in order: what a scan of a block asks for
    payload        raw ids

Bounds: a block holds about ``block_bytes`` of ids, or one document.  The driver holds one
number of ids for each shard, and there are as many shards as the caller asks for.

Defined results: null and empty texts have the end id alone; null keys come first; equal keys,
also null ones, are ordered by a hash of the text, and a lookup gives all of them; an empty
table gives no blocks; further columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accolade.llm.common import bounded_batches, over_batches, shuffle_partitions
from accolade.llm.tokens import texts_of, word_bpe_path, word_ids
from accolade.sources.sinks import shared_folder

END_ID = 2
BLOCK_BYTES = 4 << 20
KEYS_PER_BUCKET = 4
SLOT = np.dtype([("fingerprint", "<u4"), ("runs", "<u4"), ("first", "<u8")])
RUN = np.dtype([("start", "<u8"), ("length", "<u8")])
BLOCK = (
    "shard int, block int, first_id long, n_ids long, n_docs long, key_min {kind}, key_max {kind}, width int, "
    "seeds binary, slots binary, runs binary, keys array<{kind}>, payload binary"
)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hashes(keys: Sequence) -> np.ndarray:
    """A 64-bit hash of each key's text; null has one of its own."""
    from xxhash import xxh64_intdigest

    return np.array([0 if k is None else xxh64_intdigest(str(k).encode()) for k in keys], dtype=np.uint64)


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes % np.uint64(max(1, n // KEYS_PER_BUCKET))).astype(np.int64)


def _slot(hashes: np.ndarray, seeds: np.ndarray | int, n: int) -> np.ndarray:
    step = np.asarray(seeds, dtype=np.uint64) + np.uint64(1)
    return (_mixed(hashes + step * _GOLD) % np.uint64(n)).astype(np.int64)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (_mixed(hashes ^ _GOLD) >> np.uint64(32)).astype(np.uint32)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the buckets, and the slot of each of the distinct hashes."""
    n = len(hashes)
    buckets, free, slots = _bucket(hashes, n), np.ones(n, bool), np.empty(n, np.int64)
    seeds = np.zeros(max(1, n // KEYS_PER_BUCKET), np.uint32)
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for members in sorted(np.split(order, cuts) if n else [], key=len, reverse=True):
        own, tried = hashes[members], 0
        while True:  # many seeds at a time; the last keys need about n of them
            trial = np.arange(tried, tried + (64 if len(own) > 1 else 4096), dtype=np.uint64)
            at = _slot(own[None, :], trial[:, None], n)
            good = free[at].all(axis=1)
            if len(own) > 1:
                good &= (np.diff(np.sort(at, axis=1), axis=1) > 0).all(axis=1)
            if good.any():
                break
            tried += len(trial)
        k = int(np.argmax(good))
        seeds[buckets[members[0]]], slots[members], free[at[k]] = tried + k, at[k], False
    return seeds, slots


def index_of(keys: Sequence) -> tuple[bytes, bytes]:
    """Seeds and slots for keys in order, of which equal ones are adjacent."""
    first = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
    hashes = key_hashes([keys[i] for i in first])
    seeds, at = perfect_hash(hashes)
    slots = np.zeros(len(first), SLOT)
    slots["fingerprint"][at], slots["first"][at] = _fingerprint(hashes), first
    slots["runs"][at] = np.diff([*first, len(keys)])
    return seeds.tobytes(), slots.tobytes()


def find(keys: Sequence, seeds: bytes, slots: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: whether the block has it, its first document there and their number."""
    table, seed, hashes = np.frombuffer(slots, SLOT), np.frombuffer(seeds, "<u4"), key_hashes(keys)
    hit = table[_slot(hashes, seed[_bucket(hashes, len(table))], len(table))]
    return hit["fingerprint"] == _fingerprint(hashes), hit["first"].astype(np.int64), hit["runs"].astype(np.int64)


def _blocks(kind: str, tokenizer: str, end_id: int, width: int, block_bytes: int):
    """Worker function: sorted (key, text) rows of one shard to its blocks."""
    names = [f.split()[0] for f in BLOCK.format(kind=kind).replace("array<", "").split(", ")]

    def run(batches):
        from pyspark import TaskContext

        words, shard = word_ids(tokenizer, f"<u{width}"), TaskContext.get().partitionId()
        end = np.array([end_id], f"<u{width}").tobytes()
        keys, bodies, size, block, before, arrow = [], [], 0, 0, 0, None

        def full():
            lengths = np.array([len(b) // width for b in bodies], np.int64)
            runs = np.zeros(len(bodies), RUN)
            runs["length"], runs["start"] = lengths, np.cumsum(lengths) - lengths
            seeds, slots = index_of(keys)
            known = [k for k in keys if k is not None]
            row = [
                shard, block, before, int(lengths.sum()), len(keys), known[0] if known else None, known[-1] if known else None,
                width, seeds, slots, runs.tobytes(), keys, b"".join(bodies),
            ]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), arrow, arrow, pa.int32(),
                     pa.binary(), pa.binary(), pa.binary(), pa.list_(arrow), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            arrow = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                body = words.encode(text) + end
                if bodies and size + len(body) > block_bytes:
                    yield full()
                    block, before = block + 1, before + size // width
                    keys, bodies, size = [], [], 0
                keys.append(key)
                bodies.append(body)
                size += len(body)
        if bodies:
            yield full()

    return run


def write(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, key: str = "doc_id",
    text: str = "text", shards: int | None = None, width: int = 4, block_bytes: int = BLOCK_BYTES,
) -> None:
    """Writes the blocks of all documents, in ascending key order, under ``path``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    ordered = rows.repartitionByRange(shards or shuffle_partitions(spark), "key", "h").sortWithinPartitions("key", "h")
    ordered.select("key", "text").mapInArrow(
        _blocks(kind, tokenizer or word_bpe_path(), end_id, width, block_bytes), BLOCK.format(kind=kind)
    ).write.mode("overwrite").option("compression", "zstd").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """Ids before each shard; as many entries as there are shards."""
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    starts, before = {}, 0
    for r in sorted(sizes):
        starts[r["shard"]], before = before, before + r["n"]
    return starts


def lookup(spark: SparkSession, path: str, wanted: Sequence | None = None) -> DataFrame:
    """Documents by key: (key, start, ids), ids as raw little-endian bytes with their ``width``.

    ``wanted`` is a list of keys as a serving process would ask for; blocks whose key range
    holds none of them are not read.  None asks each block for all of its own keys.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["key_min"].dataType.simpleString()
    starts = shard_starts(spark, path)
    if wanted is not None:
        inside = [(F.col("key_min") <= F.lit(k)) & (F.col("key_max") >= F.lit(k)) for k in wanted if k is not None]
        inside += [F.col("key_min").isNull() | F.exists("keys", lambda k: k.isNull())] if None in wanted else []
        condition = F.lit(False)
        for c in inside:
            condition = condition | c
        blocks = blocks.where(condition)

    def make():
        def step(batch):
            for row in batch.to_pylist():
                asked = list(dict.fromkeys(row["keys"])) if wanted is None else list(wanted)
                found, first, n = find(asked, row["seeds"], row["slots"])
                runs, width = np.frombuffer(row["runs"], RUN), row["width"]
                base = starts[row["shard"]] + row["first_id"]
                out: tuple[list, list, list] = ([], [], [])
                for k in np.flatnonzero(found):
                    for start, length in runs[first[k]:first[k] + n[k]].tolist():
                        out[0].append(asked[k])
                        out[1].append(base + start)
                        out[2].append(row["payload"][width * start:width * (start + length)])
                arrow = batch.schema.field("key_min").type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], arrow), pa.array(out[1], pa.int64()), pa.array([width] * len(out[0]), pa.int32()),
                     pa.array(out[2], pa.binary())], names=["key", "start", "width", "ids"])

        return step

    columns = ["shard", "first_id", "key_min", "width", "seeds", "slots", "runs", "keys", "payload"]
    return over_batches(blocks.select(*columns), make, f"key {kind}, start long, width int, ids binary")


def ids_crc32(ids: bytes, width: int) -> int:
    return zlib.crc32(ids if width == 4 else np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of documents that ``lookup`` returned."""
    kind = found.schema["key"].dataType.simpleString()

    def make():
        def step(batch):
            ids, width = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(b) // w for b, w in zip(ids, width, strict=True)], pa.int64()),
                 pa.array([ids_crc32(b, w) for b, w in zip(ids, width, strict=True)], pa.int64())],
                names=["key", "start", "n_tokens", "ids_crc32"])

        return step

    return over_batches(found, make, f"key {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/accolade/tokens_{uuid.uuid4().hex}"
