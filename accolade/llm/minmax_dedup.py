"""Near-duplicate documents by min-max hashing, with links confirmed on full shingle sets.

A text's set holds its distinct runs of five words (ASCII letters lower-cased, words split at
ASCII white space); a shorter text is one run.  Every permutation of the shingle hashes keeps
its smallest and its largest value, so ``PERMUTATIONS`` evaluations give twice as many signature
values, each equal for two texts with the probability of their Jaccard similarity.  Values are
cut into bands of ``ROWS``: at similarity 0.75 all ``2 * PERMUTATIONS / ROWS`` bands of a pair
differ with probability (1 - 0.75 ** 3) ** 28, about 2e-7.

1. Equal sets are one node from here on, whatever the number of copies.
2. A bucket is a band value that several nodes share.  Each node is compared with the smallest
   node of each of its buckets: full sets meet by joins, and 100 * intersection >= 75 * union
   links them.  Linked nodes form components.
3. Two members of a bucket in different components may still be linked.  Members outside the
   largest component of their bucket are compared with all its members: both sides are cut into
   blocks of at most about ``BLOCK_ROWS`` sets and ``BLOCK_SHINGLES`` shingles, and a task compares one
   block with another.  There, shingles that meet in no second component are dropped, and so are
   sets with too few others, until none falls out; one matrix product counts the intersections
   of those left.  The task returns which components are linked, never pairs of documents.
   Buckets with the same members are compared once.  Every pair that shares a bucket has then
   been compared or is connected.

Leaders and blocks are found by aggregates and joined back, so no bucket is ever gathered and
Spark can split hot ones; a link never costs a row of a join.  Sets of texts in a shared bucket
are the only ones kept.

Defined results: null, empty and blank texts have no shingles and are alone; a component is
named by its smallest non-null id; rows that share an id stand or fall together; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.llm.common import bounded_batches, over_batches
from accolade.llm.components import components
from accolade.sources.sinks import cut

WORDS, PERMUTATIONS, ROWS = 5, 42, 3
SHARE = 75  # percent
WORDS_KEPT = 500_000
CHUNK = 1 << 14
#: Expected size of a block: a product of two has BLOCK_ROWS ** 2 counts.  Entries of a part of its factors.
BLOCK_ROWS, BLOCK_SHINGLES, ENTRIES = 2_048, 1 << 20, 1 << 22
SEED = 77


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = xxh64_intdigest(word)
        return found


class Shingles:
    """The sorted hashes of a text's distinct shingles."""

    def __init__(self):
        self._hash = _WordHashes().__getitem__
        rng = np.random.default_rng(SEED)
        self._odd = rng.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: ASCII alone is lowered
        if not words:
            return np.empty(0, np.uint64)
        own = np.fromiter(map(self._hash, words), np.uint64, len(words))
        n = min(WORDS, len(own))
        runs = len(own) - n + 1
        mix = np.full(runs, n, np.uint64)
        for i in range(n):
            mix += _mixed(own[i:i + runs] + np.uint64(i)) * self._odd[i]
        return np.unique(_mixed(mix))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of every permutation, then the largest ones."""
    rng = np.random.default_rng(SEED + 1)
    odd = rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
    low, high = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK, None] * odd + add
        np.minimum(low, part.min(axis=0), out=low)
        np.maximum(high, part.max(axis=0), out=high)
    return np.concatenate([low, high])


def bands(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit value for each band; the band's number is mixed in."""
    rows = signature(hashes).reshape(-1, ROWS)
    mix = np.arange(len(rows), dtype=np.uint64)
    for i in range(ROWS):
        mix = _mixed(mix + rows[:, i]) * np.uint64(2 * i + 3)
    return mix.view(np.int64)


def _marks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, body, n, node, bands): id, hash of the text, size, digest and bands of its set."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("body"))

    def make():
        from xxhash import xxh3_128_digest

        shingles = Shingles()

        def step(batch):
            sets = [shingles.of(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["doc", "body", "n", "node", "bands"])

        return step

    return over_batches(rows, make, f"doc {kind}, body long, n long, node binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(node, own): the sorted shingle hashes of wanted nodes, from (node, body) of one text each."""
    rows = docs.select(F.xxhash64(text).alias("at"), F.col(text).alias("text"))
    found = rows.join(wanted, F.col("at") == F.col("body")).select("node", "text")

    def make():
        from xxhash import xxh3_128_digest

        shingles = Shingles()

        def step(batch):
            sets = [shingles.of(t).tobytes() for t in batch.column(1).to_pylist()]
            right = [i for i, (s, n) in enumerate(zip(sets, batch.column(0).to_pylist(), strict=True)) if xxh3_128_digest(s) == n]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(right, pa.int64())), pa.array([sets[i] for i in right], pa.binary())], names=["node", "own"])

        return step

    every = over_batches(found, make, "node binary, own binary")
    return every.groupBy("node").agg(F.first("own").alias("own"))  # copies of a text give the same


def _links(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u_"), F.col("own").alias("left"))
    right = sets.select(F.col("node").alias("v_"), F.col("own").alias("right"))
    met = pairs.join(left, F.col("u") == F.col("u_")).join(right, F.col("v") == F.col("v_")).select("u", "v", "left", "right")

    def make():
        def step(batch):
            linked = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= share * (len(a) + len(b) - both))
            some = pa.array(np.flatnonzero(linked))
            return pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some)], names=["u", "v"])

        return step

    return over_batches(met, make, "u binary, v binary")


def _may_link(a: str, b: str, share: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * share


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every document."""
    bounded_batches(docs.sparkSession)
    marks = cut(_marks(docs, key, text), "marks")
    nodes = marks.where("n > 0").groupBy("node").agg(
        F.min("doc").alias("least_doc"), F.min("body").alias("body"), F.min("n").alias("n"), F.first("bands").alias("bands"))
    spread = nodes.select(F.explode("bands").alias("bucket"), "node", "n")
    shared = spread.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = cut(shared.select(F.col("bucket").alias("at"), "leader"), "shared")  # a join side of its own: hot buckets are split
    members = cut(spread.join(shared, F.col("bucket") == F.col("at")).select("bucket", "node", "n", "leader"), "members")
    wanted = nodes.select(F.col("node").alias("own"), "body").join(members.select("node").distinct(), F.col("own") == F.col("node")).select("node", "body")
    sets = cut(_sets(docs, wanted, text), "sets")

    sizes = members.where(F.col("node") == F.col("leader")).select(F.col("node").alias("lead"), F.col("n").alias("lead_n")).distinct()
    first = members.where(F.col("node") != F.col("leader")).select("node", "n", "leader").distinct()
    first = first.join(sizes, F.col("leader") == F.col("lead")).where(_may_link("n", "lead_n", share))
    links = cut(_links(first.select(F.col("node").alias("u"), F.col("leader").alias("v")), sets, share), "near_links")
    labels = components(links)
    more = cut(_links_between_components(members.select("bucket", "node", "n"), labels, sets, share), "root_links")
    if not more.isEmpty():
        labels = components(labels.unionByName(more))

    named = nodes.select("node", "least_doc").join(labels.select(F.col("u").alias("of"), "v"), F.col("node") == F.col("of"), "left")
    named = named.select("node", "least_doc", F.coalesce("v", "node").alias("root"))
    roots = named.groupBy(F.col("root").alias("root_")).agg(F.min("least_doc").alias("component"))
    named = named.join(roots, F.col("root") == F.col("root_")).select(F.col("node").alias("node_"), "component")
    out = marks.select("doc", "n", "node").join(named, F.col("node") == F.col("node_"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component"))
    return out.select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
    )


def _joined_roots(table: pa.Table, left: np.ndarray, right: np.ndarray, share: int) -> list[tuple[bytes, bytes]]:
    """Links that join the roots of a block's left and right rows, no more than needed for their components."""
    sets = [np.frombuffer(own, np.uint64) for own in table.column("own").to_pylist()]
    n = np.array([len(s) for s in sets], np.int64)
    names, root = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
    rows = np.arange(len(sets))
    while True:  # sets that cannot reach the share even if all their common shingles meet in one other set
        owner = np.repeat(rows, n[rows])
        columns, column = np.unique(np.concatenate([np.empty(0, np.uint64), *[sets[i] for i in rows]]), return_inverse=True)
        least, most = np.full(len(columns), len(names)), np.full(len(columns), -1)
        np.minimum.at(least, column, root[owner])
        np.maximum.at(most, column, root[owner])
        common = (least != most)[column]
        enough = 100 * np.bincount(owner[common], minlength=len(sets))[rows] >= share * n[rows]
        if enough.all():
            break
        rows = rows[enough]
    lefts, rights = rows[left[rows]], rows[right[rows]]
    if not len(lefts) or not len(rights):
        return []
    owner, column = owner[common], np.unique(column[common], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    place = np.zeros(len(sets), np.int64)
    place[rows] = np.arange(len(rows))
    both = np.zeros((len(lefts), len(rights)), np.int64)
    width = max(1, ENTRIES // len(rows))
    for at in range(0, int(column[-1]) + 1, width):
        start, end = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(rows), width), np.float32)
        part[place[owner[start:end]], column[start:end] - at] = 1
        both += (part[place[lefts]] @ part[place[rights]].T).astype(np.int64)
    linked = 100 * both >= share * (n[lefts][:, None] + n[rights][None, :] - both)
    u, v = np.nonzero(linked & (root[lefts][:, None] != root[rights][None, :]))
    one = list(range(len(names)))

    def find(i):
        while one[i] != i:
            one[i] = i = one[one[i]]
        return i

    out = []
    for pair in np.unique(root[lefts[u]] * len(names) + root[rights[v]]).tolist():
        a, b = divmod(pair, len(names))
        if find(a) != find(b):
            one[find(a)] = find(b)
            out.append((names[a], names[b]))
    return out


def _links_between_components(members: DataFrame, labels: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Links (u, v) between the smallest nodes of components that hold linked members of one bucket."""
    named = members.join(labels.select(F.col("u").alias("of"), "v"), F.col("node") == F.col("of"), "left")
    named = cut(named.select("bucket", "node", "n", F.coalesce("v", "node").alias("root")), "named")
    parts = named.groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
    largest = F.max(F.struct("rows", "n", "root"))
    buckets = parts.groupBy("bucket").agg(
        largest.alias("one"), F.count(F.lit(1)).alias("roots"), F.sum("rows").alias("rows"), F.sum("n").alias("n"),
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).where("roots > 1")

    def blocks(rows, n):
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(n / BLOCK_SHINGLES)).cast("int")

    # the rest of a row follows from the members of its bucket, so buckets with the same ones are one
    same = buckets.groupBy("rows", "x", "y").agg(F.min("bucket").alias("at"), F.max("one").alias("one"), F.max("n").alias("all_n"))
    same = cut(same.select(
        "at", F.col("one.root").alias("one"), blocks(F.col("rows") - F.col("one.rows"), F.col("all_n") - F.col("one.n")).alias("lefts"),
        blocks(F.col("rows"), F.col("all_n")).alias("rights")), "mixed_buckets")

    other = F.col("root") != F.col("one")
    dealt = named.join(same, F.col("bucket") == F.col("at")).select(
        "bucket", "node", "root", "lefts", "rights",
        F.when(other, F.pmod(F.xxhash64(F.lit(2), "node"), "lefts")).cast("int").alias("own_left"),
        F.pmod(F.xxhash64(F.lit(3), "node"), "rights").cast("int").alias("own_right"))
    as_right = F.expr("transform(sequence(0, lefts - 1), i -> struct(i AS i, own_right AS j))")
    as_left = F.expr("transform(sequence(0, rights - 1), j -> struct(own_left AS i, j AS j))")
    cell = F.when(F.col("own_left").isNull(), as_right).otherwise(F.array_union(as_right, as_left))
    dealt = dealt.select("bucket", "node", "root", "own_left", "own_right", F.explode(cell).alias("cell"))
    dealt = dealt.select(
        "bucket", "cell.i", "cell.j", F.col("node").alias("of"), "root",
        F.coalesce(F.col("own_left") == F.col("cell.i"), F.lit(False)).alias("left"), (F.col("own_right") == F.col("cell.j")).alias("right"))
    full = dealt.join(sets, F.col("of") == F.col("node")).select("bucket", "i", "j", "root", "left", "right", "own")

    def compare(table: pa.Table) -> pa.Table:
        left, right = (table.column(c).to_numpy() for c in ("left", "right"))
        links = _joined_roots(table, left, right, share)
        return pa.table({"u": pa.array([a for a, _ in links], pa.binary()), "v": pa.array([b for _, b in links], pa.binary())})

    return full.groupBy("bucket", "i", "j").applyInArrow(compare, "u binary, v binary").distinct()


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """The documents without those that another one of their component stands for.

    Rows are told apart by id and digest of the text, so a row falls only for its own component,
    whatever other rows share its id, and null ids are no group.  The smallest id stays, of equal
    ids the smallest digest, of rows equal in both the one whose columns sort first (maps are
    left out of that order).  Rows without shingles all stay.
    """
    mark = F.unhex(F.md5(F.col(text).cast("binary")))
    own = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), mark.alias("mark"))
    found = near_duplicates(docs.select(own.alias("own"), F.col(text).alias("text")), "own", "text", share).where("n_shingles > 0")
    fate = found.groupBy(F.col("own.id").alias("id_"), F.col("own.mark").alias("mark_")).agg(
        F.bool_and("kept").alias("kept_"), (F.count(F.lit(1)) > 1).alias("repeated_")).where("not kept_ or repeated_")
    fate = cut(fate, "fate")
    same = F.col(key).eqNullSafe(F.col("id_")) & (mark == F.col("mark_"))
    alone = docs.join(fate, same, "left_anti")
    repeated = fate.where("kept_")
    if repeated.isEmpty():
        return alone
    ordered = F.struct(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    rows = docs.select(F.struct("*").alias("row"), ordered.alias("order"), F.col(key).alias("key"), mark.alias("mark"))
    met = rows.join(repeated, F.col("key").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")))
    return alone.unionByName(met.groupBy("id_", "mark_").agg(F.min_by("row", "order").alias("row")).select("row.*"))
