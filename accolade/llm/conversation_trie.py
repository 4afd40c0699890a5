"""Trie of the prefixes that conversations share, by ROLLUP over positional turn-id columns.

A turn's id is 128 bits of the SHA-256 of its role and text, followed by its number of words; texts
do not leave the scan.  A conversation's ids are laid out in blocks of ``WIDTH`` columns.  One
``GROUP BY before, ROLLUP(t1 .. t8)`` over all blocks makes every prefix of every conversation
a group, ``grouping_id`` says how long it is, and members are counted before the exchange.  A
block goes on from the node at which the block before it ended: ``before`` is that node's key.

Keys without walking block by block: a block's ids are hashed, hashes of eight blocks are a block
of the next level, and so on, so that a conversation of n turns takes log8(n) levels.  From the
top down a level's keys are the key it goes on from and the hashes up to there.  A node has one
key whichever conversation it is reached by.

Subtree sums without walking the tree: a node stands for its smallest member, so each
conversation stands for the lower end of its path, from some depth on.  The weights (saved
words, or being a leaf) of the nodes that a conversation stands for are added up and a second
ROLLUP sums them over members; that counts the whole subtree and, for the node's own conversation,
its nodes further up, which a running sum along the path takes off again.

Skew: turns are numbered in ranges of (conversation, turn), blocks hold eight turns, running sums
go in runs of depths, and the member ids of a node's digest in runs of ids, so no task gets a whole
conversation or the members of a node; only the digest itself, a SHA-256 over all ids, is taken in
one stream, of one run of ids at a time.

Defined results: rows without conv_id belong to no conversation; null turns come first, and turns
with the same number are ordered by the digest of role and text; null roles and texts are
empty; repeated rows are turns of their own; an empty table has no root and gives no rows; further
columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from accolade.llm.ranges import ranked_in_ranges
from accolade.sources.sinks import cut

#: Turns of one block of columns; bytes of a digest.
WIDTH, DIGEST = 8, 16
WORD = r"[^ \t-\r]+"
#: Depths of one run of the running sums, and conversation ids of one piece of a digest's input.
RUN, PIECE = 4096, 4096
ROOT = bytes(DIGEST)
TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]


def digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, DIGEST)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id): turns of each conversation from 1 on."""
    role, text = F.coalesce("role", F.lit("")).cast("binary"), F.coalesce("text", F.lit(""))
    words = F.unhex(F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 8, "0"))
    own = digest(F.lpad(F.hex(F.octet_length(role)), 8, "0").cast("binary"), role, text.cast("binary"))
    narrow = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", F.concat(own, words).alias("id"))
    ranked = ranked_in_ranges(cut(narrow, "turns"), ["conv_id"], ["turn", "id"], "turn_ranges", rank="at_")
    return ranked.select("conv_id", (F.col("at_") + 1).cast("long").alias("pos"), "id")


def words_of(turn_id: Column) -> Column:
    return F.conv(F.hex(F.substring(turn_id, DIGEST + 1, 4)), 16, 10).cast("long")


def rebuilt(turns: DataFrame, family: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n_turns) and their turns (conv_id, pos, id) with borrowed openings.

    Conversation c gets the first h turns of conversation c - c % family, h being the CRC-32 of
    c's decimal digits modulo ``longest``, and then its own turns after the first h.
    """
    own = cut(numbered_turns(turns), "numbered")
    sizes = cut(own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "sizes")
    head = sizes.select(F.col("conv_id").alias("head_"), F.least("n", F.lit(longest)).alias("head_n"))
    plan = cut(
        sizes.select(
            "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % family).alias("head_"),
            (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).alias("h"),
        ).join(head, "head_", "left").withColumn("m", F.least("h", F.coalesce("head_n", F.lit(0)))),
        "plan",
    )
    opening = own.where((F.col("conv_id") % family == 0) & (F.col("pos") < longest)).withColumnRenamed("conv_id", "head_")
    borrowed = plan.select("conv_id", "head_", "m").join(opening, "head_").where("pos <= m").select("conv_id", "pos", "id")
    kept = own.join(plan.select("conv_id", "h", "m"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "id"
    )
    lengths = plan.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return lengths, borrowed.unionByName(kept)


def gathered(rows: DataFrame, keys: list[str], at: Column, entry: Column) -> DataFrame:
    """Groups of eight entries at most as ``ids``, an array in order."""
    pairs = F.array_sort(F.collect_list(F.struct(at.alias("at"), entry.alias("id"))))
    return rows.groupBy(*keys).agg(F.transform(pairs, lambda p: p["id"]).alias("ids"))


def chained(level: int, before: Column, ids: Column, upto: Column | int) -> Column:
    """Key of the node after the first ``upto`` entries that follow the node ``before``."""
    parts = [F.when(F.lit(i) < upto, F.get(ids, F.lit(i))).otherwise(F.lit(b"")) for i in range(WIDTH)]
    return digest(F.lit(bytes([level])), before, *[F.coalesce(p, F.lit(b"")) for p in parts])


def joined(ids: Column) -> Column:
    return digest(F.lit(b"block"), *[F.coalesce(F.get(ids, F.lit(i)), F.lit(b"")) for i in range(WIDTH)])


def with_keys(rows: DataFrame, longest: int, level: int = 0) -> DataFrame:
    """Blocks (conv_id, n_turns, block, ids) with the keys ``before`` and ``after`` them."""
    span = WIDTH ** (level + 1)
    first = lambda df: df.withColumns({
        "before": F.lit(ROOT), "after": digest(F.lit(bytes([level + 1])), F.lit(ROOT), joined(F.col("ids")))
    })
    if longest <= span:
        return first(rows)
    long = rows.where(F.col("n_turns") > span)
    block = F.col("block")
    upper = gathered(
        long.withColumn("up_", (block / WIDTH).cast("long")), ["conv_id", "n_turns", "up_"], block, joined(F.col("ids"))
    ).withColumnRenamed("up_", "block")
    keyed = with_keys(cut(upper, f"blocks_{level + 1}"), longest, level + 1)
    i, ids = F.col("i_"), F.col("ids")
    each = keyed.withColumn("i_", F.explode(F.sequence(F.lit(0), F.size("ids") - 1))).select(
        "conv_id", (block * WIDTH + i).alias("block"),
        F.when(i == 0, F.col("before")).otherwise(chained(level + 1, F.col("before"), ids, i)).alias("before"),
        F.when(i == WIDTH - 1, F.col("after")).otherwise(chained(level + 1, F.col("before"), ids, i + 1)).alias("after"),
    )
    return first(rows.where(F.col("n_turns") <= span)).unionByName(long.join(each, ["conv_id", "block"]))


def blocks(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, base, before, t1..t8): a row for each block of a conversation, one where it has no turns.

    A full block's last column also holds the key after it.
    """
    lengths, at = cut(lengths, "lengths"), F.col("pos") - 1
    longest = lengths.agg(F.max("n_turns")).first()[0] or 0
    entries = gathered(turns.withColumn("block", (at / WIDTH).cast("long")), ["conv_id", "block"], at, F.col("id"))
    rows = cut(lengths.join(entries, "conv_id"), "blocks")
    none = lengths.where("n_turns = 0").select(
        "conv_id", "n_turns", F.lit(0).cast("long").alias("block"), F.expr("cast(array() as array<binary>)").alias("ids"),
    )
    keyed = with_keys(rows, longest).unionByName(none.withColumns({"before": F.lit(ROOT), "after": F.lit(ROOT)}))
    columns = [F.get("ids", F.lit(i)) for i in range(WIDTH)]
    columns[-1] = F.concat(columns[-1], F.col("after"))
    return keyed.select(
        "conv_id", "n_turns", (F.col("block") * WIDTH).alias("base"), "before", *[c.alias(t) for c, t in zip(columns, TURNS, strict=True)]
    )


def path_key(before: Column, turns: list[Column], upto: Column) -> Column:
    """Key of the node after the first ``upto`` of a block's columns."""
    inside = digest(F.lit(b"\0"), before, *[F.when(F.lit(i) < upto, F.coalesce(t, F.lit(b""))).otherwise(F.lit(b"")) for i, t in enumerate(turns[:-1])])
    return F.when(upto == 0, before).when(upto == WIDTH, F.substring(turns[-1], DIGEST + 5, DIGEST)).otherwise(inside)


def prefixes(rows: DataFrame, sums: str) -> DataFrame:
    """Every node once: key, parent's key, depth, words of its last text, conv_id, n_convs, n_turns
    (of its longest member), and the aggregates ``sums``."""
    grouped = rows.sparkSession.sql(
        f"""SELECT before, {", ".join(TURNS)}, {WIDTH} - bit_count(grouping_id()) AS filled, min(base) AS base,
                   min(conv_id) AS conv_id, count(*) AS n_convs, max(n_turns) AS n_turns{sums}
            FROM {{rows}} GROUP BY before, ROLLUP({", ".join(TURNS)})
            HAVING filled = 0 AND base = 0 OR {" OR ".join(f"filled = {i + 1} AND {t} IS NOT NULL" for i, t in enumerate(TURNS))}""",
        rows=rows,
    )
    turns, filled = [F.col(t) for t in TURNS], F.col("filled")
    last = F.coalesce(*reversed(turns))
    return grouped.select(
        path_key(F.col("before"), turns, filled).alias("key"),
        F.when(filled > 0, path_key(F.col("before"), turns, filled - 1)).alias("parent"),
        (F.col("base") + filled).cast("long").alias("depth"), F.coalesce(words_of(last), F.lit(0)).alias("words"),
        "conv_id", "n_convs", "n_turns", *[c for c in grouped.columns if c.startswith("sum_")],
    )


def path_sums(nodes: DataFrame) -> DataFrame:
    """(key, above): saved words of the nodes of the same conversation further up."""
    run = (F.col("depth") / RUN).cast("long")
    rows = nodes.select("key", "conv_id", "depth", run.alias("run"), "saved")
    up = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "run").agg(F.sum("saved").alias("saved_")).withColumn("before_", F.coalesce(F.sum("saved_").over(up), F.lit(0)))
    within = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(runs.drop("saved_"), ["conv_id", "run"]).select(
        "key", (F.col("before_") + F.coalesce(F.sum("saved").over(within), F.lit(0))).alias("above")
    )


def ends(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes at which conversations end.

    Ids are sorted and joined in pieces of a bounded range of ids; a node's pieces, in order, pass
    through one digest.
    """
    turns = [F.col(t) for t in TURNS]
    filled = F.col("n_turns") - F.col("base")
    pieces = (
        rows.where(filled.between(0, WIDTH) & ((filled > 0) | (F.col("n_turns") == 0)))
        .select(path_key(F.col("before"), turns, filled).alias("key"), "conv_id", F.floor(F.col("conv_id") / PIECE).alias("piece"))
        .groupBy("key", "piece").agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )

    def hashed(batches):
        key = state = None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield finished(done)
        if state is not None:
            yield finished([(key, state.hexdigest())])

    def finished(done):
        keys, texts = zip(*done, strict=True) if done else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())], names=["key", "ends_sha256"])

    ordered = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return ordered.mapInArrow(hashed, "key binary, ends_sha256 string")


def trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each prefix of conversations (conv_id, n_turns) with turns (conv_id, pos, id)."""
    laid = cut(blocks(lengths, turns), "laid")
    nodes = cut(
        prefixes(laid, "").withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("leaf", (F.col("n_turns") == F.col("depth")).cast("long")),
        "nodes",
    )
    stood = cut(nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")), "stood")
    weighed = laid.join(stood, "conv_id", "left")
    summed = prefixes(weighed, ", coalesce(sum(saved), 0) AS sum_saved, coalesce(sum(leaf), 0) AS sum_leaves")
    born = nodes.where(F.col("parent").isNotNull())
    children = born.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        summed.join(path_sums(nodes), "key").join(children, "key", "left").join(ends(laid), "key", "left").join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("sum_leaves").alias("n_leaves"), (F.col("sum_saved") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
