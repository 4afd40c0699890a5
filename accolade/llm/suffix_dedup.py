"""Removal of repeated byte strings by suffix sorting.

A byte goes if a string of ``SPAN`` bytes that covers it also starts anywhere else, in the same
text or another.  Equal strings must meet in one task without all suffixes travelling:

1. Every ``SPAN``-byte window has an anchor: among its runs of ``GRAM`` bytes the one with the
   smallest hash, the last of equals.  The anchor depends on the window's bytes alone, so equal
   windows have equal anchors at the same place.  Consecutive windows with one anchor form a
   segment of at most ``2 * SPAN - GRAM`` bytes.  Texts are reduced to (anchor hash, segment
   hash, place); anchors that occur once cannot hold a repeat and are dropped.
2. If all segments of an anchor are equal, all their windows repeat: nothing has to be sorted.
   Whole copies of a text, and the inside of long passages, end here whatever their number.
3. For anchors with different segments, one of each is fetched.  Segments are dealt by anchor
   and suffix-sorted in blocks of bounded size (``suffix_sort``): suffixes smaller than their
   successor are sorted directly, the others are induced by bucket scans, and windows whose
   common prefix with a neighbour reaches ``SPAN`` repeat.
4. An anchor with more than ``MOST_SEGMENTS`` different segments, such as the rim of a passage
   that very many texts quote, would not fit a block.  Its windows are counted by a 128-bit
   digest instead, which combines before the shuffle.  The outcome is the same.

Segment hashes are 64-bit and only compared under one 64-bit anchor hash; texts are known by their
128-bit digest, so repeated keys are told apart and copies share one result.

Defined results: a null text counts as empty; texts shorter than the span keep all; repeated
rows are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.llm.common import bounded_batches, over_batches, shuffle_partitions
from accolade.llm.suffix_sort import repeated
from accolade.sources.sinks import cut

SPAN, GRAM = 200, 64
MOST_SEGMENTS = 2048
BLOCK_BYTES = 1 << 18
#: Windows of a text handled at a time; below 2 ** 20, which is where places are packed.
STRETCH, PLACE = 1 << 18, np.uint64((1 << 20) - 1)
SEED = 5


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Anchors:
    """Cuts texts into segments of windows with one anchor."""

    def __init__(self, span: int = SPAN, gram: int = GRAM):
        self.span, self.gram = span, gram
        rng = np.random.default_rng(SEED)
        self._letter = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 256, dtype=np.uint64)
        base = int(rng.integers(1, 2**62)) * 2 + 1
        longest = STRETCH + span
        self._power, self._inverse = (self._powers(x, longest) for x in (base, pow(base, -1, 2**64)))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    def _gram_hashes(self, text: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run of ``gram`` bytes, from sums of a polynomial with an odd base."""
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self._letter[text] * self._power[:len(text)], out=sums[1:])
        n = len(text) - self.gram + 1
        return _mixed((sums[self.gram:] - sums[:n]) * self._inverse[:n])

    def segments(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, first window and number of windows of each segment, in order."""
        found, body = [], np.frombuffer(text, np.uint8)
        for at in range(0, len(body) - self.span + 1, STRETCH):
            own = body[at:at + STRETCH + self.span - 1]
            hashes, width = self._gram_hashes(own), self.span - self.gram + 1
            n = len(hashes) - width + 1
            # the smallest of each stretch of ``width`` values: of the end of one block and the start of the next
            value = (hashes & ~PLACE) | (PLACE - np.arange(len(hashes), dtype=np.uint64))
            blocks = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max, np.uint64)
            blocks[:len(value)] = value
            blocks = blocks.reshape(-1, width)
            ahead = np.minimum.accumulate(blocks, axis=1).ravel()[width - 1:width - 1 + n]
            behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
            anchor = (PLACE - (np.minimum(ahead, behind) & PLACE)).astype(np.int64)
            first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
            found.append((hashes[anchor[first]].view(np.int64), first + at, np.diff(np.append(first, n))))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _texts(docs: DataFrame, text: str, *more: str) -> DataFrame:
    """(body, text, more): the digest of each text and its bytes."""
    own = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.unhex(F.md5(own.cast("binary"))).alias("body"), own.cast("binary").alias("bytes"), *more)


def _anchors(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(anchor): one row for each segment."""

    def make():
        cutter = Anchors(span, gram)

        def step(batch):
            found = [cutter.segments(t)[0] for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.int64)]))], names=["anchor"])

        return step

    return over_batches(texts.select("bytes"), make, "anchor long")


def _places(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(anchor, segment, body, start, windows) of each segment."""

    def make():
        from xxhash import xxh3_64_intdigest

        cutter = Anchors(span, gram)

        def step(batch):
            rows = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                anchor, start, windows = cutter.segments(t)
                hashes = [xxh3_64_intdigest(t[a:a + n + span - 1]) for a, n in zip(start.tolist(), windows.tolist(), strict=True)]
                rows.append((np.full(len(start), i), anchor, np.array(hashes, np.uint64).view(np.int64), start, windows))
            index, anchor, segment, start, windows = (np.concatenate(c) for c in zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(segment), batch.column(0).take(pa.array(index.astype(np.int64))), pa.array(start.astype(np.int64)),
                 pa.array(windows.astype(np.int32))], names=["anchor", "segment", "body", "start", "windows"])

        return step

    return over_batches(texts.select("body", "bytes"), make, "anchor long, segment long, body binary, start long, windows int")


def _fetched(texts: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """(anchor, segment, own): the bytes of wanted segments (body, anchor, segment, start, windows)."""
    lists = wanted.groupBy(F.col("body").alias("of")).agg(F.collect_list(F.struct("anchor", "segment", "start", "windows")).alias("places"))
    met = texts.select("body", "bytes").join(lists, F.col("body") == F.col("of")).select("bytes", "places")

    def make():
        def step(batch):
            out: tuple[list, list, list] = ([], [], [])
            for body, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p in places:
                    out[0].append(p["anchor"])
                    out[1].append(p["segment"])
                    out[2].append(body[p["start"]:p["start"] + p["windows"] + span - 1])
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["anchor", "segment", "own"])

        return step

    every = over_batches(met, make, "anchor long, segment long, own binary")
    return every.groupBy("anchor", "segment").agg(F.first("own").alias("own"))  # copies of a text give the same


_RUNS = "anchor long, segment long, lo int, hi int"


def _runs_of(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _sorted_blocks(segments: DataFrame, span: int) -> DataFrame:
    """Runs of repeated windows in each segment, by suffix sorting the segments of an anchor."""

    def run(batches):
        held: list[tuple[int, int, bytes]] = []

        def flush():
            rows = []
            for (anchor, segment, _), marks in zip(held, repeated([h[2] for h in held], span), strict=True):
                rows += [(anchor, segment, a, b) for a, b in _runs_of(marks)]
            held.clear()
            columns = zip(*rows, strict=True) if rows else ([],) * 4
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["anchor", "segment", "lo", "hi"])

        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BLOCK_BYTES and row[0] != last:
                    yield flush()
                    size = 0
                held.append(row)
                size, last = size + len(row[2]), row[0]
        if held:
            yield flush()

    dealt = segments.repartition(shuffle_partitions(segments.sparkSession), "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, _RUNS)


def _counted_windows(segments: DataFrame, span: int) -> DataFrame:
    """The same runs, by counting a digest of every window."""

    def make():
        from xxhash import xxh3_128_digest

        def step(batch):
            rows = [
                (anchor, segment, at, xxh3_128_digest(own[at:at + span]))
                for anchor, segment, own in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for at in range(len(own) - span + 1)
            ]
            columns = zip(*rows, strict=True) if rows else ([],) * 4
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["anchor", "segment", "lo", "window"])

        return step

    windows = over_batches(segments, make, "anchor long, segment long, lo int, window binary")
    often = windows.groupBy("window").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(F.col("window").alias("again"))
    return windows.join(often, F.col("window") == F.col("again")).select("anchor", "segment", "lo", (F.col("lo") + 1).alias("hi"))


def repeats(texts: DataFrame, span: int = SPAN, gram: int = GRAM, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(body, lo, hi): for each text, runs [lo, hi) of starts of repeated windows; they may overlap."""
    often = _anchors(texts, span, gram).groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    often = cut(often.select(F.col("anchor").alias("again")), "often")  # a join side of its own, so that Spark can split hot anchors
    places = cut(_places(texts, span, gram).join(often, F.col("anchor") == F.col("again")).drop("again"), "places")
    kinds = places.groupBy("anchor").agg((F.min("segment") != F.max("segment")).alias("mixed"))
    kinds = cut(kinds.where("mixed").select(F.col("anchor").alias("of")), "mixed")
    mixed = cut(places.join(kinds, F.col("anchor") == F.col("of")).drop("of"), "mixed_places")
    alike = places.join(kinds, F.col("anchor") == F.col("of"), "left_anti")

    each = cut(mixed.groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("body", "start", "windows")).alias("first")), "segments")
    wanted = each.select("anchor", "segment", "first.*")
    segments = cut(_fetched(texts, wanted, span), "segment_bytes")
    wide = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("different")).where(F.col("different") > most_segments)
    wide = cut(wide.select(F.col("anchor").alias("of")), "wide")
    narrow = segments.join(wide, F.col("anchor") == F.col("of"), "left_anti")
    runs = _sorted_blocks(narrow, span)
    if not wide.isEmpty():
        runs = runs.unionByName(_counted_windows(segments.join(wide, F.col("anchor") == F.col("of")).drop("of"), span))
    runs = cut(runs, "runs").select(F.col("anchor").alias("a"), F.col("segment").alias("s"), "lo", "hi")
    whole = each.where("times > 1").select(F.col("anchor").alias("a"), F.col("segment").alias("s"), F.lit(0).alias("lo"), F.col("first.windows").alias("hi"))

    found = mixed.join(runs.unionByName(whole), (F.col("anchor") == F.col("a")) & (F.col("segment") == F.col("s")))
    found = found.select("body", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    return found.unionByName(alike.select("body", F.col("start").alias("lo"), (F.col("start") + F.col("windows")).alias("hi"))).distinct()


def remaining(text: bytes, runs: list[tuple[int, int]], span: int) -> tuple[bytes, int]:
    """What is left when every byte of the windows that start in ``runs`` goes; the maximal gaps."""
    kept, at, gaps = [], 0, 0
    reach = -1
    for lo, hi in sorted(runs):
        if lo > reach:
            kept.append(text[at:lo])
            gaps += 1
        reach = max(reach, hi - 1 + span)
        at = reach
    return b"".join(kept) + text[max(at, 0):], gaps


def dedup(
    docs: DataFrame, text: str = "text", span: int = SPAN, gram: int = GRAM, most_segments: int = MOST_SEGMENTS,
    as_text: bool = False,
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``kept_`` (remaining bytes), ``bytes_`` and ``spans_``.

    ``as_text`` gives the remaining bytes as the text instead, without the parts of letters that
    cuts have left.
    """
    bounded_batches(docs.sparkSession)
    passed = [f"column{i}" for i, _ in enumerate(docs.columns)]  # names that cannot clash
    inner = docs.toDF(*passed)
    others = [p for p, c in zip(passed, docs.columns, strict=True) if c != text]
    own = passed[docs.columns.index(text)]
    found = repeats(_texts(inner, own), span, gram, most_segments)
    lists = found.groupBy(F.col("body").alias("of")).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    met = _texts(inner, own, *others).join(lists, F.col("body") == F.col("of"), "left")
    kinds = {f.name: f.dataType.simpleString() for f in inner.schema}

    def make():
        def step(batch):
            results = [
                remaining(body, [(r["lo"], r["hi"]) for r in runs or ()], span)
                for body, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            sizes = pa.array([len(b) for b in batch.column(0).to_pylist()], pa.int64())
            return pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array([k.decode("utf-8", "ignore") if as_text else k for k, _ in results]), sizes, pa.array([g for _, g in results], pa.int64())],
                names=[*others, "kept_", "bytes_", "spans_"])

        return step

    schema = ", ".join([*(f"{p} {kinds[p]}" for p in others), f"kept_ {'string' if as_text else 'binary'}, bytes_ long, spans_ long"])
    out = over_batches(met.select("bytes", "runs", *others), make, schema)
    if as_text:
        return out.select(*[F.col("kept_" if c == text else p).alias(c) for p, c in zip(passed, docs.columns, strict=True)])
    names = [F.col(p).alias(c) for p, c in zip(passed, docs.columns, strict=True) if c != text]
    return out.select(*names, "kept_", "bytes_", "spans_")

