"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its lower-cased words and of their beginnings of 4 to 8 letters, each hashed
to 32 bits; beginnings make inflected and compounded forms share terms.  The machine has a
weight for each term it keeps and a vector of ``FACTORS`` numbers whose inner products weigh
every pair of terms in a text, so a pair can count more or less than its two terms do alone.

Training uses labelled rows up to ``most_rows``, those with the smallest hash of their id, as
the documented bound.  Spark counts terms by label; up to ``most_terms`` terms are kept, those
whose log-likelihood ratio is largest and beyond chance, and only kept terms of the sample reach the driver, where the
machine is fitted by gradient steps in a fixed order.  Scoring passes over whole texts in one
scan without a shuffle.

Defined results: null and empty texts have no terms and get the machine's base score; without
labelled rows of both classes every score is the smoothed share of toxic rows; a null key counts
as an empty one; repeated labels of a key count once, as toxic if any is; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade.llm.common import bounded_batches, over_batches

FACTORS = 8
MOST_ROWS, MOST_TERMS, LEAST_TEXTS = 20_000, 4096, 4
BEGINNINGS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
#: Most words whose kept terms a task keeps at hand.
WORDS_KEPT = 500_000
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 256, 0.02, 2e-4, 11


def words(text: str | None) -> set[str]:
    return set(re.findall(r"\w+", text.lower())) if text else set()


def word_terms(word: str) -> list[int]:
    from xxhash import xxh32_intdigest

    own = [xxh32_intdigest(word)]
    return own + [xxh32_intdigest(word[:n], seed=n) for n in BEGINNINGS if len(word) >= n]


@dataclass(frozen=True)
class Machine:
    """Kept terms in ascending order with their weights and factors."""

    terms: np.ndarray
    base: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, kept: np.ndarray) -> float:
        """From places of kept terms, each once."""
        own = self.factors[kept]
        pairs = 0.5 * float((own.sum(axis=0) ** 2 - (own**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.base + self.weights[kept].sum() + pairs, -40, 40))))


def fit(terms: np.ndarray, texts: list[np.ndarray], toxic: np.ndarray) -> Machine:
    """Gradient steps (Adam) on the logistic loss; ``texts`` hold places in ``terms``."""
    share = (toxic.sum() + 0.5) / (len(toxic) + 10)
    base = float(np.log(share / (1 - share)))
    n = len(terms)
    rng = np.random.default_rng(SEED)
    table = np.concatenate([np.zeros((n, 1)), rng.normal(0, 0.01, (n, FACTORS))], axis=1).astype(np.float32)
    if not n or not 0 < toxic.sum() < len(toxic):
        return Machine(terms, base, np.zeros(n), np.zeros((n, FACTORS)))
    bias, mean, square, step = np.float32(base), np.zeros((n + 1, FACTORS + 1), np.float32), np.zeros((n + 1, FACTORS + 1), np.float32), 0
    for _ in range(max(EPOCHS, min(400, 60_000 // len(texts)))):
        order = rng.permutation(len(texts))
        for at in range(0, len(texts), BATCH):
            some = order[at:at + BATCH]
            x = np.zeros((len(some), n), np.float32)
            for row, i in enumerate(some):
                x[row, texts[i]] = 1
            v = table[:, 1:]
            sums = x @ v
            z = bias + x @ table[:, 0] + 0.5 * ((sums**2).sum(axis=1) - x @ (v**2).sum(axis=1))
            gap = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic[some]).astype(np.float32) / len(some)
            linear = x.T @ gap
            slope = np.zeros_like(mean)
            slope[:n, 0], slope[:n, 1:] = linear, x.T @ (gap[:, None] * sums) - v * linear[:, None]
            slope[:n] += DECAY * table
            slope[n, 0] = gap.sum()
            step += 1
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope**2
            move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            table -= move[:n]
            bias -= move[n, 0]
    return Machine(terms, float(bias), table[:, 0].astype(float), table[:, 1:].astype(float))


def fold(key: Column) -> Column:
    """crc32 of the key's text, modulo 4; fold 2 is held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def sample(labels: DataFrame, key: str, label: str, most_rows: int) -> DataFrame:
    """Up to ``most_rows`` labelled keys outside the held-out fold: (key, toxic)."""
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold(F.col(key)) != 2))
    once = rows.groupBy(F.col(key).alias("labelled")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    return once.orderBy(F.xxhash64("labelled"), "labelled").limit(most_rows)


def _counts(texts: DataFrame) -> DataFrame:
    """(term, toxic texts, texts) of the sample, combined in each task before the shuffle."""

    def count(batches):
        for batch in batches:
            own = [np.unique([t for w in words(text) for t in word_terms(w)]) for text in batch.column(0).to_pylist()]
            flags = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), [len(t) for t in own])
            every, at = np.unique(np.concatenate([*own, np.array([])]).astype(np.int64), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(every), pa.array(np.bincount(at, flags, len(every)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(every)))],
                names=["term", "toxic", "texts"])

    partial = texts.select("text", "toxic").mapInArrow(count, "term long, toxic long, texts long")
    return partial.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"))


def _ratio(toxic: Column, texts: Column, all_toxic: int, all_texts: int) -> Column:
    """Log-likelihood ratio of a term's two by two table; it holds for rare terms too."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    cells = [(toxic, all_toxic * texts), (texts - toxic, (all_texts - all_toxic) * texts),
             (F.lit(all_toxic) - toxic, all_toxic * (F.lit(all_texts) - texts)),
             (F.lit(all_texts - all_toxic) - texts + toxic, (all_texts - all_toxic) * (F.lit(all_texts) - texts))]
    return sum((part(seen, of.cast("double") / all_texts) for seen, of in cells), F.lit(0.0))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    most_rows: int = MOST_ROWS, most_terms: int = MOST_TERMS,
) -> Machine:
    """A machine fitted to labelled texts outside the held-out fold."""
    bounded_batches(docs.sparkSession)
    chosen = sample(labels, key, label, most_rows)
    # at most most_rows rows of a key and a flag
    texts = docs.select(F.col(key).alias("own"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("own") == F.col("labelled"))
    texts = texts.select("text", "toxic")
    n, toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counted = _counts(texts).where((F.col("texts") >= LEAST_TEXTS) & (F.col("texts") < n))
    told = counted.withColumn("told", _ratio(F.col("toxic"), F.col("texts"), toxic, n))
    limit = 2 * math.log(max(2, counted.count()))  # what chance alone reaches for about one of so many terms
    best = told.where(F.col("told") > limit).orderBy(F.desc("told"), "term").select("term").limit(most_terms)
    terms = np.sort(np.array([r["term"] for r in best.collect()], np.int64))
    kept = texts.select("text", "toxic")

    def make():
        place = _places(terms)

        def step(batch):
            rows = [np.array(sorted(place(t)), "<i4").tobytes() for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1).cast(pa.int32())], names=["kept", "toxic"])

        return step

    rows = sorted(map(tuple, over_batches(kept, make, "kept binary, toxic int").collect()))  # one order, whatever the partitions
    return fit(terms, [np.frombuffer(r[0], "<i4") for r in rows], np.array([r[1] for r in rows], float))


def _places(terms: np.ndarray):
    """For a text, the set of places of its kept terms."""
    index = {t: i for i, t in enumerate(terms.tolist())}
    known: dict[str, tuple[int, ...]] = {}

    def of(word: str) -> tuple[int, ...]:
        if len(known) >= WORDS_KEPT:
            known.clear()
        found = known[word] = tuple(index[t] for t in word_terms(word) if t in index)
        return found

    def place(text: str | None) -> set[int]:
        own, out = words(text), set()
        for word in own:
            found = known.get(word)
            if found is None:
                found = of(word)
            if found:
                out.update(found)
        return out

    return place


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``toxicity``, from 0 to 1; ``key`` is not an input."""
    bounded_batches(docs.sparkSession)
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())])
    body = docs.columns.index(text)

    def make():
        place = _places(machine.terms)

        def step(batch):
            scores = [machine.score(np.array(sorted(place(t)), np.int64)) for t in batch.column(body).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "toxicity"])

        return step

    return over_batches(docs, make, schema)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) of every document."""
    found = score(docs.select(F.col(key).alias("own"), F.col(text).alias("text")), train(docs, labels, key, text))
    return found.select(
        F.col("own").alias(key), (fold(F.col("own")) == 2).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= threshold).cast("int").alias("predicted"),
    )
