"""Audit of how filters interact: every order of the five filters, from contingency counts.

A document's five verdicts are one of 2^5 cells, so a part of the corpus (a language) is three
tensors of shape 2x2x2x2x2: documents, good ones and toxic ones.  Whatever a step of an order
removes is a contraction of such a tensor: each axis is contracted with a selector that picks
pass (filters before the step), fail (the step's own) or all (filters after it).  One einsum per
measure does that for the 600 steps of the 120 orders at once.

In Spark: one scan reduces a text to its digest and four verdicts, which are written; the fifth
verdict (a copy of an earlier text) needs the smallest id of each digest, found by an aggregate
and brought back by a join on digest and id, a key that copies do not share.  Cells are counted
before the exchange, so a part reaches its task as 32 rows at most per input split's sum.

Defined results: null texts are empty; an empty text fails A alone, and E if an earlier one is
empty too; a null language is the part of the empty name; of repeated rows of one id and text
none is later than the other; a null id is neither earlier nor later than any; several labels
of one id count as good (toxic) if any is; labels without a document and documents without
a label count nowhere; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade.sources.sinks import cut

FILTERS = "ABCDE"
#: White space that parts words.
SPACE = r"[ \t-\r]+"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
PASS, FAIL, ALL = 0, 1, 2
#: What a selector picks of an axis (passed, failed).
PICKS = np.array([[1, 0], [0, 1], [1, 1]], dtype=np.int64)
MEASURES = ("n", "good", "toxic")
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_verdicts(body: Column) -> dict[str, Column]:
    """The four verdicts that need the text alone; true is a failure."""
    words = F.array_remove(F.split(body, SPACE), "")
    capitals = F.length(body) - F.length(F.regexp_replace(body, "[A-Z]", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(body),
        "D": body.rlike("[#$%&*|]"),
    }


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id_, part_, A, B, C, D, E) of each row; true is a failure."""
    body = F.coalesce(F.col(text), F.lit(""))
    seen = docs.select(F.col(key).alias("id_"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part_"), body.alias("body_"))
    rows = cut(
        seen.select("id_", "part_", F.unhex(F.sha2("body_", 256)).alias("digest_"), *[c.alias(f) for f, c in text_verdicts(F.col("body_")).items()]),
        "verdicts",
    )
    firsts = rows.groupBy("digest_").agg(F.min("id_").alias("id_")).withColumn("first_", F.lit(True))
    later = F.col("first_").isNull() & F.col("id_").isNotNull()
    return rows.join(firsts, ["digest_", "id_"], "left").select("id_", "part_", *"ABCD", later.alias("E"))


def cells(judged: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part_, A..E, n, good, toxic): documents of each combination of verdicts.

    Labelled documents are matched apart from the counting of all, so rows without an id or a
    label pass no join.
    """
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id_")).agg(flag("quality"), flag("toxic"))
    keys = ["part_", *FILTERS]
    every = judged.select(*keys, F.lit(1).alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    marked = judged.join(known.where("quality = 1 OR toxic = 1"), "id_").select(
        *keys, F.lit(0).alias("n"), F.col("quality").alias("good"), "toxic"
    )
    return every.unionAll(marked).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def steps() -> tuple[list[str], np.ndarray, np.ndarray]:
    """Orders, the own filter of each of their steps, and the selector of every filter at it."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    own = np.array([[FILTERS.index(f) for f in o] for o in orders]).ravel()
    picks = np.full((len(own), len(FILTERS)), ALL)
    for at in range(len(own)):
        before = own[at - at % len(FILTERS):at]
        picks[at, before] = PASS
        picks[at, own[at]] = FAIL
    return orders, own, picks


def contract(tensor: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Counts (measure, selection) of a (measure, 2, 2, 2, 2, 2) tensor under rows of selectors."""
    a, b, c, d, e = (PICKS[picks[:, axis]] for axis in range(len(FILTERS)))
    return np.einsum("mabcde,na,nb,nc,nd,ne->mn", tensor, a, b, c, d, e, optimize="greedy")


def audited(part: str, rows: pd.DataFrame) -> pd.DataFrame:
    """All steps of all orders of one part from its cells."""
    tensor = np.zeros((len(MEASURES), *[2] * len(FILTERS)), dtype=np.int64)
    at = tuple(rows[f].to_numpy(dtype=np.int64) for f in FILTERS)
    for m, name in enumerate(MEASURES):
        tensor[(m, *at)] = rows[name].to_numpy(dtype=np.int64)
    orders, own, picks = steps()
    removed, good, toxic = contract(tensor, picks)
    passed = np.where(picks == FAIL, PASS, picks)
    width = np.arange(len(FILTERS))
    fails = contract(tensor, np.where(width[:, None] == width, FAIL, ALL))[0]
    alone = contract(tensor, np.where(width[:, None] == width, FAIL, PASS))[0]
    shapley = np.array([removed[own == f].sum() for f in width])
    return pd.DataFrame({
        "part": part, "filter_order": np.repeat(orders, len(FILTERS)), "step": (np.arange(len(own)) % len(FILTERS) + 1).astype("int32"),
        "kept": contract(tensor, passed)[0], "removed": removed, "redundant": fails[own] - removed, "unique_fails": alone[own],
        "good_lost": good, "toxic_lost": toxic, "shapley": shapley[own],
    })


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row for each part, order of the filters, and step."""
    counted = cells(verdicts(docs, key, text, part), labels, key)
    return counted.groupBy("part_").applyInPandas(lambda name, rows: audited(name[0], rows), RESULT)
