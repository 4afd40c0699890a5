"""From raw documents to packed sequences, in stages that each work on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to
the shared folder and read back as the next stage's documents.  All but the last return the
columns of ``documents``, with ``n_chars`` as the text now is.

* toxicity: documents that the factorization machine scores 0.3 or more go.
* line dedup: lines that more than 1 % of a source's documents hold go; documents stay.
* near dedup: of each group of near duplicates the one with the smallest id stays.
* suffix-array dedup: bytes of strings of 200 bytes that also start elsewhere go, every
  occurrence; documents stay, and halves of letters at the cuts go as well.
* packing: whole texts become pieces in sequences of 4096 tokens.

Null texts stay null up to the suffix stage and are empty from there on; empty tables pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accolade.llm import minmax_dedup, packing, site_lines, suffix_dedup, toxicity
from accolade.llm.common import read
from accolade.sources.sinks import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _documents(df: DataFrame) -> DataFrame:
    counted = F.length("text").cast(dict(df.dtypes).get("n_chars", "bigint"))
    return df.select(*[counted.alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), machine)
    return scored.where(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(site_lines.drop_lines(docs.select(*COLUMNS), site="source", once=True))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax_dedup.keep_one(docs.select(*COLUMNS))


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(suffix_dedup.dedup(docs.select(*COLUMNS), as_text=True))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_site_lines), ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_strings), ("packing", pack_sequences),
]

#: The machine of the first stage is fitted by gradient steps, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
