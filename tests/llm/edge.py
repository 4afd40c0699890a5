"""Rows that every operator must take: nulls, empty and long texts, ties, clashing columns."""

from __future__ import annotations

LONG = "wide river stone " * 4000
EDGE = [
    (1, "one two three four five six seven", "en", "a"), (1, "one two three four five six seven", "en", "a"),
    (2, "one two three four five six seven", "en", "b"), (3, "", "en", "a"), (4, None, "en", None), (None, "word", None, "a"),
    (None, None, None, None), (5, LONG, "de", "b"), (6, LONG + "end", "de", "b"), (7, " \n\t ", "fr", ""),
    (8, "Ünïcödé — 漢字 🙂 it's <|endoftext|> é Σς İ", "fr", "c"), (1, "another text under the first id", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def edge_docs(spark):
    """The rows with columns whose names clash with those the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA)
    clash = ("key", "h", "line", "site", "size", "rank_", "length", "start", "shard", "count", "n", "text_crc32", "doc", "bad_")
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()
