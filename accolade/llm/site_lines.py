"""Line dedup by site-relative frequency.

A line is boilerplate of a site when the share of the site's pages that contain it exceeds a
ratio, and at least ``least_pages`` pages do, so that small sites keep their lines.  A line is
compared without white space at its ends; blank lines are kept and never counted.  With ``once``
each distinct text of a site is one page, in both counts, so that copies of a page do not make its
own lines boilerplate; they are told apart by an aggregate over (site, text), which combines
copies before the shuffle.

Pages count a line once, and (site, line) counts combine before the shuffle, so a hot site or a
hot line arrives as one row a task.  A site has at most (lines of an average page) / ratio
boilerplate lines, whatever its number of pages; they are gathered into one row for each site,
which pages join on the site.  Spark splits the page side of a hot site, whose other side is
one row.  Texts pass one shuffle, or none where Spark finds the sites small enough to broadcast.

Defined results: a null text stays null and counts as a page; pages without a site (null) form
a site; repeated rows and keys are pages of their own (with ``once``, if their texts differ); an empty table gives an empty result;
all further columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO, LEAST_PAGES = 0.01, 5


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r\n"))


def boilerplate(
    pages: DataFrame, site: str | Column = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES,
    once: bool = False,
) -> DataFrame:
    """Lines to drop: (site, line, pages, site_pages, share)."""
    own = F.col(site) if isinstance(site, str) else site
    rows = pages.select(own.alias("site"), F.col(text).alias("text"))
    rows = rows.distinct() if once else rows
    each = rows.select(
        "site", F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), _key))).alias("line")
    ).where(F.col("line") != "")
    counts = each.groupBy("site", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    totals = rows.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages")).withColumnRenamed("site", "of_site")
    share = F.col("pages").cast("double") / F.col("site_pages")
    return (
        counts.join(totals, F.col("site").eqNullSafe(F.col("of_site"))).drop("of_site")
        .withColumn("share", share).where(F.col("share") > ratio)
    )


def drop_lines(
    pages: DataFrame, site: str | Column = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES,
    once: bool = False,
) -> DataFrame:
    """All pages without their boilerplate lines.

    Adds ``lines_`` and ``dropped_``, the numbers of lines before and of lines dropped.
    """
    own = F.col(site) if isinstance(site, str) else site
    bad = boilerplate(pages, site, text, ratio, least_pages, once).groupBy("site").agg(F.collect_set("line").alias("bad"))
    passed = [f"column{i}" for i, _ in enumerate(pages.columns)]  # names that cannot clash
    inner = pages.select(
        *[F.col(c).alias(p) for c, p in zip(pages.columns, passed, strict=True)], own.alias("site"),
        lines_of(F.col(text)).alias("lines"),
    )
    joined = inner.join(bad.withColumnRenamed("site", "bad_site"), F.col("site").eqNullSafe(F.col("bad_site")), "left")
    known = F.coalesce(F.col("bad"), F.array().cast("array<string>"))
    kept = joined.withColumn("kept", F.filter("lines", lambda x: ~F.array_contains(known, _key(x))))
    return kept.select(
        *[(F.array_join("kept", "\n") if c == text else F.col(p)).alias(c) for c, p in zip(pages.columns, passed, strict=True)],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("lines_"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("dropped_"),
    )
