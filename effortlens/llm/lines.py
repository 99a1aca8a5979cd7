"""Line dedup by site-relative frequency, in DataFrame functions only.

A host's boilerplate is every line that stands on more than ``ratio`` of the host's pages
(and on at least ``min_pages`` of them). Lines are compared without surrounding blanks, by a
64-bit hash inside one host; a page counts a line once. Counts are summed before the shuffle,
so a hot host or line costs one row per task. A host has fewer than (lines per page / ratio)
such lines, so they travel as one small array per host, and a page drops its lines in place:
the page text itself is never exploded.

Defined results: a null text stays null and counts as a page without lines; blank lines are
kept and never counted; null hosts are one host; repeated rows are pages of their own; an
empty table gives an empty result; a text whose lines all go becomes empty. The input's
columns keep their names and order whatever these are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from effortlens.llm.storage import written

RATIO = 0.1
MIN_PAGES = 3


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``host`` and the sorted hashes of its boilerplate ``lines``, for hosts that have any."""
    pages = docs.select(
        F.col(host).alias("host"),
        F.array_distinct(
            F.transform(
                F.filter(F.split(F.col(text), "\n"), lambda x: _bare(x) != ""),
                lambda x: F.xxhash64(_bare(x)),
            )
        ).alias("lines"),
    )
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = (
        pages.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
        .withColumnRenamed("host", "line_host")
    )
    return (
        counts.join(totals, F.col("line_host").eqNullSafe(F.col("host")))
        .filter(F.col("n") > F.col("pages") * F.lit(ratio))
        .groupBy("host")
        .agg(F.array_sort(F.collect_set("line")).alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Rows as ``row``, with the cleaned text and the numbers of lines and of dropped lines."""
    known = written(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(known, F.col(f"row.`{host}`").eqNullSafe(F.col("host")), "left")
    lines = F.split(F.col(f"row.`{text}`"), "\n")
    kept = F.filter(
        lines, lambda x: (_bare(x) == "") | ~F.array_contains("lines", F.xxhash64(_bare(x)))
    )
    return joined.select(
        "row",
        F.when(F.col("lines").isNull(), lines).otherwise(kept).alias("kept"),
        F.coalesce(F.size(lines), F.lit(0)).alias("all"),
    ).select(
        "row",
        F.array_join("kept", "\n").alias("cleaned"),
        F.when(F.col("kept").isNull(), 0).otherwise(F.col("all")).alias("n_lines"),
        F.when(F.col("kept").isNull(), 0)
        .otherwise(F.col("all") - F.size("kept"))
        .alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text", **how) -> DataFrame:
    """The same rows and columns, with boilerplate lines gone from ``text``."""
    cleaned = drop_boilerplate(docs, host, text, **how)
    return cleaned.select(
        *[
            F.col("cleaned").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
