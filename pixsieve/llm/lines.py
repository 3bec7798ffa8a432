"""Boilerplate lines by their frequency inside a site.

Pages are grouped by host. A line's ratio is the number of the host's pages that contain it, divided
by the host's pages; lines above ``ratio`` are boilerplate there and are dropped from all its
pages. Pages of a host with the same text count as one page, so copies of an article do not
turn the article into boilerplate. A line also needs ``least`` pages: a host with fewer keeps all its lines,
since a share of so few pages says nothing.

Lines end at ``\\n`` and are compared trimmed of blanks and tabs; blank lines are kept as they are.
Frequencies are counted per (host, 128-bit hash of the line), so no text is shuffled to find them, and a
line of many pages is summed map-side. The boilerplate of a host has fewer lines than a page has on
average divided by ``ratio``; it is joined to the pages by host, broadcast by Spark when its table
is small and otherwise as a shuffle join whose hot hosts the adaptive skew join splits.

Edge cases: a null text has no lines and stays null, an empty one stays empty; a null host is a
host of its own; a line repeated inside one page counts once; empty tables give empty results;
other columns pass through, in ``without_boilerplate`` also those that are called like the counts of ``drop_boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixsieve.llm.columns import unused
from pixsieve.session import write_table

RATIO = 0.02
LEAST_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(_trimmed(line)))


def boilerplate(pages: DataFrame, host: str, text: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """(host, line_keys): the keys of each host's boilerplate lines; hosts without any are absent."""
    counted = pages.filter(F.col(text).isNotNull()).select(F.col(host).alias("host"), F.unhex(F.md5(text)).alias("page"), F.col(text).alias("text"))
    totals = counted.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: _trimmed(x) != ""), _line_key))
    seen = counted.select("host", "page", F.explode(keys).alias("line_key")).distinct()
    frequent = seen.groupBy("host", "line_key").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    same_host = frequent["host"].eqNullSafe(totals["host"])
    return (
        frequent.join(totals, same_host)
        .filter(F.col("n") > ratio * F.col("pages"))
        .groupBy(frequent["host"].alias("host")).agg(F.collect_list("line_key").alias("line_keys"))
    )


def drop_boilerplate(
    pages: DataFrame, host: str, text: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES, into: tuple[str, str] = ("n_lines", "n_dropped")
) -> DataFrame:
    """``pages`` with boilerplate lines gone from ``text``, plus the numbers of lines and of dropped ones in the columns ``into``."""
    own = [c for c in pages.columns if c not in into]
    at, keys, kept_lines = unused([*pages.columns, *into], "host_of_keys", "line_keys", "kept")
    drop = write_table(boilerplate(pages, host, text, ratio, least), "boilerplate").select(F.col("host").alias(at), F.col("line_keys").alias(keys))
    lines = _lines(F.col(text))
    joined = pages.join(drop, F.col(host).eqNullSafe(F.col(at)), "left")
    kept = F.filter(lines, lambda x: ~F.array_contains(keys, _line_key(x)))
    split = joined.withColumn(kept_lines, F.when(F.col(keys).isNull(), lines).otherwise(kept))
    n, left = F.coalesce(F.size(lines), F.lit(0)), F.coalesce(F.size(kept_lines), F.lit(0))
    counts = [F.when(F.col(text).isNull(), 0).otherwise(c).cast("long").alias(name) for c, name in zip((n, n - left), into, strict=True)]
    return split.select(*[F.array_join(kept_lines, "\n").alias(c) if c == text else F.col(c) for c in own], *counts)


def without_boilerplate(docs: DataFrame, host: str) -> DataFrame:
    """Documents with boilerplate lines gone and ``n_chars`` of what is left; those that had nothing else go too."""
    into = tuple(unused(docs.columns, "n_lines", "n_dropped"))
    cleaned = drop_boilerplate(docs, host, into=into)
    emptied = (F.col(into[1]) > 0) & (F.trim("text", F.lit(" \t\r\n")) == "")
    return cleaned.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
