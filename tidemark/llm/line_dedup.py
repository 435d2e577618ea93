"""Boilerplate lines, dropped by how many pages of their own site carry them.

Method: site-relative frequency. Within a host, the pages that contain a line are counted
and divided by the host's pages; a line above `ratio` that stands on `min_pages` pages or
more is boilerplate there, and every copy of it on that host goes. The same line may stay
on another host. DataFrame functions only.

Each page gives each of its distinct lines once, so the counts combine before the
shuffle and a line on a third of all pages is one row per task. A host has at most
(distinct lines per page / ratio) boilerplate lines, as each takes more than `ratio` of
the host's pages, so the list that is joined back is small for a host of any size. The
lists are written to the shared folder and counted: up to BROADCAST_LINES of all hosts
together they are broadcast and no text is shuffled; beyond that both sides shuffle and
the adaptive planner splits a hot host. Lines are counted by 96 bits of two
hashes; nothing but these and the host is shuffled.

A line is what stands between line feeds, with blanks, tabs and carriage returns trimmed
at both ends for comparison; lines that are empty then are never dropped.

Edge cases: null text stays null and counts as a page without lines; an empty text stays
empty; a text of boilerplate only becomes empty; null hosts are one host; each row is a
page, so a repeated row counts again; an empty table gives no rows. Columns of any other
name pass through. With `copies=False` the pages of a host that have the same text count
as one page, so that a document is not taken for boilerplate because it is copied; the
lines that rows make common are then counted again by the hash of their page's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import store

RATIO = 0.1
MIN_PAGES = 5
BROADCAST_LINES = 500_000  # of 12 bytes each


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line, F.lit("line")).alias("b"))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    broadcast_lines: int = BROADCAST_LINES,
    copies: bool = True,
) -> DataFrame:
    """`host`, `pages` and `lines`, the keys of the boilerplate, of each host that has any."""
    page = docs.select(F.col(host).alias("host"), F.col(text).alias("text"), F.xxhash64(text).alias("page"))
    of_host = page.select("host", "page")
    totals = (of_host if copies else of_host.distinct()).groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = F.array_distinct(F.transform(F.split("text", "\n"), lambda x: _trimmed(x)))
    keys = (
        page.select("host", "page", F.explode(lines).alias("line"))
        .where(F.col("line") != "")
        .select("host", "page", _key(F.col("line")).alias("key"))
    )

    def common(given: DataFrame) -> DataFrame:
        return (
            given.groupBy("host", "key")
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_pages)
            .join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
            .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        )

    found = common(keys)
    if not copies:
        # a line has no more texts than rows, so only these lines are counted by text
        some = store(found.select(F.col("host").alias("of"), F.col("key").alias("line")), "lines")
        some = F.broadcast(some) if some.count() <= broadcast_lines else some
        same = F.col("host").eqNullSafe(F.col("of")) & (F.col("key") == F.col("line"))
        found = common(keys.join(some, same).select("host", "page", "key").distinct())
    return found.groupBy("host").agg(F.max("pages").alias("pages"), F.collect_list("key").alias("lines"))


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    broadcast_lines: int = BROADCAST_LINES,
    copies: bool = True,
) -> DataFrame:
    """`row` (a struct of all columns), `text` without boilerplate lines, `n_lines` of the
    text as given and `n_dropped`, of every row."""
    found = store(
        boilerplate(docs, host, text, ratio, min_pages, broadcast_lines, copies).select(F.col("host").alias("of"), "lines"), "lines"
    )
    held = found.agg(F.sum(F.size("lines"))).first()[0] or 0
    if held <= broadcast_lines:
        found = F.broadcast(found)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[host].alias("host"), docs[text].alias("whole")
    )
    split = F.split("whole", "\n")
    kept = F.filter(split, lambda x: ~F.array_contains(F.col("lines"), _key(_trimmed(x))))
    given = F.when(F.length("whole") > 0, F.size(split)).otherwise(0)
    return (
        rows.join(found, F.col("host").eqNullSafe(F.col("of")), "left")
        .withColumn("kept", F.when(F.col("lines").isNotNull() & F.col("whole").isNotNull(), kept))
        .select(
            "row",
            F.when(F.col("kept").isNull(), F.col("whole")).otherwise(F.array_join("kept", "\n")).alias("text"),
            given.cast("bigint").alias("n_lines"),
            F.when(F.col("kept").isNull(), F.lit(0))
            .otherwise(F.size(split) - F.size("kept"))
            .cast("bigint")
            .alias("n_dropped"),
        )
    )
