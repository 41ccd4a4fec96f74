"""Line deduplication by site-relative frequency.

The lines of a page are the visible pieces of text between its tags. For every host and line the pages that contain
the line are counted and divided by the host's pages; lines above the boilerplate ratio are dropped from all pages of
the host. A page counts a line once, in its own row, and counts are summed before the shuffle, so neither a large host
nor a line of all its pages meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bowline.llm.common import join_split_hot, unused
from bowline.staging import stage

RATIO = 0.2
MIN_PAGES = 3  # pages that must have a line before it can be boilerplate

# What is not text of a page, and where lines end.
HIDDEN = r"(?is)<!--.*?-->|<(script|style|head|template)\b.*?</\1\s*>"
TAG = r"(?s)<[^>]*>"


def host_of(url: Column) -> Column:
    """The host in lower case without its port, or the empty string."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.lower(host)


def lines_of(html: Column) -> Column:
    """The lines of a page: hidden parts go, tags and line feeds end lines, white space is folded."""
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    lines = F.split(F.regexp_replace(shown, TAG, "\n"), "\n")
    folded = F.transform(lines, lambda line: F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))
    return F.filter(folded, lambda line: line != "")


def keys_of(lines: Column) -> Column:
    """Two hashes of each line, 128 bits in all, stand for it."""
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2")))


def boilerplate(lines: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, h1, h2, pages): lines that more than ``ratio`` of the host's pages contain, and not fewer than
    ``min_pages`` pages. ``lines`` has a row per page: host, lines."""
    hosts = lines.groupBy("host").agg(F.count("*").alias("host_pages"))
    each = lines.select("host", F.inline(keys_of(F.array_distinct("lines"))))
    counted = each.groupBy("host", "h1", "h2").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    # A host of 1/1000 of all pages or more is large in lines too: its row goes to all tasks, its lines stay spread.
    joined = join_split_hot(counted, hosts, ["host"], "host_pages", lines.count())
    return joined.filter(F.col("pages") > F.col("host_pages") * ratio).select("host", "h1", "h2", "pages")


def drop_boilerplate(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """``pages`` with ``host``, ``clean_text`` (the lines that stay, by line feeds), ``n_lines`` and ``n_dropped``.

    ``keep``: the columns of ``pages`` in the result, all of them by default. A new column whose name is taken gets
    underscores. Pages without a host share the empty one. A null page has no lines and stays with an empty text.
    Repeated rows count as pages of their own; a line that a page repeats counts once and goes or stays as a whole.
    An empty table gives no rows.
    """
    kept = [F.col(f"`{c}`") for c in (pages.columns if keep is None else keep)]
    names = unused(pages.select(*kept), "host", "clean_text", "n_lines", "n_dropped")
    lines = stage(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*kept).alias("page"),
            host_of(F.col(url)).alias("host"),
            lines_of(F.col(html)).alias("lines"),
        ),
        "page-lines",
    )
    drop = stage(boilerplate(lines, ratio, min_pages), "boilerplate")
    total = lines.agg(F.sum(F.size("lines"))).first()[0] or 0
    each = lines.select("row", "host", F.inline(keys_of(F.array_distinct("lines"))))
    hits = join_split_hot(each, drop, ["host", "h1", "h2"], "pages", total)
    gone = hits.groupBy("row").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
    none = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    found = lines.join(gone, "row", "left").withColumn("gone", F.coalesce("gone", none))
    # In the row itself: lines that are not among the page's boilerplate, in their order.
    both = F.filter(F.arrays_zip(F.col("lines").alias("line"), keys_of(F.col("lines")).alias("key")), lambda x: ~F.array_contains(F.col("gone"), x["key"]))
    found = found.withColumn("stay", both)
    clean = F.array_join("stay.line", "\n")
    n_lines = F.size("lines").cast("long")
    columns = (F.col("host"), clean, n_lines, n_lines - F.size("stay"))
    return found.select("page.*", *[c.alias(n) for c, n in zip(columns, names, strict=True)])
