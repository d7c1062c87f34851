"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lookup import lookup
from ..operators.staging import stage
from .common import bind, without

# How HTML is cut into lines. A script, style or comment that is never closed goes on to the end.
INVISIBLE = r"(?is)<(?:script\b.*?(?:</script>|\z)|style\b.*?(?:</style>|\z)|!--.*?(?:-->|\z))"
BLOCK_TAG = (
    r"(?i)</?(?:p|br|div|li|ul|ol|h1|h2|h3|h4|h5|h6|article|section|nav|footer|header|main|aside|title|head|body|html|table|tr)"
    r"(?:[\s/][^>]*)?>"
)
OTHER_TAG = r"<[^>]*>"
BLANKS = " \t\x0b\x0c"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

RATIO = 0.3
MIN_PAGES = 3
HOT_HOSTS = 64


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def _without_tags(text: Column, tag: str, by: str) -> Column:
    """``text`` with its tags replaced. Past the last ``>`` no tag can end, and no ``<`` is searched from there."""

    def replaced(whole: Column) -> Column:
        rest = F.substring_index(whole, ">", -1)
        return F.concat(F.regexp_replace(F.substr(whole, F.lit(1), F.length(whole) - F.length(rest)), tag, by), rest)

    return bind(text, replaced)


def lines_of(html: Column) -> Column:
    """Non-empty trimmed lines of the visible text, in time that is linear in its length."""
    visible = F.regexp_replace(F.coalesce(html, F.lit("")), INVISIBLE, "")
    text = _without_tags(_without_tags(visible, BLOCK_TAG, "\n"), OTHER_TAG, "")
    return F.filter(F.transform(F.split(text, r"[\r\n]+"), lambda x: F.btrim(x, F.lit(BLANKS))), lambda x: x != "")


def _keyed(pages: DataFrame) -> DataFrame:
    """Pages (``row``, ``html``) with their lines and the keys of these."""
    return pages.withColumn("lines", lines_of(F.col("html"))).withColumn("keys", F.transform("lines", lambda x: F.md5(x)))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, url: str = "url", html: str = "html") -> DataFrame:
    """Per host, its ``pages`` and the keys of its ``frequent`` lines: fewer than (mean lines of a page) / ``ratio``."""
    own = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    keyed = _keyed(own).select("host", F.array_distinct("keys").alias("keys"))
    totals = keyed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # An inner explode would have its input tested for size first, and the lines be made again for each test.
    exploded = keyed.select("host", F.explode_outer("keys").alias("key")).filter(F.col("key").isNotNull())
    seen = exploded.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    frequent = lookup(seen.filter(F.col("n") >= min_pages), totals, ["host"], "inner")
    return frequent.filter(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(
        F.first("pages").alias("pages"), F.collect_list("key").alias("frequent")
    )


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``host``, ``text`` (kept lines), ``n_lines`` and ``n_removed``; such input columns are replaced.

    A line goes, wherever it stands, if more than ``ratio`` of the host's pages and at least
    ``min_pages`` hold it. Each row is a page, repeated rows too. Pages without a readable host
    share the host ``""``; NULL or empty HTML has no lines and gives the empty text. An empty table
    gives an empty result. Other columns may have any name.
    """
    rows = without(pages, "host", "text", "n_lines", "n_removed")
    frequent = stage(boilerplate(rows, ratio, min_pages, url, html), "boilerplate")
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    hosted = rows.select(own, host_of(F.col(f"`{url}`")).alias("host"))
    # Fewer than HOT_HOSTS hosts can have more than their share of the pages: their lists are broadcast,
    # and their pages are spread over the tasks of the join that serves all other hosts.
    hot = frequent.filter(F.col("pages") * HOT_HOSTS > rows.count()).select("host", F.col("frequent").alias("hot"))
    page = F.col(f"row.`{html}`")
    spread = F.concat(F.lit("\x00"), F.xxhash64(page).cast("string"), F.monotonically_increasing_id().cast("string"))
    keyed = hosted.join(F.broadcast(hot), "host", "left").withColumn("key", F.when(F.col("hot").isNotNull(), spread).otherwise(F.col("host")))
    found = lookup(keyed, frequent.select(F.col("host").alias("key"), "frequent"), ["key"])
    found = _keyed(found.withColumn("html", page)).withColumn("frequent", F.coalesce("hot", "frequent"))
    drop = F.array_intersect("keys", F.coalesce("frequent", F.array().cast("array<string>")))
    kept = F.filter("lines", lambda x, i: ~F.array_contains(F.col("drop"), F.get(F.col("keys"), i)))
    return found.withColumn("drop", drop).withColumn("kept", kept).select(
        "row.*", "host", F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )
