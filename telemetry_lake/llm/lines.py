"""Line dedup by site-relative frequency.

For each host: the number of its pages that contain a line, divided by the number of its pages.  Lines
above the ratio are boilerplate and go, but the host's page with the smallest id keeps its copy, so
that no line, and no page that was copied many times, leaves the corpus altogether.

The ratio bounds the result: the lines of a host with a share above r number at most its mean count of
distinct lines per page divided by r.  Counts combine before the shuffle; a line that a third of all
pages share is one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import WORD, same
from telemetry_lake.llm.decisions import marked
from telemetry_lake.session import settle

RATIO = 0.02
LEAST_PAGES = 5


def line_key(line: Column) -> Column:
    """A line by 128 bits of its trimmed text."""
    return F.unhex(F.md5(F.trim(line)))


def text_key(text: Column) -> Column:
    """A text by 128 bits; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, page: str = "doc_id", host: str = "source", by_text: bool = False) -> DataFrame:
    """host, line (key), n_pages, host_pages, first_page for each line above the ratio.

    With ``by_text`` host_pages counts different texts; n_pages still counts rows, so that no line of
    ``of_texts`` is missing.
    """
    counted = F.count_distinct(text_key(F.col("text"))) if by_text else F.count(F.lit(1))
    total = pages.groupBy(F.col(host).alias("host")).agg(counted.alias("host_pages"))
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD))), line_key))
    seen = pages.select(F.col(page).alias("page"), F.col(host).alias("host"), F.explode(lines).alias("line"))
    seen = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"), F.min("page").alias("first_page"))
    seen = seen.filter(F.col("n_pages") >= least_pages)
    found = seen.alias("l").join(total.alias("r"), same("l", "r", ["host"])).select("l.*", "r.host_pages")
    return found.filter(F.col("n_pages") > ratio * F.col("host_pages"))


def of_texts(hits: DataFrame, ratio: float, least_pages: int) -> DataFrame:
    """The hits (page, host, line, text key, host_pages) whose line is on enough different texts.

    Rows of the first page, and of other pages with its text, are left out.
    """
    texts = hits.groupBy("_host", "_line", "_text").agg(F.min("_page").alias("page"), F.max("host_pages").alias("host_pages"))
    first = F.min(F.struct(F.col("page").isNull().alias("unnamed"), "page", "_text")).alias("first")
    found = texts.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("n"), F.max("host_pages").alias("host_pages"), first)
    found = found.filter((F.col("n") >= least_pages) & (F.col("n") > ratio * F.col("host_pages")))
    joined = hits.alias("l").join(found.alias("r"), same("l", "r", ["_host", "_line"]))
    return joined.filter("NOT (l._page <=> r.first.page OR l._text <=> r.first._text)").select("l.*")


def drop_lines(
    pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, page: str = "doc_id", host: str = "source", by_text: bool = False
) -> DataFrame:
    """The pages with ``text`` without boilerplate lines, and ``dropped_lines``, how many went.

    A page that loses all lines stays with an empty text.  Null texts stay null and drop nothing;
    lines without a word are never dropped; pages of a null host form a host of their own; repeated
    rows count as pages, and rows that repeat the first page's id all keep its lines.  An empty table
    gives an empty result.  A column ``dropped_lines`` of the input is replaced.

    With ``by_text`` pages of a host with equal texts count as one, and those equal to the first page
    keep its lines: copies stay copies.
    """
    pages = pages.drop("dropped_lines")
    common = settle(boilerplate(pages, ratio, least_pages, page, host, by_text), "boilerplate")
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD))), line_key))
    mark = [text_key(F.col("text")).alias("_text")] if by_text else []
    seen = pages.select(F.col(page).alias("_page"), F.col(host).alias("host"), *mark, F.explode(lines).alias("line"))
    hits = seen.alias("l").join(common.alias("r"), same("l", "r", ["host", "line"]))
    named = [F.col("l._page"), F.col("l.host").alias("_host"), F.col("l.line").alias("_line")]
    if by_text:
        hits = of_texts(settle(hits.select(*named, "_text", "host_pages"), "hits"), ratio, least_pages)
    else:
        hits = hits.filter("NOT l._page <=> r.first_page").select(*named)
    # One row per page: it has few boilerplate lines, bounded per host as said above.
    hits = hits.groupBy("_page", "_host").agg(F.collect_set("_line").alias("gone")).withColumn("class", F.lit(0))
    hits = settle(hits, "affected")
    marks, (touched,) = marked(pages, [page, host], hits, ["_page", "_host"], 1)
    columns = [F.col(f"`{c}`") for c in pages.columns]
    # Pages without a boilerplate line are let through as they are; the texts of the others meet their lines.
    clean = marks.filter(~F.col(touched)).select(*columns, F.lit(0).cast("long").alias("dropped_lines"))
    maybe = marks.filter(touched).select(F.struct(*columns).alias("row"))
    joined = maybe.alias("l").join(
        hits.alias("r"), F.col(f"l.row.{page}").eqNullSafe(F.col("r._page")) & F.col(f"l.row.{host}").eqNullSafe(F.col("r._host")), "left"
    ).select("l.row", "r.gone")
    split = F.split("row.text", "\n")
    kept = F.filter(split, lambda x: ~F.coalesce(F.array_contains("gone", line_key(x)) & F.regexp_like(x, F.lit(WORD)), F.lit(False)))
    cleaned = joined.withColumn("kept", F.when(F.col("gone").isNotNull(), kept))
    dropped = F.when(F.col("kept").isNotNull(), F.size(split) - F.size("kept")).otherwise(0).cast("long")
    text = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("row.text"))
    named = [text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in pages.columns]
    return clean.unionByName(cleaned.select(*named, dropped.alias("dropped_lines")))
