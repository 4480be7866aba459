"""Bring decisions about documents to the documents without moving their texts.

A decision is a few bytes, a document is kilobytes; a join by id would shuffle both.  Here the ids of
each class of decisions are marked in bitmaps of bounded size, which are broadcast.  A document whose
id is marked in one class alone is decided where it lies, since a bitmap never misses an id it was
given.  Ids that fall on the same bit are the only ones left open; callers join those exactly.  Where
there are far more ids than bits, more documents are left open, and results stay the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.session import settle

PAGE_BITS = 1 << 15  # bits of one row of a bitmap
BITS_PER_ID = 32
PAGES = (32, 4096)  # least and most rows of a bitmap: 16 MB a class at most


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with as many underscores before it as it takes to be no column yet."""
    while name in taken:
        name = f"_{name}"
    return name


def marked(docs: DataFrame, keys: Sequence[str], table: DataFrame, table_keys: Sequence[str], classes: int) -> tuple[DataFrame, list[str]]:
    """``docs`` with a boolean column per class: its key may be one of ``table`` (keys, class) with that class.

    ``table`` is a settled table; null keys equal one another.  Returns the names of the new columns.
    """
    pages = max(PAGES[0], min(PAGES[1], -(-table.count() * BITS_PER_ID // PAGE_BITS)))

    def place(columns: Sequence[str]):
        hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
        return F.pmod(hashed, F.lit(pages)).cast("int"), F.pmod(F.shiftright(hashed, 20), F.lit(PAGE_BITS)).cast("bigint")

    page, bit = place(table_keys)
    maps = table.select(page.alias("page"), bit.alias("bit"), "class").groupBy("page", "class").agg(F.bitmap_construct_agg("bit").alias("bits"))
    maps = maps.groupBy("page").agg(*[F.any_value(F.when(F.col("class") == c, F.col("bits")), True).alias(f"bits{c}") for c in range(classes)])
    maps = settle(maps, "bitmaps")
    page, bit = place(keys)
    at, here = free_name("page", docs.columns), free_name("bit", docs.columns)
    names = []
    for c in range(classes):
        names.append(free_name(f"class{c}", docs.columns))

    def found(c: int):
        byte = F.substring(F.col(f"m.bits{c}"), (F.shiftright(F.col(f"d.{here}"), 3) + 1).cast("int"), F.lit(1))
        set_ = F.conv(F.hex(byte), 16, 10).cast("bigint").bitwiseAND(F.element_at(F.lit([1 << i for i in range(8)]), (F.col(f"d.{here}") % 8 + 1).cast("int")).cast("bigint"))
        return F.coalesce(set_ > 0, F.lit(False))

    placed = docs.withColumns({at: page, here: bit})
    joined = placed.alias("d").join(F.broadcast(maps).alias("m"), F.col(f"d.{at}") == F.col("m.page"), "left")
    return joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], *[found(c).alias(n) for c, n in enumerate(names)]), names


def decided(docs: DataFrame, keys: Sequence[str], table: DataFrame, table_keys: Sequence[str], classes: int) -> tuple[DataFrame, str]:
    """``docs`` with the class of its key, or null where the bitmaps leave it open.  Returns the new column's name."""
    hits, names = marked(docs, keys, table, table_keys, classes)
    one = sum((F.col(n).cast("int") for n in names[1:]), F.col(names[0]).cast("int")) == 1
    which = F.coalesce(*[F.when(F.col(n), F.lit(c)) for c, n in enumerate(names)])
    name = free_name("decided", docs.columns)
    return hits.select(*[F.col(f"`{c}`") for c in docs.columns], F.when(one, which).alias(name)), name
