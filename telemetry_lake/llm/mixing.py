"""Mixing sources to target weights by systematic sampling (SQL functions only).

Method: within a source every document expects ``rate = target / source_size`` copies.  The running
sum of expected copies, moved by one random offset of the source, crosses an integer boundary once
for each copy that the mix takes.  Documents run by size, then doc_id: neighbours are alike in size,
so the words taken differ from the target by little more than the largest document.

Defined results: a null text counts as empty (size 0); a null source is a source of its own, last in
order; documents of size 0 are numbered like all others and take up to 2 copies of no words; repeated
rows are documents of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemetry_lake.llm.decisions import decided
from telemetry_lake.llm.common import WORD, counts_before, own_columns, ranked, same
from telemetry_lake.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2.0
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """source, source_size, target: ``share`` of all sizes by weight, at most ``ceiling`` times a source.

    Sorted by size per weight, sources reach their ceiling one after the other, so the capped ones
    are the first k and running sums solve the resharing.  One row per source is sorted, no more.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int")
    per = per.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    fill = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("nth").asc())
    earlier, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    whole = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("all_size", F.sum("source_size").over(whole))
    filled = F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * F.lit(ceiling)
    per = per.withColumn("level", (F.col("all_size") * F.lit(share) - filled) / F.sum("weight").over(onward))
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * F.lit(ceiling)
    per = per.withColumn("level", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(whole))
    target = F.least(F.col("source_size") * F.lit(ceiling), F.col("level") * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def offset(source: str = "source", seed: str = SEED):
    """One number in [0, 1) for each source, the same in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s:"), F.col(source)), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: one row per row of ``docs``."""
    size = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    sizes = settle(own_columns(docs, "doc_id", "source", "text").select("doc_id", "source", size.alias("size")), "sizes")
    targets = source_targets(sizes, weights, share, ceiling)
    smaller = counts_before(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), ["source"], "size")
    placed = (
        ranked(sizes, ["source", "size"], "doc_id").alias("l")
        .join(smaller.alias("r"), same("l", "r", ["source", "size"]))
        .select("l.doc_id", "l.source", "l.size", (F.col("l.rank") + F.col("r.before")).alias("rank"))
    )
    out = placed.alias("l").join(targets.alias("r"), same("l", "r", ["source"])).select("l.*", "r.source_size", "r.target")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    crossed = F.floor(F.col("rate") * F.col("rank") + F.col("u")) - F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("u"))
    out = out.withColumn("rate", rate).withColumn("u", offset())
    return out.select("doc_id", "source", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each row as often as the mix takes it.

    Rows that repeat a doc_id within a source share its copies: in the order of a hash of the row, the
    first get what does not divide evenly.  A null text has size 0.  Most texts stay where they are
    (``decisions``).  An empty table gives an empty result; columns keep their names and values.
    """
    keys = ["doc_id", "source"]
    copies = mix(docs, **options).groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    plain = (F.col("rows") == 1) & (F.col("copies") <= 2)
    copies = settle(copies.withColumn("class", F.when(plain, F.col("copies")).otherwise(3).cast("int")), "copies")
    placed, known = decided(docs, keys, copies, keys, 4)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sure = placed.filter(F.col(known).isin(1, 2)).withColumn(known, F.explode(F.sequence(F.lit(1), F.col(known)))).select(*columns)
    open_ = placed.filter(F.col(known).isNull() | (F.col(known) == 3)).select(F.struct(*columns).alias("row"))
    joined = open_.alias("l").join(
        copies.alias("r"), F.col("l.row.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("l.row.source").eqNullSafe(F.col("r.source"))
    ).select("l.row", "r.copies", "r.rows")
    single = joined.filter("rows = 1")
    order = Window.partitionBy("row.doc_id", "row.source").orderBy(F.xxhash64("row.text"))
    shared = joined.filter("rows > 1").withColumn("nth", F.row_number().over(order))
    shared = shared.withColumn("copies", F.expr("copies DIV rows + IF(nth <= copies % rows, 1, 0)")).drop("nth")
    both = single.unionByName(shared).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return sure.unionByName(both.select("row.*"))
