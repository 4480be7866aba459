"""A corpus from raw documents to packed token sequences, in stages.

Each stage gets what the one before has kept and returns the columns of ``documents``; the last
returns the packed pieces.  Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm import lines, minhash, mixing, packing, toxicity
from telemetry_lake.llm.common import table
from telemetry_lake.llm.decisions import decided, free_name
from telemetry_lake.llm.queries import vocabulary
from telemetry_lake.session import settle


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go.  Learns from the labelled documents among ``docs``."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; documents stay, with their new length.

    Copies of a text count as one page: they are no boilerplate, and near-dedup finds them whole.
    """
    cleaned = lines.drop_lines(docs, by_text=True)
    n_chars = F.when(F.col("dropped_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, on five-word shingles, the document with the smallest id stays.

    A document without an id takes part under a number made from its text, at the far end of the longs.
    Of rows that repeat an id and its text one stays.  Most texts stay where they are (``decisions``).
    """
    made = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    name = free_name("near_id", docs.columns)
    named = docs.withColumn(name, F.coalesce(F.col("doc_id").cast("long"), made))
    groups = minhash.near_groups(named.select(F.col(name).alias("doc_id"), "text"), width=5)
    found = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    # 0: goes, 1: the only row of its id, 2: one of several rows with a kept id
    kind = F.when(~F.col("kept"), 0).when(F.col("rows") == 1, 1).otherwise(2)
    found = settle(found.select("doc_id", kind.alias("class")), "near-kept")
    placed, known = decided(named, [name], found, ["doc_id"], 3)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sure = placed.filter(F.col(known) == 1).select(*columns)
    open_ = placed.filter(F.col(known).isNull() | (F.col(known) == 2)).select(F.col(name).alias("id"), F.struct(*columns).alias("row"))
    open_ = open_.join(found.filter("class > 0").withColumnRenamed("doc_id", "id"), "id")
    single = open_.filter("class = 1").select("row.*")
    text = F.md5(F.coalesce("row.text", F.lit("")))
    repeated = open_.filter("class = 2").groupBy("id", text.alias("text")).agg(F.any_value("row").alias("row")).select("row.*")
    return sure.unionByName(single).unionByName(repeated)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The stages learn weights, hash and encode ids: not expressible in SQL.  tests/llm holds them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
