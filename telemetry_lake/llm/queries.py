"""The named queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm import (
    bpe_count, exact, kn_quality, lines, minhash, mixing, negatives, packing, pieces, pii, quality_rules, runs, toxicity,
)
from telemetry_lake.llm.common import table

TOKEN_LIMIT = 2048


def vocabulary(name: str) -> str:
    """The public vocabulary file; it lies at the same path on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), width=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are documents, hosts their sources."""
    cleaned = lines.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    n_lines = F.size(F.split("text", "\n")).cast("long")
    return cleaned.select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(n_lines).alias("n_lines"),
        "dropped_lines",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = pii.personal_data(table(spark, sf_dir, "documents"))
    return entities.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = bpe_count.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted text: the documents labelled as of good quality."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return kn_quality.quality(table(spark, sf_dir, "documents"), trusted)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", runs.looped_words().alias("text"))
    found = runs.periodic_runs(docs)
    shown = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines_ = F.when(F.size("runs") > 0, F.concat(F.array_join(shown, "\n"), F.lit("\n"))).otherwise("")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    named = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), lines_.alias("lines"), "collapsed")
    length = -F.col("top.less")
    return named.select(
        "doc_id", "n_runs", F.col("top.start").alias("start"), length.alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * length / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encoded(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector counts as of the next label, so that labels have rows far from their own."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup, op2_line_dedup, op3_quality_rules, op4_toxicity, op5_mixing, op6_personal_data, op7_token_counts,
        op8_exact_dedup, op9_quality_classifier, op10_packing, op11_periodic_runs, op12_sentence_pieces, op13_hard_negatives,
    )
}
