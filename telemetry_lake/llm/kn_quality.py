"""Quality by perplexity under an interpolated modified Kneser-Ney model of words.

1. Model: word bigrams of the trusted texts, counts, continuations and back-off in tables sharded by
   hash (``kn_words``).  It grows with the trusted text and knows every script.
2. Scores: the perplexity of each whole text, from the probability of every word and of its end.
   Trusted texts are scored without what only they brought into the model.
3. Thresholds: a quantile of the trusted texts' perplexities in each language.

The character model below (``SYMBOLS`` ** ``ORDER`` n-grams at most, whatever the input) is a building
block for small alphabets; ``quality`` does not use it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm import kn_words
from telemetry_lake.llm.common import own_columns, same
from telemetry_lake.llm.decisions import decided
from telemetry_lake.llm.kn_words import discounts
from telemetry_lake.session import settle

SYMBOLS = 48
ORDER = 4
QUANTILE = 0.99
SLACK = 1.2
LEAST_TRUSTED = 30


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


class Alphabet:
    """Code points to symbols: 0 for others, 1 for white space, then the frequent ones."""

    def __init__(self, frequent: list[int]):
        self.table = np.zeros(0x10000, np.int32)
        self.table[frequent] = np.arange(2, len(frequent) + 2)
        self.table[[9, 10, 11, 12, 13, 32]] = 1

    def grams(self, text: str) -> np.ndarray:
        """The n-gram that ends at each character, as one number; three spaces stand before the text."""
        found = points(text)
        symbols = np.ones(len(found) + ORDER - 1, np.int32)
        symbols[ORDER - 1:] = self.table[np.where(found < 0x10000, found, 0)]
        out = symbols[: len(found)].copy()
        for i in range(1, ORDER):
            out *= SYMBOLS
            out += symbols[i:i + len(found)]
        return out


def frequent_characters(trusted: DataFrame) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0x10000, np.int64)
        for batch in batches:
            for value in batch.column(0):
                found = points(value.as_py() or "")
                counts += np.bincount(found[found < 0x10000], minlength=0x10000)
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some), pa.array(counts[some])], ["point", "n"])

    counted = trusted.select("text").mapInArrow(run, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    counted = counted.filter("point NOT IN (0, 9, 10, 11, 12, 13, 32)")
    return [r["point"] for r in counted.orderBy(F.desc("n"), "point").limit(SYMBOLS - 2).collect()]


def gram_counts(trusted: DataFrame, alphabet: Alphabet) -> DataFrame:
    """gram, c: how often each n-gram of the highest order occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**ORDER, np.int32)
        for batch in batches:
            for value in batch.column(0):
                grams, n = np.unique(alphabet.grams(value.as_py() or ""), return_counts=True)
                counts[grams] += n.astype(np.int32)
        some = np.flatnonzero(counts)
        for at in range(0, len(some), 100_000):
            part = some[at:at + 100_000]
            yield pa.record_batch([pa.array(part), pa.array(counts[part].astype(np.int64))], ["gram", "c"])

    return trusted.select("text").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def model_tables(highest: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """By order: the probability of every n-gram seen (gram, p), the back-off weight of every context (gram, g)."""
    orders = {ORDER: highest}
    for k in range(ORDER - 1, 0, -1):  # distinct characters in front
        orders[k] = orders[k + 1].groupBy(F.expr(f"gram % {SYMBOLS**k}").alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    lower, tables = None, []
    for k in range(1, ORDER + 1):
        counts = settle(orders[k], f"counts{k}")
        d1, d2, d3 = discounts(counts)
        cut = F.expr(f"CASE c WHEN 1 THEN {d1}D WHEN 2 THEN {d2}D ELSE {d3}D END")
        counts = counts.withColumn("context", F.expr(f"gram DIV {SYMBOLS}")).withColumn("cut", cut)
        totals = counts.groupBy("context").agg(F.sum("c").alias("total"), F.sum("cut").alias("cuts"))
        totals = totals.select("context", "total", (F.col("cuts") / F.col("total")).alias("g"))
        joined = counts.join(totals, "context").withColumn("tail", F.expr(f"gram % {SYMBOLS**(k - 1)}"))
        if lower is None:
            joined = joined.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            joined = joined.join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("below")), "tail")
        probable = joined.select("gram", ((F.col("c") - F.col("cut")) / F.col("total") + F.col("g") * F.col("below")).alias("p"))
        lower = settle(probable, f"order{k}")
        tables.append((lower, totals.select(F.col("context").alias("gram"), "g")))
    return tables


def log_table(tables: list[tuple[DataFrame, DataFrame]]) -> np.ndarray:
    """Log probability of every possible n-gram; unseen ones back off.  SYMBOLS ** ORDER floats."""
    p = np.full(1, 1.0 / SYMBOLS)
    for k, (seen, weights) in enumerate(tables, 1):
        g = np.ones(SYMBOLS ** (k - 1))
        rows = weights.toPandas()
        g[rows["gram"].to_numpy(np.int64)] = rows["g"].to_numpy()
        # An unseen n-gram has its context's weight times the next lower order's probability.
        below = np.tile(p, SYMBOLS) if k > 1 else np.full(SYMBOLS, p[0])
        below *= np.repeat(g, SYMBOLS)
        rows = seen.toPandas()
        below[rows["gram"].to_numpy(np.int64)] = rows["p"].to_numpy()
        p = below
    return np.log(p).astype(np.float32)


def trusted_texts(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """text of each row of ``docs`` with a trusted id; few texts are moved for it (``decisions``)."""
    ids = own_columns(docs, "doc_id").filter("doc_id IS NOT NULL").distinct()
    ids = ids.join(trusted_ids.withColumn("trusted", F.lit(1)), "doc_id", "left")
    found = settle(ids.select("doc_id", F.coalesce("trusted", F.lit(0)).alias("class")), "trusted-ids")
    placed, known = decided(own_columns(docs, "doc_id", "text"), ["doc_id"], found, ["doc_id"], 2)
    open_ = placed.filter(F.col(known).isNull()).select("doc_id", "text").join(found.filter("class = 1"), "doc_id", "left_semi")
    return placed.filter(F.col(known) == 1).select("text").unionByName(open_.select("text"))


def perplexities(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """doc_id, lang, n_chars, trusted, perplexity (null for empty texts)."""
    values, unknown = kn_words.model(trusted_texts(docs, trusted_ids))
    scored = kn_words.log_likelihoods(docs, values, unknown)
    scored = scored.join(trusted_ids.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.col("trusted").isNotNull())
    score = F.when(F.col("trusted"), F.col("outside")).otherwise(F.col("full"))
    return scored.select("doc_id", "lang", "n_chars", "trusted", F.when(F.col("n_chars") > 0, F.exp(-score / F.col("n"))).alias("perplexity"))


def quality(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """doc_id, n_chars, perplexity, threshold, kept: one row per row of ``docs``.

    ``trusted_ids`` (doc_id) names the texts to learn from.  A language with fewer than LEAST_TRUSTED
    trusted texts uses the quantile of all trusted texts; a null lang is a language of its own.  Null
    and empty texts have no perplexity and are not kept.  Without trusted text nothing can be judged:
    every threshold is null and every text with a perplexity is kept.  An empty table gives an empty result.
    """
    trusted_ids = trusted_ids.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    scored = settle(perplexities(docs, trusted_ids), "perplexities")
    known = scored.filter("perplexity IS NOT NULL AND trusted")
    cut = F.percentile_approx("perplexity", QUANTILE, 10_000) * SLACK
    by_lang = known.groupBy("lang").agg(cut.alias("cut"), F.count(F.lit(1)).alias("n")).filter(f"n >= {LEAST_TRUSTED}")
    out = scored.alias("l").join(by_lang.alias("r"), same("l", "r", ["lang"]), "left").select("l.*", "r.cut")
    out = out.join(F.broadcast(known.agg(cut.alias("any"))), F.lit(True), "left")  # one row
    out = out.withColumn("threshold", F.coalesce("cut", "any"))
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.col("perplexity").isNotNull())
    return out.select("doc_id", "n_chars", "perplexity", "threshold", kept.alias("kept"))
