"""Quality rules with adaptive thresholds (SQL functions only).

Fixed cut-offs fit one language and one kind of site.  Here each language and source gets its own:
every rate of a document goes into a mergeable quantile sketch of its (lang, source), and documents
far beyond the sketch's quantiles are rejected after a join.

The sketch is a table of counts over value cells that widen with the value: values below 128 have a
cell of their own, larger ones share their seven leading binary digits.  Sketches merge by adding
counts, in any order and with the same result, and a quantile read from one is within 1/64 of the
exact value.  Its size depends on the range of values, not on the number of documents.  Sources with
few documents use the merged sketch of their language, rare languages that of all documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemetry_lake.llm.common import SPACE, WORD, own_columns, same
from telemetry_lake.session import settle

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
REPEAT_PERCENT = 20
SHINGLE = 5
CELL_DIGITS = 7
LEAST_DOCS = 200
MEDIAN = 500

# rate: (multiple of the group's median, allowance), both in the rate's own unit: thousandths.  A
# document is rejected when a rate exceeds multiple * median + allowance.
LIMITS = {"word_length": (2, 0), "symbols": (4, 40), "shouts": (4, 200), "capitals": (4, 150), "dup_lines": (4, 250), "repeats": (4, 150)}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, also where a lambda inside refers to it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each stretch of five words."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)]))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0)))


def covered(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, overlaps counted once.

    Windows are sorted by (hash, place); those with an equal neighbour are sorted by place again, and
    each covers five words or as many as lie before the next.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        equal = lambda x, j: F.coalesce(x["h"] == F.get(s, j)["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: equal(x, k - 1) | equal(x, k + 1)), lambda x: x["i"]))

    def reach(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(SHINGLE), F.coalesce(F.get(p, k + 1) - x, F.lit(SHINGLE))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(placed, twice), reach)


def repeat_words(words: Column) -> Column:
    """Nearly all texts have no window twice and are done after one distinct count."""
    return let(
        window_hashes(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)),
    )


def only(text: Column, kept: str) -> Column:
    """How many characters of ``text`` are in the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every whole text; a null text counts as empty."""
    slim = own_columns(docs, "doc_id", "lang", "source", "text").withColumn("text", F.coalesce("text", F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    by_words = let(
        words_of(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    out = slim.select(
        "doc_id", "lang", "source", by_words.alias("w"), by_lines.alias("x"),
        only(F.col("text"), SYMBOLS).alias("n_symbols"), only(F.col("text"), "!").alias("n_shouts"),
        only(F.col("text"), r"\p{Lu}").alias("n_capitals"),
    )
    return out.select("doc_id", "lang", "source", "w.*", "x.*", "n_symbols", "n_shouts", "n_capitals")


def rates(measures: DataFrame) -> DataFrame:
    """The measures as whole thousandths: word length, symbols, capitals per character, and so on."""
    per = lambda part, whole: F.expr(f"coalesce({part} * 1000 DIV nullif({whole}, 0), 0L)")
    return measures.withColumns({
        "word_length": per("word_chars", "n_words"), "symbols": per("n_symbols", "word_chars"), "shouts": per("n_shouts", "n_words"),
        "capitals": per("n_capitals", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
    }).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    )


def cell(value: str) -> str:
    """The lower end of the sketch cell that holds a whole number."""
    shift = f"greatest(length(bin({value})) - {CELL_DIGITS}, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(rated: DataFrame) -> DataFrame:
    """lang, source, rate, cell, n: the sketches of all documents that pass the base rules."""
    pairs = ", ".join(f"'{name}', {name}" for name in LIMITS)
    stacked = rated.filter("NOT base_failed").selectExpr("lang", "source", f"stack({len(LIMITS)}, {pairs}) AS (rate, value)")
    return stacked.groupBy("lang", "source", "rate", F.expr(cell("value")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, group: list[str], thousandth: int = MEDIAN) -> DataFrame:
    """group, rate, docs, quantile: read off after merging the sketches of each group."""
    merged = sketch.groupBy(*group, "rate", "cell").agg(F.sum("n").alias("n"))
    window = Window.partitionBy(*group, "rate")
    up_to = F.sum("n").over(window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    merged = merged.withColumn("up_to", up_to).withColumn("docs", F.sum("n").over(window))
    reached = merged.filter(F.col("up_to") * 1000 >= F.col("docs") * thousandth)
    return reached.groupBy(*group, "rate").agg(F.max("docs").alias("docs"), F.min("cell").alias("quantile"))


def wide(found: DataFrame, group: list[str], prefix: str) -> DataFrame:
    """One row per group with a column for each rate's quantile."""
    columns = [F.max(F.when(F.col("rate") == name, F.col("quantile"))).alias(f"{prefix}{name}") for name in LIMITS]
    return found.groupBy(*group).agg(F.max("docs").alias(f"{prefix}docs"), *columns)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed, reason, kept: one row per row of ``docs``.

    A null lang or source is a group of its own.  ``reason`` lists the rates beyond their threshold,
    comma-joined, empty when kept; ``base`` for the fixed rules.  An empty table gives an empty result.
    """
    rated = settle(rates(measured(docs)), "rated")
    sketch = settle(sketches(rated), "sketches")
    by_source = wide(quantiles(sketch, ["lang", "source"]), ["lang", "source"], "s_")
    by_lang = wide(quantiles(sketch, ["lang"]), ["lang"], "l_")
    overall = wide(quantiles(sketch.withColumn("all", F.lit(1)), ["all"]), ["all"], "a_")
    out = rated.alias("d").join(by_source.alias("s"), same("d", "s", ["lang", "source"]), "left").select("d.*", *[f"s.s_{x}" for x in ("docs", *LIMITS)])
    out = out.alias("d").join(by_lang.alias("s"), same("d", "s", ["lang"]), "left").select("d.*", *[f"s.l_{x}" for x in ("docs", *LIMITS)])
    out = out.join(F.broadcast(overall), F.lit(True), "left")  # one row
    beyond = []
    for name, (multiple, allowance) in LIMITS.items():
        level = F.expr(f"CASE WHEN s_docs >= {LEAST_DOCS} THEN s_{name} WHEN l_docs >= {LEAST_DOCS} THEN l_{name} ELSE coalesce(a_{name}, 0) END")
        beyond.append(F.when(F.col(name) > level * multiple + allowance, F.lit(name)))
    reason = F.when(F.col("base_failed"), F.lit("base")).otherwise(F.array_join(F.array(*beyond), ","))
    out = out.withColumn("reason", reason)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (F.col("reason") == "").alias("kept"), "reason",
    )
