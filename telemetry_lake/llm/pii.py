"""Personal data by bootstrapped contextual extraction (SQL functions only).

Base: e-mail, IP, card and phone patterns give the seed entities.  Then

1. contexts: the two words before an entity, or before any other token that looks like an identifier
   (five digits or more, or an at sign; a white-space token, or tokens joined where a single space
   stands between two digits), are its lexical pattern; together they form a graph whose
   nodes are patterns and instances (the identifier's own characters) and whose edges carry counts;
2. scoring, in rounds: a pattern's confidence for a kind is the share of its occurrences whose
   instance belongs to the kind, weighted by the instances' scores; an instance's score is the best
   confidence of its patterns.  Seeds keep score 1, and a pattern needs several distinct instances;
3. discovery: identifiers whose score reaches the threshold become spans of that kind.

The graph is aggregated before it is joined, one row per (pattern, instance), and written once per round.

The patterns below are the plain ones in a form that takes linear time and constant stack in Java's
matcher: a separator that holds a number or a domain together is first replaced by one marker
character (``JOINT``), which keeps all positions, so no group is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemetry_lake.llm.common import own_columns
from telemetry_lake.llm.quality_rules import let
from telemetry_lake.session import settle

KINDS = ("email", "ip", "card", "phone")
JOINT, SPARE = "\ue000", "\ue001"
LABEL = "A-Za-z0-9-"
LOCAL = f"A-Za-z0-9._%+{JOINT}-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++{JOINT}[{LABEL}{JOINT}]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = f"[0-9][0-9{JOINT}]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A white-space token that holds a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

REACHES = (80, 1_300, 21_000)
ROUNDS = 3
LEAST_INSTANCES = 5
CONFIDENCE = 0.7
LEAST_DIGITS = 5


def running(lengths: Column) -> Column:
    """Sums up to and with each element.  Done in stretches of about the root of the array's size."""
    width = lambda x: F.greatest(F.ceil(F.sqrt(F.size(x))), F.lit(1)).cast("int")
    sums = lambda x: F.aggregate(
        x, F.array().cast("array<int>"), lambda a, v: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + v))
    )
    parts = lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(x) / width(x)) - 1, F.lit(0)).cast("int")), lambda c: sums(F.slice(x, c * width(x) + 1, width(x))))
    ends = lambda p: sums(F.transform(p, lambda x: F.coalesce(F.get(x, F.size(x) - 1), F.lit(0))))
    shifted = lambda p: let(ends(p), lambda e: F.flatten(F.transform(p, lambda x, c: F.transform(x, lambda v: v + F.coalesce(F.get(e, c - 1), F.lit(0))))))
    return let(lengths, lambda x: let(parts(x), shifted))


def found(text: Column, pattern: str) -> Column:
    """start, end (code points), value of each match, leftmost first and without overlap."""

    def placed(x: Column) -> Column:
        # x.p: what lies between matches, x.m: the matches; the ends of both, in turn, by one running sum.
        turns = F.flatten(F.transform(x["m"], lambda m, i: F.array(F.length(F.get(x["p"], i)), F.length(m))))
        return let(running(turns), lambda e: F.transform(x["m"], lambda m, i: F.struct(F.get(e, 2 * i).alias("start"), F.get(e, 2 * i + 1).alias("end"), m.alias("value"))))

    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return let(both, lambda x: F.when(F.size(x["m"]) > 0, placed(x)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits' check sum is right; for at most 19 digits."""

    def weighed(d: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.substr(d, -i, F.lit(1)).cast("int") * (2 - F.pmod(i, F.lit(2))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0

    return let(digits(value), weighed)


def octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: F.coalesce(x.try_cast("bigint") <= 255, F.lit(False)))


def base_spans(text: Column) -> dict[str, Column]:
    """The base entities of each kind; texts without the kind's characters are not searched."""
    plain = F.translate(text, JOINT, SPARE)
    mail = F.regexp_replace(plain, rf"(?<=[{LABEL}])\.(?=[{LABEL}])", JOINT)
    card = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    n = lambda x: F.length(digits(x["value"]))
    # Luhn is worked out for values of the right length only.
    sums = lambda x: F.when(n(x).between(13, 19), luhn(x["value"])).otherwise(F.lit(False))
    spans = {
        "email": F.when(F.contains(text, F.lit("@")), found(mail, EMAIL)),
        "ip": F.when(F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")), F.filter(found(text, IP), lambda x: octets(x["value"]))),
        "card": F.when(F.regexp_like(text, F.lit("[0-9]")), F.filter(found(card, CARD), sums)),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(found(text, PHONE), lambda x: n(x).between(9, 15))),
    }
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return {k: F.coalesce(v, empty) for k, v in spans.items()}


def listed(spans: Column) -> Column:
    """kind:start:end of spans (kind, start, end), comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def pattern_before(text: Column, start: Column) -> Column:
    """The two words before a place, lower-cased and without outer punctuation; null where there are none."""
    split = lambda x: F.filter(F.split(F.lower(x), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = split(F.substr(text, F.lit(1), start))

    def within(reach: int, longer: Column) -> Column:
        # A stretch that starts inside the text may cut its first word; with three words the last two are whole.
        near = split(F.substr(text, F.greatest(start - reach + 1, F.lit(1)), F.least(start, F.lit(reach))))
        return let(near, lambda w: F.when((F.size(w) > 2) | (start <= reach), w).otherwise(longer))

    for reach in reversed(REACHES):
        words = within(reach, words)

    def pattern(w: Column) -> Column:
        last = F.slice(w, -F.least(F.size(w), F.lit(2)), F.lit(2))
        cores = F.filter(F.transform(last, lambda x: F.regexp_replace(x, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")), lambda x: x != "")
        return F.when(F.size(w) > 1, let(cores, lambda c: F.when(F.size(c) == 2, F.array_join(c, " "))))

    return let(words, pattern)


def occurrences(marked: DataFrame) -> DataFrame:
    """row, kind (null for candidates), start, end, instance, pattern."""
    named = lambda k: F.transform(k, lambda x: F.struct(F.lit(k).alias("kind"), *[x[c].alias(c) for c in ("start", "end", "value")]))
    seeds = F.flatten(F.array(*map(named, KINDS)))
    core = r"[\p{L}\p{N}+@](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?"

    def trimmed(x: Column) -> Column:
        inner = F.regexp_extract(x["value"], core, 0)
        begin = x["start"] + F.instr(x["value"], inner) - 1
        return F.struct(F.lit(None).cast("string").alias("kind"), begin.alias("start"), (begin + F.length(inner)).alias("end"), inner.alias("value"))

    looks = lambda x: (F.length(x["value"]) >= LEAST_DIGITS) & (
        (F.length(digits(x["value"])) >= LEAST_DIGITS) | F.regexp_like(x["value"], F.lit("^[^@]+@[^@]+$"))
    )
    # Tokens, and where digits stand on both sides of a single space, what that space joins.
    spaced = r"(?<=[0-9])\x20(?=[0-9])"
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    tokens = F.coalesce(found(F.col("text"), TOKEN), none)
    joined = F.when(F.regexp_like("text", F.lit(spaced)), found(F.regexp_replace(F.translate("text", JOINT, SPARE), spaced, JOINT), TOKEN))
    joined = F.filter(F.coalesce(joined, none), lambda x: F.contains(x["value"], F.lit(JOINT)))
    free = lambda x: ~F.exists("seeds", lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))
    has = F.regexp_like("text", F.lit("[0-9@]"))
    out = marked.filter(has).select("row", "text", seeds.alias("seeds"))
    candidates = F.filter(F.transform(F.concat(tokens, joined), trimmed), looks)
    out = out.select("row", "text", "seeds", F.coalesce(candidates, F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")).alias("c"))
    out = out.select("row", "text", F.explode(F.concat("seeds", F.filter("c", free))).alias("o"))
    instance = F.lower(F.regexp_replace("o.value", r"[^\p{L}\p{N}@]", ""))
    return out.select("row", "o.kind", "o.start", "o.end", instance.alias("instance"), pattern_before(F.col("text"), F.col("o.start")).alias("pattern"))


def scored(edges: DataFrame) -> DataFrame:
    """instance, kind, score after the rounds; ``edges``: pattern, instance, n, kinds (of a seed, else null)."""
    seeds = edges.filter("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    total = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    links = edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    scores = seeds
    for _ in range(ROUNDS):
        weight = links.join(scores, "instance").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("weight"), F.count(F.lit(1)).alias("instances")
        )
        sure = weight.join(total, "pattern").filter(f"instances >= {LEAST_INSTANCES} AND weight >= {CONFIDENCE} * total")
        sure = sure.select("pattern", "kind", (F.col("weight") / F.col("total")).alias("confidence"))
        learned = links.join(sure, "pattern").groupBy("instance", "kind").agg(F.max("confidence").alias("score"))
        # Seeds stay as they are; another instance belongs to the kind that scores best.
        learned = learned.join(seeds.select("instance"), "instance", "left_anti")
        best = learned.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b")).select("instance", "b.kind", "b.score")
        scores = settle(seeds.unionByName(best), "scores")
    return scores


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (array of kind, start, end), found (base and discovered).

    One row per row of ``docs``; null texts count as empty.  Positions are code points, end exclusive;
    spans come by kind as listed, then start.  Discovered spans never overlap base ones, nor each
    other.  An empty table gives an empty result.
    """
    slim = own_columns(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    slim = slim.select("doc_id", "text", *[v.alias(k) for k, v in base_spans(F.col("text")).items()])
    # Row numbers are written together with the texts that can matter later, so they never change.
    keep = F.when(F.regexp_like("text", F.lit("[0-9@]")), F.col("text")).otherwise(F.lit(""))
    marked = settle(slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", keep.alias("text"), *KINDS), "base")
    seen = settle(occurrences(marked), "occurrences")
    edges = seen.filter("pattern IS NOT NULL").groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n"))
    accepted = scored(settle(edges, "edges")).filter(f"score >= {CONFIDENCE}")
    fresh = seen.filter("kind IS NULL AND pattern IS NOT NULL").select("row", "start", "end", "instance").join(accepted, "instance")
    # A token may lie inside tokens that a space joins; the longer span holds.
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    fresh = fresh.withColumn("covered", F.coalesce(F.max("end").over(earlier) >= F.col("end"), F.lit(False))).filter("NOT covered")
    fresh = fresh.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("fresh"))
    out = marked.drop("text").join(fresh, "row", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    short = lambda k: F.transform(k, lambda x: F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    new = lambda k: F.filter(F.coalesce("fresh", none), lambda x: x["kind"] == k)
    base = F.flatten(F.array(*[short(k) for k in KINDS]))
    merged = F.flatten(F.array(*[F.array_sort(F.concat(short(k), new(k))) for k in KINDS]))
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], base.alias("base"), merged.alias("found"))
