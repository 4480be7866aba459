"""Interpolated modified Kneser-Ney over words (order 2), with every table sharded by hash.

Nothing is collected or broadcast but the counts of counts and two totals: vocabulary and bigrams
grow with the trusted text, and lie in tables of 64-bit hashes (keys) with counts, cut into buckets by
ranges of the key.

With START before and END after the words, every word is predicted once and is a context once.  The
log probability of a text is taken apart by what the model knows:

    sum of log p(v | u) = n * log p(unknown)
                        + sum over words   of  log p1(w) - log p(unknown) + log g(w)
                        + sum over bigrams of  log p(v | u) - log g(u) - log p1(v)

where p1 is the continuation probability and g the back-off weight (1 for words that are no context).
A key that the model lacks adds nothing.  Texts become blocks of about ``BLOCK_WORDS`` numbered words.
A block asks each bucket for its distinct keys there, in order; the answer is their counts in that
order, so that neither keys nor places in texts travel back, and the block computes its texts' scores.
A key has one place per block, so a very common word or word pair is no hot key.

Disk: keys are sent as packed differences, about 6 bytes for a block's distinct key.  The texts are
scored in ``SLICES`` equal parts, one after another, and the blocks, questions and answers of a part
are gone before the next: only the model lies there throughout.

A trusted text would find its own words in the model.  For it a key that occurs nowhere else in the
trusted texts counts as missing, so that it is scored like a text from outside.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import in_small_batches, own_columns
from telemetry_lake.session import discard, settle, without_old_shuffles

START, END = 1, 2
REMEMBERED = 500_000
BLOCK_WORDS = 1_000_000
BLOCK_TEXTS = 60_000
LONGEST_POSTING = 50_000  # keys of a block and bucket in one row
SLICES = 4
# Scripts without spaces between words: each character is a word.
ALONE = re.compile("([฀-໿က-႟ក-៿⺀-꓏豈-﫿\U00020000-\U0003ffff])")


class WordNumbers(dict):
    """Words as numbers in order of appearance, 0 and 1 for START and END; ``hashes`` has their 64-bit hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = array("Q", [START, END])

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word) or 3)
        return number

    def words(self, lowered: str) -> np.ndarray:
        if not lowered.isascii():
            lowered = ALONE.sub(r" \1 ", lowered)
        found = lowered.encode("utf-8", "replace").split()
        out = np.empty(len(found) + 2, np.int32)
        out[0], out[-1] = 0, 1
        out[1:-1] = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
        return out


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A key for each two neighbours, from their hashes."""
    out = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + (left >> np.uint64(7)))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Byte by byte, all lowest bytes first: the upper ones of small numbers take next to nothing."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(numbers.size, numbers.itemsize).T.tobytes()
    return numbers.size.to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


# One row form for all that is exchanged.  A block: block, keys (hashes of its words), counts (its texts as
# places in ``keys``), head.  A question: bucket, block, part, keys, counts if it brings any.  Its answer: the
# same without keys.  A bucket of the model: bucket, keys, counts, seen (counts of counts).
ROW = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
    ("head", pa.binary()), ("seen", pa.list_(pa.int64())),
])
ROW_TYPE = "bucket int, block long, part int, keys binary, counts binary, head binary, seen array<long>"
HEAD = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("n", pa.int64())])
WORD_COUNTS = 5  # of a word: occurrences, distinct words before it, distinct words after it once, twice, more often
SEEN = 6  # how many keys were counted 1, 2, 3, 4 times, how many at all, and the sum of the counts


def row_batches(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    """Rows of ROW in batches of about 1 MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(row.get(c) or b"") for c in ("keys", "counts", "head"))
        if size > 1 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=ROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=ROW)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def together(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of equal ``by[0]`` next to one another, in the order of ``by``, nulls first."""
    return rows.repartition(by[0]).sortWithinPartitions(*by)


def blocks(docs: DataFrame) -> DataFrame:
    """A row for about ``BLOCK_WORDS`` words of whole texts of ``docs`` (doc_id, lang, text)."""

    def block_row(block: int, numbers: WordNumbers, texts: list[np.ndarray], head: list[tuple]) -> dict:
        found = np.concatenate(texts)
        times = np.bincount(found)
        used = np.flatnonzero(times)
        hashes = np.frombuffer(numbers.hashes, np.uint64)[used]
        # Frequent words get small places; those of one frequency stand in the order of their hashes.
        order = np.lexsort((hashes, -times[used]))
        place = np.empty(len(times), np.int32)
        place[used[order]] = np.arange(len(used), dtype=np.int32)
        table = pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*head, strict=True), HEAD, strict=True)], schema=HEAD)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, HEAD) as writer:
            writer.write_table(table)
        return {"block": block, "keys": packed_keys(hashes[order]), "counts": packed(place[found]), "head": sink.getvalue().to_pybytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            numbers, block = WordNumbers(), TaskContext.get().partitionId() << 32
            texts, head, n = [], [], 0
            for batch in batches:
                for doc_id, lang, value in zip(*[batch.column(i) for i in range(3)], strict=True):
                    lowered = (value.as_py() or "").lower()
                    texts.append(numbers.words(lowered))
                    head.append((doc_id.as_py(), lang.as_py(), len(lowered), len(texts[-1]) - 1))
                    n += len(texts[-1])
                    if n > BLOCK_WORDS or len(texts) >= BLOCK_TEXTS:
                        yield block_row(block, numbers, texts, head)
                        texts, head, n, block = [], [], 0, block + 1
                        if len(numbers) > REMEMBERED:
                            numbers = WordNumbers()
            if texts:
                yield block_row(block, numbers, texts, head)

        yield from row_batches(found())

    return in_small_batches(docs).mapInArrow(run, ROW_TYPE)


class Block:
    """Words and word pairs of a block's texts."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.words, self.found = unpacked_keys(row["keys"]), unpacked(row["counts"], np.int32).astype(np.int64)
        self.head = pa.ipc.open_stream(row["head"]).read_all().combine_chunks()
        self.n = self.head["n"].to_numpy()  # predicted words
        self.word_order = np.argsort(self.words, kind="stable")
        inside = np.ones(len(self.found) - 1, bool)
        inside[np.cumsum(self.n + 1)[:-1] - 1] = False
        # A pair as one number.
        self.pairs = (self.found[:-1] * len(self.words) + self.found[1:])[inside]
        self.kinds, self.times = np.unique(self.pairs, return_counts=True)
        self.left, self.right = np.divmod(self.kinds, len(self.words))
        keys = pair_keys(self.words[self.left], self.words[self.right])
        self.pair_order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.pair_order]

    def word_rows(self, buckets: int, counts: np.ndarray | None = None) -> Iterator[dict]:
        return self._rows(self.words[self.word_order], buckets, 0, None if counts is None else counts[:, self.word_order])

    def pair_rows(self, buckets: int, counts: np.ndarray | None = None) -> Iterator[dict]:
        return self._rows(self.pair_keys, buckets, buckets, None if counts is None else counts[:, self.pair_order])

    def _rows(self, keys: np.ndarray, buckets: int, first: int, counts: np.ndarray | None) -> Iterator[dict]:
        """Sorted keys by range of the key, numbered from ``first``."""
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64)).tolist()
        for b, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            for part, at in enumerate(range(low, high, LONGEST_POSTING)):
                stop = min(at + LONGEST_POSTING, high)
                own = None if counts is None else packed(counts[:, at:stop])
                yield {"bucket": first + b, "block": self.block, "part": part, "keys": packed_keys(keys[at:stop]), "counts": own}

    def sums(self, items: np.ndarray, length: np.ndarray, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """By text of ``length`` items: the values of the items, and those of items that the trusted texts have elsewhere, too.

        ``values`` and ``counts`` are those of the distinct items in order.
        """
        texts = len(length)
        place = np.repeat(np.arange(texts), length)
        if len(self.words) ** 2 * texts < 1 << 62:
            items, place = np.divmod(np.sort(items * texts + place), texts)
        else:
            order = np.lexsort((place, items))
            items, place = items[order], place[order]
        other = np.r_[True, items[1:] != items[:-1]]
        start = np.flatnonzero(other | np.r_[True, place[1:] != place[:-1]])
        times = np.diff(np.r_[start, len(items)])
        items, place = np.cumsum(other)[start] - 1, place[start]
        gain = times * values[items]
        outside = np.where(times == counts[items], 0.0, gain)
        return np.stack([np.bincount(place, gain, texts), np.bincount(place, outside, texts)])


def answers_of(rows: Iterable[dict], order: np.ndarray, width: int) -> np.ndarray:
    """``width`` counts for each key of a block, in its own order."""
    found = [unpacked(r["counts"], np.int64).reshape(width, -1) for r in rows]
    out = np.empty((width, len(order)), np.int64)
    out[:, order] = np.concatenate(found, axis=1) if found else 0
    return out


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [*np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist(), int((counts > 0).sum()), int(counts.sum())]


def merged(rows: DataFrame, width: int, counted: int, answer: bool) -> DataFrame:
    """Buckets of the model from the blocks' ``width`` counts by key; ``seen`` is taken of count number ``counted``.

    With ``answer`` also a row per question: the totals, and whether this block is to report the key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for bucket, group in groupby(rows_of(batches), lambda r: r["bucket"]):
                asked, keys, counts = [], [], []
                for r in group:
                    asked.append((r["block"], r["part"]))
                    keys.append(unpacked_keys(r["keys"]))
                    counts.append(unpacked(r["counts"], np.int64).reshape(width, -1))
                sizes = [len(k) for k in keys]
                keys, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
                totals = np.zeros((width, len(keys)), np.int64)
                for total, part in zip(totals, np.concatenate(counts, axis=1), strict=True):
                    np.add.at(total, where, part)
                yield {"bucket": bucket, "keys": packed_keys(keys), "counts": packed(totals), "seen": counts_of_counts(totals[counted])}
                if answer:
                    own = np.zeros(len(where), np.int64)
                    own[first] = 1
                    edges = np.cumsum([0, *sizes]).tolist()
                    for (block, part), low, high in zip(asked, edges[:-1], edges[1:], strict=True):
                        yield {"bucket": bucket, "block": block, "part": part, "counts": packed(np.stack([totals[counted][where[low:high]], own[low:high]]))}

        yield from row_batches(found())

    return together(rows, "bucket", "block", "part").mapInArrow(run, ROW_TYPE)


def answered(rows: DataFrame, questions: DataFrame, buckets: int) -> DataFrame:
    """To each question the counts of its keys in the model's ``rows``, 0 for those it lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            bucket, keys, counts = None, None, None
            for r in rows_of(batches):
                if r["block"] is None:
                    bucket, keys, counts = r["bucket"], unpacked_keys(r["keys"]), unpacked(r["counts"], np.int64)
                    counts = counts.reshape(-1, len(keys))
                    continue
                asked = unpacked_keys(r["keys"])
                got = np.zeros((WORD_COUNTS if r["bucket"] < buckets else 1, len(asked)), np.int64)
                if bucket == r["bucket"]:
                    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                    known = keys[at] == asked
                    got[:, known] = counts[:, at[known]]
                yield {"bucket": r["bucket"], "block": r["block"], "part": r["part"], "counts": packed(got)}

        yield from row_batches(found())

    return together(rows.unionByName(questions), "bucket", "block", "part").mapInArrow(run, ROW_TYPE)


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of one, two, three and more."""
    n = {r["k"]: r["n"] for r in counts.filter("c <= 4").groupBy(F.col("c").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return discounts_of([n.get(k, 0) for k in (1, 2, 3, 4)])


def discounts_of(n: list[int]) -> list[float]:
    n1, n2, n3, n4 = n
    if not n1 or not n2 or not n3:
        return [0.5, 0.75, 0.9]  # too few n-grams to estimate from
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)]


def seen(rows: DataFrame) -> list[int]:
    row = rows.agg(*[F.sum(F.col("seen")[i]) for i in range(SEEN)]).first()
    return [x or 0 for x in row]


@dataclass
class Model:
    rows: DataFrame | None  # the model's buckets; tasks do without
    buckets: int  # as many of words, and after them as many of pairs
    pair_cuts: list[float]
    word_cuts: list[float]
    types: int  # distinct pairs
    free: float  # probability of an unknown word

    def values(self, block: Block, rows: Iterable[dict]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The value and the count of each word of ``block``, and of each pair, from the answers ``rows``."""
        rows = list(rows)
        times, kinds, *after = answers_of([r for r in rows if r["bucket"] < self.buckets], block.word_order, WORD_COUNTS)
        (count,) = answers_of([r for r in rows if r["bucket"] >= self.buckets], block.pair_order, 1)
        ahead = np.array([0.0, *self.word_cuts])[np.minimum(kinds, 3)]
        p1 = np.where(kinds > 0, (kinds - ahead) / self.types + self.free, 1.0)
        context = np.sum(after, axis=0) > 0
        g = np.where(context, sum(d * n for d, n in zip(self.pair_cuts, after, strict=True)) / np.maximum(times, 1), 1.0)
        single = np.where(kinds > 0, np.log(p1) - math.log(self.free), 0.0) + np.log(g)
        known = count > 0
        left, right, c = block.left[known], block.right[known], count[known]
        pair = np.zeros(len(count))
        p = (c - np.array([0.0, *self.pair_cuts])[np.minimum(c, 3)]) / times[left] + g[left] * p1[right]
        pair[known] = np.log(p) - np.log(g[left]) - np.log(p1[right])
        return (single, times), (pair, count)


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, Iterator[dict]]]:
    for _, group in groupby(rows_of(batches), lambda r: r["block"]):
        yield Block(next(group)), group


def model(trusted: DataFrame) -> tuple[Model, float]:
    """The counts of all words and word pairs of the trusted texts; and the log probability of an unknown word."""
    spark = trusted.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (Block(r) for r in rows_of(batches))
        yield from row_batches(row for b in made for row in b.pair_rows(buckets, b.times[None]))

    def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for b, answers in by_block(batches):
                # Each pair is reported by one block, so that sums over blocks count distinct pairs.
                count, own = answers_of(answers, b.pair_order, 2)
                left, n, words = b.left[own > 0], np.minimum(count[own > 0], 3), len(b.words)
                after = [np.bincount(left[n == k], minlength=words) for k in (1, 2, 3)]
                yield from b.word_rows(buckets, np.stack([np.bincount(b.found), np.bincount(b.right[own > 0], minlength=words), *after]))

        yield from row_batches(found())

    with without_old_shuffles(spark):
        texts = trusted.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("lang"), "text")
        own = settle(blocks(texts), "trusted-blocks")
        pairs = settle(merged(own.mapInArrow(pair_rows, ROW_TYPE), 1, 0, answer=True), "pairs")
        answers = pairs.filter("block IS NOT NULL")
        words = together(own.unionByName(answers), "block", "bucket", "part").mapInArrow(word_rows, ROW_TYPE)
        words = settle(merged(words, WORD_COUNTS, 1, answer=False), "vocabulary")
        discard(own)
    pairs = pairs.filter("block IS NULL")
    cuts = discounts_of(seen(pairs)[:4])
    n1, n2, n3, n4, kinds, types = seen(words)
    word_cuts = discounts_of([n1, n2, n3, n4])
    free = (word_cuts[0] * n1 + word_cuts[1] * n2 + word_cuts[2] * (kinds - n1 - n2)) / types / (kinds + 1) if kinds else 1.0
    return Model(words.unionByName(pairs), buckets, cuts, word_cuts, types or 1, free), math.log(free)


def log_likelihoods(docs: DataFrame, known: Model, unknown: float) -> DataFrame:
    """doc_id, lang, n_chars, n, full, outside: a row per row of ``docs``, with its log probability in the model, and without its own text."""
    spark, buckets = docs.sparkSession, known.buckets
    rows, weights = known.rows, replace(known, rows=None)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (Block(r) for r in rows_of(batches))
        yield from row_batches(row for b in made for some in (b.word_rows(buckets), b.pair_rows(buckets)) for row in some)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, answers in by_block(batches):
            words, pairs = weights.values(b, answers)
            sums = b.n * unknown + b.sums(b.found, b.n + 1, *words) + b.sums(b.pairs, b.n, *pairs)
            columns = [b.head[c].combine_chunks() for c in HEAD.names] + [pa.array(sums[0]), pa.array(sums[1])]
            yield pa.record_batch(columns, [*HEAD.names, "full", "outside"])

    slim = own_columns(docs, "doc_id", "lang", "text").select(F.col("doc_id").cast("long"), "lang", "text")
    scores = None
    with without_old_shuffles(spark):
        for i in range(SLICES):
            own = settle(blocks(slim.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SLICES)) == i)), "blocks")
            answers = settle(answered(rows, own.mapInArrow(ask, ROW_TYPE), buckets), "answers")
            both = together(own.unionByName(answers), "block", "bucket", "part")
            part = settle(both.mapInArrow(score, "doc_id long, lang string, n_chars long, n long, full double, outside double"), "scores")
            discard(own, answers)
            scores = part if scores is None else scores.unionByName(part)
    return scores
