"""MinHash near-dedup with tensored banding.

Two small collections of min-hashes are computed, A with ``a`` bands and B with ``b`` bands of ``rows``
hashes each.  Every pair of a band of A and one of B is the key of a table: a * b tables from
(a + b) * rows hashes.  Two sets with similarity s meet in a table with chance
(1 - (1 - s^rows)^a) * (1 - (1 - s^rows)^b): 0.9994 at s = 0.8 with the values below.

Rows of a table that share a key are candidates.  They are never all paired off with each other:

1. equal sets become one class first (128-bit fingerprint of the sorted set);
2. classes that share a bucket share its smallest class, the centre.  Centre by centre, the classes it
   met come together once, with their full sets: each is compared with the centre, and those that are
   not linked to it with all others of that centre;
3. a centre that met more than ``BLOCK`` classes is done in two steps: all pairs with the centre first;
   then, where what it met still belongs to several components, the classes outside the largest one
   are held against all others, in blocks inside tasks.  Only confirmed links come out.

So every two classes that share a bucket are compared, or already known to be connected.

Most classes that meet do so by chance, and their number grows with the square of the classes.  Before
full sets are fetched, a class leaves a centre's group if its sketch shows that it is linked with nothing
there.  A sketch is the parity of the number of shingles in each of about as many cells as shingles: where
two sketches differ in d cells, the sets differ in d shingles at least.  No link is lost by that.

Buckets are cut by ranges of (key, class), so that one huge bucket is spread over many tasks.
Components come from alternating large-star and small-star rounds over written edge tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import forget, in_small_batches, own_columns
from telemetry_lake.session import settle

BANDS_A = 8
BANDS_B = 8
ROWS = 2
PERCENT = 80
REMEMBERED = 500_000
BLOCK = 512
FILTER_BITS = 26
SEGMENT_BITS = 7
SEED = 20240229
SKETCH_BITS = (64, 8192)


class ShingleHasher:
    """Distinct word shingles of a text as sorted 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def word(self, word: bytes) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        value = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def shingles(self, text: str | None) -> np.ndarray:
        # bytes.lower() and bytes.split() know A-Z and the six ASCII white-space characters only.
        words = (text or "").encode("utf-8", "replace").lower().split()
        known, new = self.known.get, self.word
        hashes = np.fromiter((known(w) or new(w) for w in words), np.uint64, len(words))
        if not len(words):
            return hashes
        take = max(1, len(words) - self.width + 1)
        out = np.full(take, min(self.width, len(words)), np.uint64)
        for i in range(min(self.width, len(words))):
            out = (out ^ hashes[i:i + take]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return np.unique(out)


def band_keys(shingles: np.ndarray, factors: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band: its min-hashes folded together."""
    least = np.empty(len(factors), np.uint64)
    for i, (odd, shift) in enumerate(factors):
        least[i] = (shingles * odd + shift).min()
    bands = least.reshape(-1, rows)
    out = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for i in range(rows):
        out = (out ^ bands[:, i]) * np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(31)
    return out


def sketch(shingles: np.ndarray) -> bytes:
    """One bit for each cell: whether an odd number of shingles lies in it.  The cells are a power of two near the set's size."""
    cells = min(max(1 << int(len(shingles) - 1).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    odd = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """A sketch with fewer cells."""
    while len(words) > n:
        words = words[: len(words) // 2] ^ words[len(words) // 2:]
    return words


def linkable(sizes: np.ndarray, sketches: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of some sets may be linked with another one of them, by sizes and sketches (as 64-bit words)."""
    order = np.argsort(sizes, kind="stable")
    sizes, kept = sizes[order], np.zeros(len(order), bool)
    # Of the larger sets those up to ``stop`` are small enough; their sketches have as many cells or more.
    stop = np.searchsorted(percent * sizes, 100 * sizes, "right")
    cells, first, held = 0, 0, np.empty((0, 0), np.uint64)
    for i in range(len(order)):
        if stop[i] < i + 2:
            continue
        if len(sketches[order[i]]) != cells:
            cells, first = len(sketches[order[i]]), i
            held = np.stack([folded(sketches[k], cells) for k in order[i:]])
        apart = np.bitwise_count(held[i + 1 - first:stop[i] - first] ^ held[i - first]).sum(axis=1, dtype=np.int64)
        near = (100 + percent) * apart <= (100 - percent) * (sizes[i] + sizes[i + 1:stop[i]])
        kept[i] |= near.any()
        kept[i + 1:stop[i]] |= near
    out = np.empty(len(order), bool)
    out[order] = kept
    return out


def signatures(docs: DataFrame, width: int, bands_a: int = BANDS_A, bands_b: int = BANDS_B, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, print_hi, print_lo, bands (a + b ints; empty for an empty set), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher, rng = ShingleHasher(width), np.random.default_rng(SEED)
        factors = rng.integers(0, 2**64, (rows * (bands_a + bands_b), 2), np.uint64)
        factors[:, 0] |= np.uint64(1)
        for batch in batches:
            sizes, high, low, bands, sketches = [], [], [], [], []
            for value in batch.column(1):
                found = hasher.shingles(value.as_py())
                mark = xxhash.xxh3_128_intdigest(found.tobytes())
                sizes.append(len(found))
                high.append((mark >> 64) - 2**63)
                low.append((mark & (2**64 - 1)) - 2**63)
                bands.append((band_keys(found, factors, rows) >> np.uint64(32)).astype(np.uint32).view(np.int32) if len(found) else np.empty(0, np.int32))
                sketches.append(sketch(found) if len(found) else b"")
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(bands, pa.list_(pa.int32())), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "print_hi", "print_lo", "bands", "sketch"],
            )

    slim = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return in_small_batches(slim).mapInArrow(run, "doc_id long, n_shingles long, print_hi long, print_lo long, bands array<int>, sketch binary")


def table_keys(classes: DataFrame, bands_a: int, bands_b: int) -> DataFrame:
    """key, rep: a row for each table and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bands = batch.column("bands").flatten().to_numpy().view(np.uint32).astype(np.uint64).reshape(batch.num_rows, bands_a + bands_b)
            left, right = bands[:, :bands_a, None], bands[:, None, bands_a:]
            keys = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + (left >> np.uint64(7)))
            keys = (keys * np.uint64(0xBF58476D1CE4E5B9)).reshape(-1)
            reps = np.repeat(batch.column("rep").to_numpy(), bands_a * bands_b)
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(reps)], ["key", "rep"])

    return classes.select("rep", "bands").mapInArrow(run, "key long, rep long")


def buckets(keys: DataFrame) -> DataFrame:
    """key, rep, centre, edge_of_task for keys with at least two classes in a task, or at a task's ends.

    Rows are dealt by ranges of (key, rep): a bucket larger than a task goes on in the next one.  The
    first and last bucket of a task are therefore marked, and joined by ``spanning``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped(key, rep, at_start: bool, at_end: bool):
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            centre = np.repeat(rep[first], size)
            ends = np.zeros(len(first), bool)
            ends[0] |= at_start
            ends[-1] |= at_end
            keep = np.repeat((size > 1) | ends, size)
            marked = np.repeat(ends, size)
            return pa.record_batch([pa.array(x[keep]) for x in (key, rep, centre, marked)], ["key", "rep", "centre", "edge"])

        key, rep, start = np.empty(0, np.int64), np.empty(0, np.int64), True
        for batch in batches:
            key, rep = np.r_[key, batch.column(0).to_numpy()], np.r_[rep, batch.column(1).to_numpy()]
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], "left"))  # the last key may go on in the next batch
            if cut:
                yield grouped(key[:cut], rep[:cut], start, False)
                key, rep, start = key[cut:], rep[cut:], False
            elif len(key) > 1_000_000:  # one huge bucket: its parts are joined like those of two tasks
                yield grouped(key[:-1], rep[:-1], True, True)
                key, rep = key[-1:], rep[-1:]
        if len(key):
            yield grouped(key, rep, start, True)

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionByRange(parts, "key", "rep").sortWithinPartitions("key", "rep")
    return dealt.mapInArrow(run, "key long, rep long, centre long, edge boolean")


def spanning(found: DataFrame) -> DataFrame:
    """The buckets with one centre per key also where a bucket lies in several tasks."""
    true_centre = found.filter("edge").groupBy("key").agg(F.min("centre").alias("least"), F.count_distinct("rep").alias("members"))
    true_centre = true_centre.filter("members > 1").select("key", "least")
    return found.join(true_centre, "key", "left").select("key", "rep", F.coalesce("least", "centre").alias("centre"))


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bit for each hashed id: ``2 ** FILTER_BITS`` bits, however many ids there are.

    The bits are set segment by segment on the executors; the driver gets the segments.
    """
    width = 1 << (FILTER_BITS - SEGMENT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            bits, owner = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for segment in np.unique(owner).tolist():
                segments.setdefault(segment, np.zeros(width, bool))[bits[owner == segment] & (width - 1)] = True
        found = [np.packbits(s, bitorder="little").tobytes() for s in segments.values()]
        yield pa.record_batch([pa.array(list(segments), pa.int64()), pa.array(found, pa.binary())], ["segment", "bits"])

    bit = F.pmod(F.xxhash64("rep"), F.lit(1 << FILTER_BITS))
    dealt = ids.select(bit.alias("bit")).withColumn("segment", F.shiftright("bit", FILTER_BITS - SEGMENT_BITS))
    out = np.zeros((1 << SEGMENT_BITS, width // 8), np.uint8)
    for row in dealt.repartition("segment").mapInArrow(run, "segment long, bits binary").collect():
        out[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def shingle_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """rep, shingles (sorted 64-bit hashes as bytes) of the documents in ``ids``, and of a few others.

    Texts are not shuffled: a filter of fixed size (8 MB) lets all wanted documents pass, and some of
    the rest by chance, which the later joins on ids leave out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(id_bits(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hasher = ShingleHasher(width)
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            wanted = np.flatnonzero(sent.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            texts = batch.column("text")
            found = [hasher.shingles(texts[i].as_py()).tobytes() for i in wanted.tolist()]
            yield pa.record_batch([batch.column("rep").take(pa.array(wanted)), pa.array(found, pa.binary())], ["rep", "shingles"])

    hashed = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").filter("rep IS NOT NULL")
    hashed = hashed.withColumn("bit", F.pmod(F.xxhash64("rep"), F.lit(1 << FILTER_BITS)))
    return hashed.mapInArrow(run, "rep long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets reach ``100 * intersection >= percent * union``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left_set"), batch.column("right_set"), strict=True):
                a, b = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    keep.append(False)
                    continue
                common = overlap(a, b)
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.record_batch([batch.column("x"), batch.column("y")], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("rep").alias("y"), F.col("shingles").alias("right_set")), "y")
    joined = joined.join(sets.select(F.col("rep").alias("x"), F.col("shingles").alias("left_set")), "x")
    return joined.select("x", "y", "left_set", "right_set").mapInArrow(run, "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for nodes with an edge (x, y).

    Large-star and small-star in turn until nothing changes: every round links a node's neighbours to
    the smallest one, so depth shrinks at a geometric rate and hubs do not grow.
    """
    edges = settle(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = large.distinct()
        star = settle(star, "edges")
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = settle(small, "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(roots)


def promising(met: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The rows (x, y) of ``met`` but those whose sketch rules out that ``y`` is linked with ``x`` or another class that ``x`` met."""
    members = met.select("x", "y").unionByName(met.select("x", F.col("x").alias("y")).distinct())
    dealt = members.join(signed.select(F.col("doc_id").alias("y"), "n_shingles", "sketch"), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept(x: int, names: list[int], sizes: list[int], sketches: list[bytes]) -> list[tuple[int, int]]:
            may = linkable(np.asarray(sizes), [np.frombuffer(s, np.uint64) for s in sketches], percent)
            return [(x, y) for y in sorted({y for y, m in zip(names, may.tolist(), strict=True) if m}) if y != x]

        centre, names, sizes, sketches, out = None, [], [], [], []
        for batch in batches:
            for x, y, n, raw in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if x != centre:
                    out += kept(centre, names, sizes, sketches) if names else []
                    centre, names, sizes, sketches = x, [], [], []
                names.append(y)
                sizes.append(n)
                sketches.append(raw)
            yield pa.record_batch([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["x", "y"])
            out = []
        out += kept(centre, names, sizes, sketches) if names else []
        yield pa.record_batch([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["x", "y"])

    return dealt.select("x", "y", "n_shingles", "sketch").repartition("x").sortWithinPartitions("x").mapInArrow(run, "x long, y long")


def group_links(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) among each centre ``x`` and the classes ``y`` it met, at most ``BLOCK`` of them."""
    members = met.select("x", "y").unionByName(met.select("x", F.col("x").alias("y")).distinct())
    dealt = members.join(sets.select(F.col("rep").alias("y"), "shingles"), "y")

    def links(centre: int, names: list[int], arrays: list[np.ndarray]) -> list[tuple[int, int]]:
        core = arrays[names.index(centre)]
        sizes = np.asarray([len(a) for a in arrays])
        found, group, minor = [], np.arange(len(names)), []
        for i, (name, own) in enumerate(zip(names, arrays, strict=True)):
            if name == centre:
                group[i] = -1
                continue
            common = overlap(core, own)
            if 100 * common >= percent * (len(core) + len(own) - common):
                found.append((centre, name))
                group[i] = -1
            else:
                minor.append(i)
        if not minor or len(names) < 3:
            return found
        index = SetIndex([arrays[i] for i in minor])
        places = np.asarray(minor)
        for o, name in enumerate(names):
            if name == centre:
                continue
            common = index.overlaps(arrays[o])
            linked = 100 * common >= percent * (sizes[places] + len(arrays[o]) - common)
            for i in places[linked]:
                if group[i] != group[o]:
                    found.append((names[i], name))
                    group[group == group[i]] = group[o]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, names, arrays, out = None, [], [], []
        for batch in batches:
            for x, y, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if x != centre:
                    out += links(centre, names, arrays) if names else []
                    centre, names, arrays = x, [], []
                names.append(y)
                arrays.append(np.frombuffer(raw.as_py(), np.uint64))
            yield pa.record_batch([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["x", "y"])
            out = []
        out += links(centre, names, arrays) if names else []
        yield pa.record_batch([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["x", "y"])

    return dealt.select("x", "y", "shingles").repartition("x").sortWithinPartitions("x").mapInArrow(run, "x long, y long")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int(np.count_nonzero(large[at] == small))


class SetIndex:
    """Sets by value: how much each of them shares with another set."""

    def __init__(self, sets: list[np.ndarray]):
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.values, self.n = values[order], len(sets)
        self.owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]

    def overlaps(self, other: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.values, other, "left"), np.searchsorted(self.values, other, "right")
        hit = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(hit)[:-1]], hit) + np.arange(hit.sum())
        return np.bincount(self.owner[at], minlength=self.n)


def unsettled(met: DataFrame, parts: DataFrame) -> DataFrame:
    """x, y, component, minor, n_met, n_minor: what centres met, where it lies in several components.

    ``minor`` marks classes outside the largest component among those that centre ``x`` met.
    """
    met = met.join(parts.select(F.col("node").alias("y"), "component"), "y", "left")
    met = met.withColumn("component", F.coalesce("component", "y"))
    sizes = met.groupBy("x", "component").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("x").agg(F.max(F.struct("n", "component")).alias("major"), F.sum("n").alias("n_met"))
    major = major.select("x", "n_met", F.col("major.component").alias("major"), (F.col("n_met") - F.col("major.n")).alias("n_minor"))
    out = met.join(major.filter("n_minor > 0"), "x")
    return out.select("x", "y", "component", (F.col("component") != F.col("major")).alias("minor"), "n_met", "n_minor")


def block_links(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) between minor classes and classes of other components that the same centre met.

    A centre's classes are cut into blocks of about ``BLOCK``; a task takes one block of minor classes
    and one of all classes, so its memory does not depend on the size of the group.
    """
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    own = lambda n: F.pmod(F.xxhash64("y"), blocks(n)).cast("int")
    every = met.select("x", "y", "component", F.lit(False).alias("asks"), own("n_met").alias("i"), F.explode(F.sequence(F.lit(0), blocks("n_minor") - 1)).alias("j"))
    asking = met.filter("minor").select("x", "y", "component", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), blocks("n_met") - 1)).alias("i"), own("n_minor").alias("j"))
    dealt = every.unionByName(asking).join(sets.select(F.col("rep").alias("y"), "shingles"), "y")

    def compare(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False).astype(bool)
        names, labels = group["y"].to_numpy(), group["component"].to_numpy()
        arrays = [np.frombuffer(v.as_buffer(), np.uint64) for c in group["shingles"].chunks for v in c]
        asking, others = np.flatnonzero(asks), np.flatnonzero(~asks)
        found: list[tuple[int, int]] = []
        if len(asking) and len(others):
            sizes = np.asarray([len(arrays[q]) for q in asking])
            index = SetIndex([arrays[q] for q in asking])
            for o in others:
                common = index.overlaps(arrays[o])
                linked = (100 * common >= percent * (sizes + len(arrays[o]) - common)) & (labels[asking] != labels[o])
                # One link into each other component is enough to join it.
                best = {labels[asking[q]]: q for q in np.flatnonzero(linked)}
                found += [(names[asking[q]], names[o]) for q in best.values()]
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["x", "y"])

    return dealt.groupBy("x", "i", "j").applyInArrow(compare, "x long, y long").distinct()


def near_groups(docs: DataFrame, width: int = 5, percent: int = PERCENT, bands_a: int = BANDS_A, bands_b: int = BANDS_B, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  A text with fewer words than
    ``width`` has its whole sequence as its one shingle; null, empty and blank texts have none and are
    linked with nothing.  Rows that repeat a doc_id share its component.  A null id joins the group of the
    other rows with its set, and is not kept there; where only null ids have a set, they stay alone.  Extra columns are ignored; an
    empty table gives an empty result.
    """
    docs = own_columns(docs, "doc_id", "text")
    signed = settle(signatures(docs, width, bands_a, bands_b, rows), "signatures")
    same_set = ["n_shingles", "print_hi", "print_lo"]
    full = signed.filter("n_shingles > 0")
    # Bands are equal inside a class; a null id is never its representative while the class has another.
    classes = full.groupBy(*same_set).agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"))
    classes = settle(classes, "classes")
    links = linked(docs, full, classes, width, percent, bands_a, bands_b)
    named = classes.select(*same_set, "rep").join(links.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select(*same_set, F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", *same_set).join(named, same_set, "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def linked(docs: DataFrame, full: DataFrame, classes: DataFrame, width: int, percent: int, bands_a: int, bands_b: int) -> DataFrame:
    """node, component over the classes with a confirmed link.  ``full``: the signatures of the texts that have shingles."""
    usable = classes.filter("rep IS NOT NULL")
    rows = spanning(settle(buckets(table_keys(usable, bands_a, bands_b)), "buckets"))
    met = settle(rows.filter("rep <> centre").select(F.col("centre").alias("x"), F.col("rep").alias("y")).distinct(), "met")
    met = met.join(met.groupBy("x").agg(F.count(F.lit(1)).alias("n")), "x")
    small = settle(promising(met.filter(f"n <= {BLOCK}"), full, percent), "promising")
    large = settle(met.filter(f"n > {BLOCK}").select("x", "y"), "large")
    wanted = small.unionByName(large)
    ids = wanted.select(F.col("x").alias("rep")).unionByName(wanted.select(F.col("y").alias("rep"))).distinct()
    sets = settle(shingle_sets(docs, ids, width), "sets")
    edges = settle(group_links(small, sets, percent), "links")
    if large.isEmpty():
        return settle(components(edges), "components")
    edges = settle(edges.unionByName(confirmed(large, sets, percent)), "links")
    parts = settle(components(edges), "components")
    rest = settle(unsettled(large, parts), "unsettled")
    if rest.isEmpty():
        return parts
    return settle(components(edges.unionByName(block_links(rest, sets, percent))), "components")
