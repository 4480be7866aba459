"""Hard negatives: rows of another label whose score comes close to that of an anchor's positive.

Candidates lie in Hilbert-ordered blocks with zone maps (``hilbert``).  An anchor asks in windows: a
window is a range of scores, the rows' label equal to the anchor's or not, and wants the first ``k`` by
score, ties by the smaller id.  A search goes down the zone maps: regions by their bounded table, then
blocks of a region, then the vectors of a block; each step keeps what the bounds of interval arithmetic
cannot rule out.  Anchors travel in chunks of neighbours on the curve.

The windows of positives start with what the anchor's own block holds; those of negatives are
``[least * positive, positive]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemetry_lake.llm.hilbert import Layout, hilbert_blocks, whole_vectors, zone_maps
from telemetry_lake.session import settle

CHUNK = 256  # anchors
KEPT_CHUNKS = 64  # whose best rows a task holds before it passes them on
LEAST, MOST = -(1 << 62), 1 << 62
FOUND = "chunk long, window int, score long, vec_id long"
CHUNK_ROW = "chunk long, ids binary, labels binary, homes binary, vectors binary, owners binary, lows binary, highs binary"
CHUNK_NAMES = ["chunk", "ids", "labels", "homes", "vectors", "owners", "lows", "highs"]


def chunk_batch(chunk: int, ids, labels, homes, vectors, owners, lows, highs) -> pa.RecordBatch:
    arrays = [np.asarray(x).tobytes() for x in (ids, labels, homes, vectors, owners, lows, highs)]
    return pa.record_batch([pa.array([chunk], pa.int64()), *[pa.array([a], pa.binary()) for a in arrays]], CHUNK_NAMES)


class Chunk:
    """Anchors with their windows, as read from a row."""

    def __init__(self, row: dict, layout: Layout):
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.homes = np.frombuffer(row["homes"], "<i8").reshape(-1, 2)  # block and place in it of each anchor
        self.vectors = layout.read(row["vectors"])
        self.owners, self.lows, self.highs = (np.frombuffer(row[c], "<i8") for c in ("owners", "lows", "highs"))

    def wanted(self, layout: Layout, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Zones that a window of the chunk may reach into."""
        least, most = layout.bounds(self.vectors, low, high)
        return ((most[self.owners] >= self.lows[:, None]) & (least[self.owners] <= self.highs[:, None])).any(0)


def first_rows(window: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first k of their window, in order."""
    order = np.lexsort((vec_id, -score, window))
    w = window[order]
    new = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    nth = np.arange(len(w)) - np.repeat(new, np.diff(np.concatenate([new, [len(w)]])))
    return order[nth < k]


def anchor_chunks(blocks: DataFrame, layout: Layout, every: int, k: int) -> DataFrame:
    """Anchors in chunks, each with one window: at least the k-th best score of its label in its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count, chunk = 0, None

        def out() -> pa.RecordBatch:
            ids, labels, homes, vectors, lows = (np.concatenate(x) for x in zip(*held, strict=True))
            return chunk_batch(chunk, ids, labels, homes, vectors, np.arange(len(ids), dtype="<i8"), lows, np.full(len(ids), MOST, "<i8"))

        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                vectors = layout.read(row["vectors"])
                for part in np.split(at, range(CHUNK, len(at), CHUNK)):
                    if not len(part):
                        continue
                    scores = layout.scores(vectors[part], vectors)
                    scores[labels[part][:, None] != labels] = LEAST
                    scores[np.arange(len(part)), part] = LEAST
                    lows = np.partition(scores, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(part), LEAST)
                    if held and count + len(part) > CHUNK:
                        yield out()
                        held, count = [], 0
                    if not held:
                        chunk = row["block"] * 8 + int(part[0] * 8 // len(ids))
                    homes = np.stack([np.full(len(part), row["block"]), part], 1).astype("<i8")
                    held.append((ids[part], labels[part], homes, vectors[part], lows.astype("<i8")))
                    count += len(part)
        if held:
            yield out()

    return settle(blocks.select("block", "ids", "labels", "vectors").mapInArrow(run, CHUNK_ROW), "anchors")


def search(chunks: DataFrame, blocks: DataFrame, zones: tuple[DataFrame, DataFrame], layout: Layout, k: int, same: bool) -> DataFrame:
    """chunk, window, score, vec_id, rank: the first k rows of each window of the settled ``chunks``."""
    top = zones[0].orderBy("region").collect()  # at most REGIONS rows
    regions = np.asarray([r["region"] for r in top], np.int32)
    low, high = (layout.read(b"".join(bytes(r[c]) for r in top)) for c in ("low", "high"))

    def choose_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hit = regions[Chunk(row, layout).wanted(layout, low, high)] if len(row["owners"]) else regions[:0]
                yield pa.record_batch([pa.array(np.full(len(hit), row["chunk"], np.int64)), pa.array(hit)], ["chunk", "region"])

    def choose_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = Chunk(row, layout).wanted(layout, layout.read(row["region_lows"]), layout.read(row["region_highs"]))
                hit = np.frombuffer(row["region_blocks"], "<i8")[wanted]
                yield pa.record_batch([pa.array(np.full(len(hit), row["chunk"], np.int64)), pa.array(hit)], ["chunk", "block"])

    def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[np.ndarray]] = {}

        def out(chunk: int) -> pa.RecordBatch:
            window, score, vec_id = best.pop(chunk)
            return pa.record_batch([pa.array(np.full(len(window), chunk, np.int64)), pa.array(window.astype(np.int32)), pa.array(score), pa.array(vec_id)], ["chunk", "window", "score", "vec_id"])

        for batch in batches:
            for row in batch.to_pylist():
                chunk, number = Chunk(row, layout), row["chunk"]
                ids, labels = np.frombuffer(row["block_ids"], "<i8"), np.frombuffer(row["block_labels"], "<i8")
                scores = layout.scores(chunk.vectors, layout.read(row["block_vectors"]))
                held = best.pop(number, [np.zeros(0, np.int64)] * 3)
                lows = chunk.lows.copy()
                full = np.flatnonzero(np.bincount(held[0], minlength=len(lows)) >= k)
                if len(full):  # only what beats or ties the k-th so far
                    worst = np.full(len(lows), MOST)
                    np.minimum.at(worst, held[0], held[1])
                    lows[full] = np.maximum(lows[full], worst[full])
                mine = scores[chunk.owners]
                fits = (mine >= lows[:, None]) & (mine <= chunk.highs[:, None])
                fits &= (chunk.labels[chunk.owners][:, None] == labels) == same
                here = np.flatnonzero(chunk.homes[chunk.owners, 0] == row["block"])
                fits[here, chunk.homes[chunk.owners[here], 1]] = False  # an anchor is no row of its own
                window, column = np.nonzero(fits)
                joined = [np.concatenate([h, n]) for h, n in zip(held, (window, mine[window, column], ids[column]), strict=True)]
                pick = first_rows(*joined, k)
                best[number] = [x[pick] for x in joined]
                if len(best) > KEPT_CHUNKS:
                    yield out(next(iter(best)))
        for number in list(best):
            yield out(number)

    wide = [F.col(f"l.{c}") for c in CHUNK_NAMES]
    picked = chunks.mapInArrow(choose_regions, "chunk long, region int")
    in_region = picked.join(chunks, "chunk").alias("l").join(zones[1].alias("r"), "region")
    picked = in_region.select(*wide, F.col("r.blocks").alias("region_blocks"), F.col("r.lows").alias("region_lows"), F.col("r.highs").alias("region_highs"))
    picked = settle(picked.mapInArrow(choose_blocks, "chunk long, block long"), "picked")
    rows = picked.join(chunks, "chunk").alias("l").join(blocks.alias("r"), "block")
    rows = rows.select(*wide, F.col("block"), F.col("r.ids").alias("block_ids"), F.col("r.labels").alias("block_labels"), F.col("r.vectors").alias("block_vectors"))
    order = Window.partitionBy("chunk", "window").orderBy(F.col("score").desc(), "vec_id")
    found = rows.mapInArrow(read_blocks, FOUND).withColumn("rank", F.row_number().over(order))
    return found.filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, least: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides.  For each of an anchor's first ``positives``
    other rows of its label, the first ``negatives`` rows of other labels with
    ``least * positive_score <= 100 * negative_score <= 100 * positive_score``.  Scores are inner
    products of floor(256 * x).

    Rows with a null id, label or vector, or a component that is null or not finite take no part; of
    vectors of unequal length the shorter is filled with zeros.  A repeated row is a row of its own: it
    can be the positive or negative of its twin, and a repeated anchor answers twice.  Ties go to the
    smaller id.  Other columns are not looked at.  No rows, no anchors or no negatives in a window: no
    result rows.
    """
    clean = settle(whole_vectors(vectors), "vectors")
    stats = clean.agg(F.count(F.lit(1)).alias("n"), F.max("dims").alias("dims"), F.min("low").alias("low"), F.max("high").alias("high")).first()
    layout = Layout(stats["dims"] or 0, stats["low"] or 0.0, stats["high"] or 0.0)
    blocks = hilbert_blocks(clean, layout, stats["n"])
    zones = zone_maps(blocks, layout)
    anchors = anchor_chunks(blocks, layout, every, positives)
    best = settle(search(anchors, blocks, zones, layout, positives, same=True), "positives")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                owners, scores = (np.asarray([p[c] for p in row["best"]], "<i8") for c in ("window", "score"))
                some = scores >= 0  # below zero no score lies between the two ends
                lows = -((-least * scores) // 100)
                chunk = Chunk(row, layout)
                yield chunk_batch(row["chunk"], chunk.ids, chunk.labels, chunk.homes, chunk.vectors, owners[some], lows[some], scores[some])

    # A chunk has at most CHUNK * positives of them.
    per_chunk = best.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("window", "rank", "score", "vec_id"))).alias("best"))
    asked = anchors.join(per_chunk, "chunk").select(*CHUNK_NAMES, "best")
    asking = settle(asked.mapInArrow(windows, CHUNK_ROW), "windows")
    found = settle(search(asking, blocks, zones, layout, negatives, same=False), "negatives")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                positive = [p for p in row["best"] if p["score"] >= 0]
                columns = [[], [], [], [], [], []]
                for f in row["found"]:
                    p = positive[f["window"]]
                    for column, x in zip(columns, (int(ids[p["window"]]), p["vec_id"], f["rank"], f["vec_id"], p["score"], f["score"]), strict=True):
                        column.append(x)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    # At most CHUNK * positives * negatives of them.
    per_window = found.groupBy("chunk").agg(F.collect_list(F.struct("window", "rank", "score", "vec_id")).alias("found"))
    named = anchors.select("chunk", "ids").join(per_chunk, "chunk").join(per_window, "chunk").select("ids", "best", "found")
    return named.mapInArrow(name, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
