"""Candidate vectors as Parquet blocks in the order of a Hilbert curve, with zone maps.

A row of the blocks table is one block: at most ``BLOCK`` vectors that are neighbours on the curve, with
the smallest and largest value of each dimension.  Blocks of one range of the curve form a region, whose
zone map is that of its blocks; there are at most ``REGIONS``, so their zone maps are of bounded size.

Interval arithmetic bounds every inner product of a vector with a block: each dimension adds at least
``min(a * low, a * high)`` and at most ``max(a * low, a * high)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import own_columns
from telemetry_lake.session import settle

BLOCK = 1024
REGIONS = 1024
REGION_ROWS = 1 << 14
BITS = 3  # of each dimension in the curve
CLEAN = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("dims", pa.int32()), ("vector", pa.binary())])
BLOCK_ROW = "region int, block long, n int, ids binary, labels binary, vectors binary, low binary, high binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each row of cell numbers below 2^bits, as bytes that sort like it.

    The curve by Gray code: bit by bit from the top, a set bit inverts the lower bits of the first
    dimension, a clear one exchanges them between that dimension and the first.
    """
    x = cells.T.astype(np.uint32).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for d in range(dims):
            inverted = (x[d] & bit) != 0
            swapped = np.where(inverted, np.uint32(0), (x[0] ^ x[d]) & below)
            x[0] ^= np.where(inverted, below, swapped)
            x[d] ^= swapped
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[dims - 1] & np.uint32(1 << b), np.uint32((1 << b) - 1), np.uint32(0))
    x ^= flip
    planes = np.stack([(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)], 0)  # bit, dimension, row
    return np.packbits(planes.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)


def whole_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label, low, high, dims, vector: rows that can take part, components floor(scale * x) as doubles.

    Rows with a null id, label or vector, or with a component that is null or not finite (also once
    scaled) are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, lists = batch.columns
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            missing = flat.is_null().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(scale * flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
            bad = missing | ~np.isfinite(values)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            faults = np.concatenate([[0], np.cumsum(bad)])
            good = np.flatnonzero(faults[ends[1:]] == faults[ends[:-1]])
            values += 0.0  # no negative zero
            rows = [values[ends[i]:ends[i + 1]] for i in good.tolist()]
            pick = pa.array(good)
            yield pa.record_batch(
                [
                    ids.take(pick), labels.take(pick),
                    pa.array([r.min() if len(r) else 0.0 for r in rows], pa.float64()), pa.array([r.max() if len(r) else 0.0 for r in rows], pa.float64()),
                    pa.array([len(r) for r in rows], pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                schema=CLEAN,
            )

    slim = own_columns(vectors, "vec_id", "label", "embedding").filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    slim = slim.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    return slim.mapInArrow(run, "vec_id long, label long, low double, high double, dims int, vector binary")


class Layout:
    """How vectors are kept: number of dimensions (shorter ones are filled with zeros) and kind of numbers.

    Sums of products stay whole numbers, so float32 is exact while they cannot reach 2^24 and float64
    while they cannot reach 2^53; beyond that Python's integers multiply, and scores stop at 64 bits.
    """

    def __init__(self, dims: int, low: float, high: float):
        self.dims, self.low, self.high = max(dims, 1), low, high
        largest = max(abs(low), abs(high))
        reach = self.dims * max(largest, 1.0) ** 2
        self.kind = "<f4" if reach < 1 << 24 else "<f8"
        self.exact = reach < 1 << 53

    def matrix(self, rows: list[bytes]) -> np.ndarray:
        """Vectors of doubles as rows of one matrix."""
        out = np.zeros((len(rows), self.dims), self.kind)
        for i, row in enumerate(rows):
            out[i, : len(row) // 8] = np.frombuffer(row, "<f8")
        return out

    def read(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(-1, self.dims)

    def cells(self, matrix: np.ndarray) -> np.ndarray:
        width = (self.high - self.low) / (1 << BITS) or 1.0
        return np.clip((matrix - self.low) / width, 0, (1 << BITS) - 1).astype(np.uint32)

    def scores(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Inner products of all rows of the one with all of the other, exact."""
        if self.exact:
            return (left @ right.T).astype(np.int64)
        whole = [[[int(v) for v in row] for row in side.tolist()] for side in (left, right)]
        top = (1 << 63) - 1
        return np.asarray([[max(-top, min(top, sum(a * b for a, b in zip(x, y, strict=True)))) for y in whole[1]] for x in whole[0]], np.int64).reshape(len(left), len(right))

    def bounds(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible score of each vector with each zone; a little wider where rounding can show."""
        up, down = np.maximum(vectors, 0).astype(np.float64), np.minimum(vectors, 0).astype(np.float64)
        low, high = low.astype(np.float64), high.astype(np.float64)
        least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
        if self.exact:
            return least, most
        slack = 1e-9 * (np.abs(vectors).astype(np.float64) @ np.maximum(np.abs(low), np.abs(high)).T) + 1
        return least - slack, most + slack


def hilbert_blocks(clean: DataFrame, layout: Layout, rows: int) -> DataFrame:
    """The blocks table of ``rows`` settled vectors; a region is one range of the curve.

    Many equal vectors share one place on the curve: ranges are cut by place and id, so that they
    spread over regions like any others.  Vectors of a block are sorted by id.
    """
    regions = max(1, min(REGIONS, -(-rows // REGION_ROWS)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = layout.matrix(batch.column(2).to_pylist())
            keys = hilbert_keys(layout.cells(matrix), BITS)
            yield pa.record_batch([pa.array([k.tobytes() for k in keys], pa.binary()), *batch.columns[:2], pa.array([m.tobytes() for m in matrix], pa.binary())], ["place", "vec_id", "label", "vector"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def blocks(all_: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            table = pa.Table.from_batches(held)
            at = 0
            while table.num_rows - at >= (1 if all_ else BLOCK):
                part = table.slice(at, BLOCK)
                order = np.argsort(part["vec_id"].to_numpy(), kind="stable")
                matrix = layout.read(b"".join(part["vector"].to_pylist()))[order]
                columns = [
                    [region], [(region << 40) + made], [len(order)], [part["vec_id"].to_numpy()[order].astype("<i8").tobytes()],
                    [part["label"].to_numpy()[order].astype("<i8").tobytes()], [matrix.tobytes()], [matrix.min(0).tobytes()], [matrix.max(0).tobytes()],
                ]
                kinds = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["region", "block", "n", "ids", "labels", "vectors", "low", "high"])
                at += len(order)
                made += 1
            held = table.slice(at).to_batches()

        for batch in batches:
            held.append(batch.select(["vec_id", "label", "vector"]))
            if sum(b.num_rows for b in held) >= BLOCK:
                yield from blocks(False)
        if held:
            yield from blocks(True)

    keyed = clean.select("vec_id", "label", "vector").mapInArrow(placed, "place binary, vec_id long, label long, vector binary")
    keyed = keyed.repartitionByRange(regions, "place", "vec_id").sortWithinPartitions("place", "vec_id")
    return settle(keyed.mapInArrow(cut, BLOCK_ROW), "hilbert-blocks")


def zone_maps(blocks: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """By region: its own zone map, and those of its blocks (at most as many as a region has blocks)."""
    children = blocks.groupBy("region").agg(F.sort_array(F.collect_list(F.struct("block", "low", "high"))).alias("zones"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, zones in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = (layout.read(b"".join(z[side] for z in zones)) for side in ("low", "high"))
                columns = [[region], [np.asarray([z["block"] for z in zones], "<i8").tobytes()], [low.tobytes()], [high.tobytes()], [low.min(0).tobytes()], [high.max(0).tobytes()]]
                yield pa.record_batch([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(columns)], ["region", "blocks", "lows", "highs", "low", "high"])

    zones = settle(children.mapInArrow(fold, "region int, blocks binary, lows binary, highs binary, low binary, high binary"), "zones")
    return zones.select("region", "low", "high"), zones.select("region", "blocks", "lows", "highs")
