"""Hard negatives against all pairs, and the blocks they are read from."""

import math
import random
from collections import Counter

import numpy as np

from telemetry_lake.llm.hilbert import Layout, hilbert_blocks, hilbert_keys, whole_vectors, zone_maps
from telemetry_lake.llm.negatives import anchor_chunks, hard_negatives, search

SCHEMA = "vec_id long, embedding array<float>, label int, score double, block long, region int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, label, 0.5, 7, 8) for i, e, label in rows], SCHEMA)


def brute(rows, every=100, k=5):
    whole = []
    for i, e, label in rows:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        whole.append((i, [math.floor(256 * float(np.float32(x))) for x in e], label))
    out = []
    for n, (i, e, label) in enumerate(whole):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(e, f)), j, other) for m, (j, f, other) in enumerate(whole) if m != n]
        for p, j, _ in sorted(x for x in scored if x[2] == label)[:k]:
            fits = sorted((s, m) for s, m, other in scored if other != label and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(i, j, r + 1, m, -p, -s) for r, (s, m) in enumerate(fits[:k])]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.collect())


def clustered(n, dims, seed, ids=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        e = centres[rng.integers(6)] + 0.3 * rng.normal(size=dims)
        rows.append((ids[i] if ids else i, (e / np.linalg.norm(e)).astype(np.float32).tolist(), int(rng.integers(4))))
    return rows


def test_keys_walk_the_whole_grid():
    """In two and three dimensions the curve meets every cell once, and each step moves by one cell."""
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims).astype(np.uint32)
        keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[sorted(range(len(cells)), key=keys.__getitem__)].astype(int)
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_zone_maps_hold_and_prune(spark):
    """Bounds are never beaten, and of clustered vectors an anchor's windows skip blocks."""
    import telemetry_lake.llm.hilbert as hilbert

    rows = clustered(3000, 8, 5)
    clean = whole_vectors(vectors(spark, rows))
    size, hilbert.BLOCK = hilbert.BLOCK, 64
    try:
        layout = Layout(8, -256.0, 256.0)
        blocks = hilbert_blocks(clean, layout, 3000)
    finally:
        hilbert.BLOCK = size
    held = blocks.collect()
    assert sum(r.n for r in held) == 3000 and max(r.n for r in held) <= 64
    asked = layout.matrix([np.floor(256 * np.asarray(e, np.float64)).tobytes() for _, e, _ in rows[:50]])
    for r in held:
        least, most = layout.bounds(asked, layout.read(r.low), layout.read(r.high))
        scores = layout.scores(asked, layout.read(r.vectors))
        assert (scores >= least).all() and (scores <= most).all()
    zones = zone_maps(blocks, layout)
    assert {r.region for r in zones[0].collect()} == {r.region for r in held}
    chunks = anchor_chunks(blocks, layout, 100, 5)
    assert search(chunks, blocks, zones, layout, 5, True).count() == 5 * 30
    # Of the blocks, those whose bound lies below an anchor's fifth best score of its label are never read for it.
    whole = np.floor(256 * np.asarray([e for _, e, _ in rows], np.float64))
    labels = np.asarray([label for *_, label in rows])
    scores = whole[:50] @ whole.T
    scores[labels[:50][:, None] != labels] = -np.inf
    scores[np.arange(50), np.arange(50)] = -np.inf
    fifth = np.sort(scores, axis=1)[:, -5]
    most = layout.bounds(asked, *(layout.read(b"".join(r[c] for r in held)) for c in ("low", "high")))[1]
    assert (most < fifth[:, None]).mean() > 0.5


def test_clusters(spark):
    rows = clustered(1500, 16, 1)
    assert found(hard_negatives(vectors(spark, rows))) == brute(rows)


def test_ties_copies_and_one_common_vector(spark):
    rng = random.Random(9)
    common = [0.5, -0.25, 0.1]
    rows = [(i, common if i % 3 == 0 else [rng.choice([-0.5, 0.0, 0.5, 0.25]) for _ in range(3)], rng.randrange(3)) for i in range(1300)]
    rows += rows[:40]  # repeated rows, anchors among them
    assert found(hard_negatives(vectors(spark, rows), every=50)) == brute(rows, every=50)


def test_odd_rows_and_none(spark):
    rows = [
        (None, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 1), (400, [float("inf"), 1.0], 0),
        (500, [1.0, 1.0], None), (1, [1.0, 2.0], 1), (2, [1.0], 1), (3, [], 1), (4, [2.0, 1.0], 0), (5, [1.0, 1.5, -1.0], 0), (6, [-1.0, -1.0], 0),
        (700, [-0.0, 0.0], 0), (-100, [0.5, 0.5], 0), (800, [0.001, 0.5], 7),
    ]
    assert found(hard_negatives(vectors(spark, rows))) == brute(rows)
    assert hard_negatives(vectors(spark, [])).collect() == []
    assert hard_negatives(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])).collect() == []  # no anchors


def test_numbers_beyond_float32(spark):
    """Scores past 2^24 and past 2^53 stay exact."""
    for scale in (300.0, 3.0e6):
        rows = [(i, [x * scale for x in e], label) for i, e, label in clustered(220, 4, 3)]
        assert found(hard_negatives(vectors(spark, rows))) == brute(rows)
