"""Exact, near and line dedup against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from telemetry_lake.llm import exact, lines, minhash
from telemetry_lake.llm.queries import QUERIES

from .conftest import ODD, documents


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_components(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    ra, rb = root(a), root(b)
                    parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def near(df, width):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(df, width).collect()}


@pytest.mark.parametrize("width", [2, 5])
def test_near_groups_of_the_documents(spark, sf_dir, width):
    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = brute_components([(r["doc_id"], r["text"]) for r in rows], width)
    assert near(spark.read.parquet(f"{sf_dir}/documents.parquet"), width) == want


@pytest.mark.parametrize("block", [8, 512])
def test_a_large_group_of_near_copies_of_near_copies(spark, monkeypatch, block):
    """Copies of copies: the smallest id is too far from many, which are near to others."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(7)
    words = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts, pool = [], [words]
    for i in range(150):
        copy = list(pool[rng.randrange(len(pool))])
        for _ in range(rng.choice([1, 3, 6, 12])):
            copy[rng.randrange(len(copy))] = f"n{i}x{rng.randrange(100)}"
        pool.append(copy)
        texts.append(" ".join(copy))
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(900 + i, f"passage {' '.join(words[:60])} {' '.join(f'o{i}y{k}' for k in range(40))}") for i in range(60)]
    assert near(documents(spark, rows), 2) == brute_components(rows, 2)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(70)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_one_bucket_over_many_tasks(spark):
    keys = spark.createDataFrame([(5, i) for i in range(1000)] + [(i, 10_000 + i) for i in range(100, 200)], "key long, rep long")
    rows = minhash.spanning(minhash.buckets(keys)).collect()
    assert {(r.key, r.centre) for r in rows if r.key == 5} == {(5, 0)}
    assert sum(r.key == 5 for r in rows) == 1000


def test_near_groups_of_odd_rows(spark, odd, empty):
    rows = sorted(tuple(r) for r in minhash.near_groups(odd, 2).select("doc_id", "n_shingles", "component_id", "kept").collect())
    want = brute_components([(i, t) for i, t, *_ in ODD], 2)
    assert rows == sorted((i, *want[i]) for i, *_ in ODD)
    assert minhash.near_groups(empty).collect() == []


def test_near_groups_of_a_null_id(spark):
    rows = {r.doc_id: r.component_id for r in minhash.near_groups(documents(spark, [(None, "a b c d e f"), (4, "x y z")]), 2).collect()}
    assert rows == {None: None, 4: 4}


def test_exact_groups_of_odd_rows(spark, odd, empty):
    def plain(t):
        return re.sub("[\x20\x09-\x0d]+", " ", t or "")

    groups = Counter(plain(t) for _, t, *_ in ODD)
    least = {}
    for i, t, *_ in ODD:
        least[plain(t)] = min(i, least.get(plain(t), i))
    want = sorted((i, least[plain(t)], groups[plain(t)], least[plain(t)] == i, hashlib.sha256(plain(t).encode()).hexdigest()) for i, t, *_ in ODD)
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in exact.exact_groups(odd).collect())
    assert got == want
    assert exact.exact_groups(empty).collect() == []


def test_exact_groups_over_many_runs(spark):
    rows = [(i, f"text {i % 7}" if i % 3 else f"own {i}") for i in range(400)]
    got = exact.exact_groups(documents(spark, rows).repartition(23)).collect()
    for r in got:
        members = [i for i, t in rows if t == dict(rows)[r.doc_id]]
        assert (r.keep_id, r.group_size) == (min(members), len(members))


def test_lines(spark, empty):
    rows = [(i, f"menu\nbody {i}\n\nmenu\n  foot  ", "en", "a" if i else "b") for i in range(30)] + [(50, None, "en", "a"), (51, "menu", "en", "a"), (52, "menu", "en", None)]
    got = {r.doc_id: (r.text, r.dropped_lines) for r in lines.drop_lines(documents(spark, rows), ratio=0.5).collect()}
    assert got[1] == ("menu\nbody 1\n\nmenu\n  foot  ", 0)  # the first page of its host keeps them
    assert got[2] == ("body 2\n", 3) and got[0][1] == 0
    assert got[51] == ("", 1) and got[50] == (None, 0) and got[52] == ("menu", 0)
    assert lines.drop_lines(empty).collect() == []


def test_line_counts_of_odd_rows(odd):
    assert lines.drop_lines(odd).count() == len(ODD)


def test_rerun_is_equal(spark, sf_dir):
    first = sorted(map(tuple, QUERIES["op1_minhash_dedup"](spark, sf_dir).collect()))
    assert first == sorted(map(tuple, QUERIES["op1_minhash_dedup"](spark, sf_dir).collect()))


def test_a_null_id_among_copies(spark):
    """A null id shares its text with two rows, and all three are near a fourth."""
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text), (7, text), (9, text), (5, text.replace("w50 ", "other ")), (3, "something else altogether")]
    got = minhash.near_groups(documents(spark, rows), 2).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, 5, False), (3, 3, True), (5, 5, True), (7, 5, False), (9, 5, False)]


def test_pipeline_drops_a_copy_without_an_id(spark, sf_dir):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text), (7, text), (9, text), (None, "nobody has this text but this row alone")]
    got = corpus_pipeline.near_dedup_stage(spark, documents(spark, rows), sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, rows[3][1]), (7, text)]


def test_sketches_rule_out_no_link():
    """Whatever sizes, numbers of cells and similarities: a set with a link stays, most sets without one go."""
    rng = np.random.default_rng(11)
    sets = []
    for n in (1, 3, 40, 63, 64, 65, 120, 130, 500, 1100, 9000):
        base = rng.integers(0, 2**64, n, np.uint64)
        for lost in (0, n // 20, n // 10, n // 9, n // 8, n // 5, n // 2):
            sets.append(np.unique(np.r_[base[lost:], rng.integers(0, 2**64, lost, np.uint64)]))
        sets += [np.unique(rng.integers(0, 2**64, n, np.uint64)) for _ in range(5)]
    sizes = np.asarray([len(s) for s in sets])

    def linked(a, b):
        common = minhash.overlap(a, b)
        return 100 * common >= 80 * (len(a) + len(b) - common)

    want = np.asarray([any(linked(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)])
    got = minhash.linkable(sizes, [np.frombuffer(minhash.sketch(s), np.uint64) for s in sets], 80)
    assert got[want].all() and want.any()
    assert got[~want].sum() < 0.2 * (~want).sum()


def test_chance_meetings_fetch_no_sets(spark, monkeypatch):
    """Full sets are fetched for classes that may be linked, not for all that share a bucket."""
    fetched = []
    whole = minhash.shingle_sets

    def watched(docs, ids, width):
        fetched.extend(r.rep for r in ids.collect())
        return whole(docs, ids, width)

    monkeypatch.setattr(minhash, "shingle_sets", watched)
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(i, f"{shared} {' '.join(f'o{i}y{k}' for k in range(60))}") for i in range(40)]
    rows += [(100, " ".join(f"w{i}" for i in range(120))), (101, " ".join(f"w{i}" for i in range(118)))]
    assert near(documents(spark, rows), 2) == brute_components(rows, 2)
    assert set(fetched) == {100, 101}
