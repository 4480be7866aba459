"""Periodic runs against a scan over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq

from telemetry_lake.llm.queries import QUERIES
from telemetry_lake.llm.runs import SquareCatcher, merged, periodic_runs, runs_of_texts

from .conftest import ODD, documents


def brute(words, least=12):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(2 * p, least):
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in out.items())


def text(rng):
    n = rng.randrange(0, 160)
    words = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(n)]
    if rng.random() < 0.6 and n > 3:
        a, p = rng.randrange(n), rng.randrange(1, n)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return [w.encode() for w in words]


def test_runs_of_many_texts_at_once():
    rng = random.Random(1)
    for _ in range(500):
        texts, least = [text(rng) for _ in range(rng.choice([1, 2, 7]))], rng.choice([12, 2, 5])
        assert runs_of_texts(texts, least) == [brute(t, least) for t in texts]


def test_words_appended_in_any_portions():
    rng = random.Random(2)
    for _ in range(300):
        words, number = text(rng), {}
        codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        catcher, at = SquareCatcher(), 0
        while at < len(codes):
            size = rng.choice([1, 1, 3, 20, 200])
            catcher.append(codes[at:at + size])
            at += size
        assert merged(catcher.stretches()) == brute(words)


def test_long_texts_of_one_word_and_of_a_long_period():
    assert runs_of_texts([[b"a"] * 100_000]) == [[(0, 100_000, 1)]]
    assert runs_of_texts([[b"%d" % (i % 7777) for i in range(50_000)]]) == [[(0, 50_000, 7777)]]


def test_rows(spark, empty):
    rows = [*ODD, (20, "a b " * 9, "en", "s"), (None, "x " * 12, "en", "s"), (21, "x " * 11, "en", "s")]
    docs = documents(spark, rows)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()), key=repr)
    want = []
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        runs = brute(words) if len(words) < 1000 else []
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        want.append((i, len(words), runs, b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    assert got == sorted(want, key=repr)
    assert periodic_runs(empty).collect() == []


def test_query(spark, sf_dir, tmp_path):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    looped = 0
    want = {}
    for i, t, *_ in rows + [(i, t, "en", "s") for i, t, *_ in ODD if i != 9]:
        words, h = (t or "").encode().split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            looped += 1
        if n > 5000:
            continue
        runs = brute(words)
        gone = {k for s, m, p in runs for k in range(s + p, s + m)}
        top = min(((-m, s, p) for s, m, p in runs), default=None)
        want.setdefault(i, []).append((
            len(runs), *((top[1], -top[0], top[2], -1000 * top[0] // top[2]) if top else (None,) * 4),
            hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest(),
        ))
    documents(spark, rows + [(i, t, "en", "s") for i, t, *_ in ODD if i != 9]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert looped > 5 and len(want) > 150
    assert all(sorted(got[i], key=repr) == sorted(w, key=repr) for i, w in want.items() if len(w) == len(got[i]))
    assert sum(len(w) == len(got[i]) for i, w in want.items()) > 150
