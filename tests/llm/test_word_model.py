"""The word model against its definition."""

import contextlib
import gc
import math
import random
import threading
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from telemetry_lake.llm import decisions, kn_quality, kn_words
from telemetry_lake.session import scratch_path

from .conftest import documents


def plain_model(texts):
    """Interpolated modified Kneser-Ney over words, order 2, by dictionaries."""
    pairs = Counter()
    for t in texts:
        w = ["<s>", *t.lower().split(), "</s>"]
        pairs.update(zip(w, w[1:]))
    kinds = Counter(v for _, v in pairs)

    def cuts(counts):
        n = Counter(counts.values())
        if not (n[1] and n[2] and n[3]):
            return [0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(j - (j + 1) * y * n[j + 1] / n[j], 0.05), j - 0.05) for j in (1, 2, 3)]

    d2, d1 = cuts(pairs), cuts(kinds)
    off = lambda d, n: d[min(n, 3) - 1] if n else 0
    free = sum(off(d1, k) for k in kinds.values()) / len(pairs)
    after = defaultdict(dict)
    for (u, v), c in pairs.items():
        after[u][v] = c

    def p(u, v):
        one = (kinds[v] - off(d1, kinds[v])) / len(pairs) + free / (len(kinds) + 1)
        if u not in after:
            return one
        total, c = sum(after[u].values()), after[u].get(v, 0)
        return (c - off(d2, c)) / total + sum(off(d2, n) for n in after[u].values()) / total * one

    return p


def test_likelihoods_against_the_definition(spark, monkeypatch):
    monkeypatch.setattr(kn_words, "BLOCK_WORDS", 9)
    monkeypatch.setattr(kn_words, "LONGEST_POSTING", 2)
    texts = ["the cat sat on the mat the dog sat", "a cat and a dog the end", "the the the the", "a b c d c d c d e e e"]
    trusted = spark.createDataFrame([(t,) for t in texts], "text string")
    asked = [*texts, "the zebra sat", "", "unknown words only", "the cat " * 20]
    values, unknown = kn_words.model(trusted)
    got = {r.doc_id: r for r in kn_words.log_likelihoods(documents(spark, list(enumerate(asked))), values, unknown).collect()}
    p = plain_model(texts)
    assert len(got) == len(asked)
    for i, t in enumerate(asked):
        w = ["<s>", *t.split(), "</s>"]
        assert got[i].full == pytest.approx(sum(math.log(p(u, v)) for u, v in zip(w, w[1:]))), t
        assert got[i].n == len(w) - 1


def test_every_script_has_its_own_words(spark):
    """Sixty-odd scripts' worth of characters: garbage in the rare one is told from its text."""
    common = ["".join(chr(0x61 + (i * 7 + j) % 26) for j in range(5)) for i in range(40)]
    greek = ["".join(chr(0x3B1 + (i * 5 + j * (i % 3 + 1)) % 17) for j in range(6)) for i in range(30)]
    text = lambda words, i: " ".join(words[(i + k * (1 + i % 2)) % len(words)] for k in range(40))
    rows = [(i, text(common, i), "en", "s") for i in range(400)] + [(1000 + i, text(greek, i), "el", "s") for i in range(60)]
    han = ["".join(chr(0x4E00 + (i + k * 3) % 50) for k in range(60)) for i in range(60)]
    rows += [(2000 + i, t, "zh", "s") for i, t in enumerate(han)]
    ids = spark.createDataFrame([(i,) for i, *_ in rows], "doc_id long")
    rows += [(5000, " ".join("".join(chr(0x3B1 + (k * k * 3 + j * j * 5) % 17) for j in range(6)) for k in range(40)), "el", "s")]
    rows += [(5001, "".join(chr(0x4E00 + (k * k * 7) % 50) for k in range(60)), "zh", "s"), (5002, text(greek, 7), "el", "s"), (5003, han[5], "zh", "s")]
    got = {r.doc_id: r.kept for r in kn_quality.quality(documents(spark, rows), ids).collect()}
    assert (got[5000], got[5001], got[5002], got[5003]) == (False, False, True, True)


def text_parts(texts):
    """The probability of an unknown word, and what each known word and word pair of the texts adds to the log probability."""
    pairs, words = Counter(), Counter()
    for t in texts:
        w = ["<s>", *t.lower().split(), "</s>"]
        pairs.update(zip(w, w[1:]))
        words.update(w)
    p = plain_model(texts)
    unknown = p("not a word", "nor this")
    left = {u for u, _ in pairs}
    right = {v for _, v in pairs}
    one = {v: p("not a word", v) for v in right}
    after = {u: p(u, "not a word") / unknown for u in left}
    single = {w: math.log(one.get(w, unknown) / unknown) + math.log(after.get(w, 1.0)) for w in words}
    double = {(u, v): math.log(p(u, v) / after[u] / one[v]) for u, v in pairs}
    return math.log(unknown), {**single, **double}, words + pairs


def test_trusted_texts_are_scored_without_their_own_words(spark, monkeypatch):
    """Also where texts repeat, share an id or have none, and whatever block, part and slice they fall in."""
    monkeypatch.setattr(kn_words, "BLOCK_WORDS", 12)
    monkeypatch.setattr(kn_words, "LONGEST_POSTING", 3)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    texts += [texts[0], texts[1], "once only words", "only here twice here twice"]
    unknown, value, counts = text_parts(texts)
    asked = [(i % 7 or None, t, None, None) for i, t in enumerate([*texts, "z y x", None])]
    found = kn_words.log_likelihoods(documents(spark, asked), *kn_words.model(spark.createDataFrame([(t,) for t in texts], "text string")))

    def expected(t):
        w = ["<s>", *(t or "").split(), "</s>"]
        own = Counter(w) + Counter(zip(w, w[1:]))
        full = sum(n * value.get(k, 0.0) for k, n in own.items())
        outside = sum(n * value.get(k, 0.0) for k, n in own.items() if n != counts[k])
        return [(len(w) - 1) * unknown + x for x in (full, outside)]

    got = sorted((r.doc_id or 0, r.n, r.full, r.outside) for r in found.collect())
    want = sorted((i or 0, len((t or "").split()) + 1, *expected(t)) for i, t, *_ in asked)
    assert len(got) == len(want)
    for g, e in zip(got, want, strict=True):
        assert g == pytest.approx(e)


def test_pairs_too_many_for_one_number(spark):
    """Where pair and text do not fit one number, they are sorted as two."""
    row = next(iter(blocks_of(spark, ["a b a b c", "b a b a", ""])))
    block = kn_words.Block(row)
    values, counts = np.arange(1.0, len(block.kinds) + 1), np.full(len(block.kinds), 2)
    short = block.sums(block.pairs, block.n, values, counts)
    block.words = range(1 << 31)
    assert np.array_equal(block.sums(block.pairs, block.n, values, counts), short)


def blocks_of(spark, texts):
    return [r.asDict() for r in kn_words.blocks(documents(spark, list(enumerate(texts))).select("doc_id", "lang", "text").coalesce(1)).collect()]


def test_texts_of_trusted_ids(spark, monkeypatch):
    """Ids that fall on one bit are told apart by a join; rows that repeat an id all count, rows without one never."""
    for bits, pages in ((8, (1, 1)), (decisions.PAGE_BITS, decisions.PAGES)):
        monkeypatch.setattr(decisions, "PAGE_BITS", bits)
        monkeypatch.setattr(decisions, "PAGES", pages)
        rows = [(i // 2 if i % 9 else None, f"text {i}", "en", "s") for i in range(120)]
        ids = spark.createDataFrame([(i,) for i in range(0, 70, 3)], "doc_id long")
        got = kn_quality.trusted_texts(documents(spark, rows), ids)
        assert sorted(r.text for r in got.collect()) == sorted(t for i, t, *_ in rows if i is not None and i % 3 == 0)


def test_disk_of_the_word_model(spark):
    """Rare words and pairs, the most costly case: at no time more than a few bytes a word lie on disk."""
    rng = np.random.default_rng(3)
    words = rng.integers(0, 60_000, (400, 1500))
    docs = documents(spark, [(i, " ".join(map(str, w)), "en", "s") for i, w in enumerate(words.tolist())]).repartition(4)
    ids = spark.range(0, 400, 3).withColumnRenamed("id", "doc_id")
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    own = Path(scratch_path(spark, "x").replace("file:", "")).parent
    folders = [own, *[Path(str(d)) for d in manager.localDirs()]]

    def used():
        total = 0
        for f in (x for folder in folders for x in folder.rglob("*")):
            with contextlib.suppress(OSError):
                total += f.stat().st_size
        return total

    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before, most, ended = used(), 0, threading.Event()

    def watch():
        nonlocal most
        while not ended.wait(0.05):
            most = max(most, used() - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert kn_quality.quality(docs, ids).count() == 400
    finally:
        ended.set()
        watcher.join()
    assert most < 20 * words.size, most / words.size
