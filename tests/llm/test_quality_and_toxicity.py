"""Quality rules, the language model and toxicity."""

import itertools
import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from telemetry_lake.llm import kn_quality, quality_rules, toxicity
from telemetry_lake.llm.queries import QUERIES

from .conftest import ODD, documents


def base(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    at = {}
    for k in range(len(words) - 4):
        at.setdefault(tuple(words[k:k + 5]), []).append(k)
    covered = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


REPEATS = [
    (20, "a b c d e " * 3), (21, "a b c d e f a b c d e g"), (22, "x x x x x x x"), (23, "line\nline\n\n#*\nline " + "q " * 30),
    (24, " ".join(f"t{i}" for i in range(40)) + " t3 t4 t5 t6 t7 t8 t9"),
]


def test_measures(spark):
    rows = ODD + REPEATS
    got = quality_rules.quality(documents(spark, rows)).collect()
    want = Counter((i, *base(t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_thresholds_follow_the_group(spark):
    """The same rate passes where it is usual and fails where it is not."""
    usual = lambda i: " ".join(f"u{i}x{k} #" for k in range(20))
    plain = lambda i: " ".join(f"p{i}x{k} word" for k in range(20))
    rows = [(i, usual(i), "en", "code") for i in range(250)] + [(1000 + i, plain(i), "en", "prose") for i in range(250)] + [(5000, usual(9999), "en", "prose")]
    got = {r.doc_id: (r.kept, r.reason) for r in quality_rules.quality(documents(spark, rows)).collect()}
    assert got[3] == (True, "") and got[1003] == (True, "") and got[5000] == (False, "symbols")


def test_quality_of_nothing(empty):
    assert quality_rules.quality(empty).collect() == []


def test_chain_marginals_against_enumeration():
    rng = np.random.default_rng(5)
    trans = rng.normal(size=(2, 2))
    chains = [rng.normal(size=n) for n in (5, 1, 0, 7, 3)]
    for odds, got in zip(chains, toxicity.marginals(chains, trans), strict=True):
        weight = np.zeros(len(odds))
        total = 0.0
        for path in itertools.product((0, 1), repeat=len(odds)):
            w = math.exp(sum(o for o, s in zip(odds, path, strict=True) if s) + sum(trans[a, b] for a, b in itertools.pairwise(path)))
            total += w
            weight += w * np.asarray(path)
        assert np.allclose(got, weight / total if len(odds) else [])


def test_training_gradient_against_differences():
    """The expected counts are the slope of the log partition function."""
    rng = np.random.default_rng(2)
    odds, trans, mask = rng.normal(size=(1, 4)), rng.normal(size=(2, 2)), np.ones((1, 4), bool)

    def log_sum(t):
        return math.log(sum(
            math.exp(sum(odds[0, i] for i in range(4) if p[i]) + sum(t[a, b] for a, b in itertools.pairwise(p)))
            for p in itertools.product((0, 1), repeat=4)
        ))

    _, pairs = toxicity.posterior(odds, mask, trans)
    for a, b in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert pairs[a, b] == pytest.approx((log_sum(trans + step) - log_sum(trans - step)) / 2e-5, abs=1e-5)


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op4_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = sum(r.predicted == r.toxic for r in held)
    assert right >= 0.95 * len(held)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.02 * len(held)


def test_toxic_spans(spark):
    texts = [(i, f"plain words number {i} stand here and there") for i in range(60)]
    texts += [(100 + i, f"plain words Vilefoo, Vilebar{i % 3} stand {i} here") for i in range(60)]
    docs = documents(spark, texts + ODD)
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in texts] + [(7, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert got[101].predicted == 1 and got[1].predicted == 0 and got[2].predicted == 0
    assert got[101].spans == "12:29" and got[7].spans == ""
    kept = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {i for i, *_ in texts + ODD if i < 100}


def test_toxicity_without_rows_or_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(empty, none).collect() == []
    assert {r.predicted for r in toxicity.toxicity(odd, none).collect()} == {0}


def plain_model(texts, alphabet):
    """Interpolated modified Kneser-Ney by dictionaries, from its definition."""
    order, symbols = kn_quality.ORDER, kn_quality.SYMBOLS
    grams = Counter()
    for t in texts:
        s = [1] * (order - 1) + [int(alphabet.table[p]) if p < 0x10000 else 0 for p in map(ord, t.lower())]
        grams.update(tuple(s[i:i + order]) for i in range(len(s) - order + 1))
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {}
    for k, c in counts.items():
        n = Counter(c.values())
        if not (n[1] and n[2] and n[3]):
            cut[k] = [0.5, 0.75, 0.9]
            continue
        y = n[1] / (n[1] + 2 * n[2])
        cut[k] = [min(max(j - (j + 1) * y * n[j + 1] / n[j], 0.05), j - 0.05) for j in (1, 2, 3)]

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / symbols
        after = {g: n for g, n in counts[k].items() if g[:-1] == gram[:-1]}
        below = p(gram[1:])
        if not after:
            return below
        off = lambda n: cut[k][min(n, 3) - 1] if n else 0
        total, n = sum(after.values()), counts[k][gram]
        return (n - off(n)) / total + sum(map(off, after.values())) / total * below

    return p


def test_model_against_its_definition(spark):
    texts = ["the cat sat on the mat. the dog sat", "a cat and a dog; the end 😀", "é"]
    trusted = spark.createDataFrame([(t,) for t in texts], "text string")
    alphabet = kn_quality.Alphabet(kn_quality.frequent_characters(trusted))
    table = kn_quality.log_table(kn_quality.model_tables(kn_quality.gram_counts(trusted, alphabet)))
    p = plain_model(texts, alphabet)
    for gram in [(1, 1, 1, 5), (1, 2, 3, 4), (0, 0, 0, 0), (7, 3, 2, 1), *[tuple(int(x) for x in np.random.default_rng(i).integers(0, 16, 4)) for i in range(40)]]:
        code = ((gram[0] * 48 + gram[1]) * 48 + gram[2]) * 48 + gram[3]
        assert math.exp(table[code]) == pytest.approx(p(gram), rel=1e-4)
    assert np.allclose(np.exp(table.astype(float)).reshape(-1, kn_quality.SYMBOLS).sum(1), 1, atol=1e-4)


def test_language_model_keeps_clean_text(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op9_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.5 * len(bad)


def test_language_model_of_odd_rows(spark, odd, empty):
    ids = spark.createDataFrame([(6,), (9,), (None,)], "doc_id long")
    got = kn_quality.quality(odd, ids).collect()
    assert len(got) == len(ODD)
    assert {r.doc_id for r in got if r.perplexity is None} == {1, 2} and not any(r.kept for r in got if r.perplexity is None)
    assert kn_quality.quality(empty, ids).collect() == []
    assert all(r.kept == (r.perplexity is not None) for r in kn_quality.quality(odd, ids.limit(0)).collect())


def test_chains_of_a_batch_take_bounded_memory():
    """As all chains at once, with a fraction of their memory."""
    rng = np.random.default_rng(5)
    texts = pa.array([None, "", *[" ".join(f"w{w}" for w in rng.integers(0, 900, n)) for n in rng.integers(1, 9000, 700)]], pa.string())
    known = {f"w{i}".encode(): float(x) for i, x in enumerate(rng.normal(-2, 2, 900))}
    trans = np.asarray([[0.3, -0.2], [0.1, 0.6]])
    want = toxicity.marginals(toxicity.chains((t.as_py() for t in texts), known), trans)
    tracemalloc.start()
    sums = {i: float(node.sum()) for i, node in toxicity.tagged(texts, lambda i: known, trans)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [sums[i] for i in range(len(texts))] == [float(node.sum()) for node in want]
    assert peak < 3 * 8 * sum(map(len, want))  # all at once: seven numbers a token
