"""Order statistics over ranges, and the model's choice of rounds, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import model, ranks

from .conftest import rows


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return 0.5
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = random.Random(3)
    data = [(g, rng.choice([rng.random(), 0.25, 0.5]), rng.choice([0, 0, 1])) for g in "abc" for _ in range(700)]
    data += [("d", rng.random(), 1) for _ in range(20)] + [("a", None, 1), ("a", 0.5, None)]
    df = spark.createDataFrame(data, "g STRING, s DOUBLE, y INT").repartition(7)
    got = {r.g: r.auc for r in ranks.auc(df, "s", "y", ["g"]).collect()}
    for g in "abcd":
        assert got[g] == pytest.approx(brute_auc([(s, y) for k, s, y in data if k == g and s is not None]), abs=1e-12)
    whole = [(s, y) for _, s, y in data if s is not None]
    assert ranks.auc(df, "s", "y").first().auc == pytest.approx(brute_auc(whole), abs=1e-12)
    assert ranks.auc(df.limit(0), "s", "y", ["g"]).count() == 0


def test_numbered_is_a_total_order(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("t"), F.hash("id").alias("k"), "id").repartition(9)
    got = ranks.numbered(df, ["t", "k", "id"]).collect()
    assert [r.before for r in sorted(got, key=lambda r: (r.t, r.k, r.id))] == list(range(5000))


def test_sums_by_group_keep_the_columns(spark):
    data = [(g, i, (i * 31) % 17) for g in (1, 2, 3) for i in range(400)]
    df = spark.createDataFrame(data, "g INT, i INT, v INT").repartition(5)
    got = ranks.sum_before(df, F.col("v"), ["i"], ["g"])
    assert got.columns == ["g", "i", "v", "before"]
    want = [(g, i, v, sum(w for h, j, w in data if h == g and j < i)) for g, i, v in data]
    assert rows(got) == sorted(want, key=repr)


def stopped_by_hand(scores, patience):
    best, since = 0, 0
    for i, s in enumerate(scores):
        if s > scores[best] or i == 0:
            best, since = i, 0
        else:
            since += 1
        if since >= patience:
            return best + 1, True
    return best + 1, False


def test_best_round_equals_training_round_by_round():
    rng = random.Random(5)
    for _ in range(500):
        scores = [round(rng.random(), 1) for _ in range(rng.randrange(1, 60))]
        patience = rng.randrange(1, 12)
        assert model.best_round(scores, patience) == stopped_by_hand(scores, patience)


def noisy(spark, n=600):
    """A label that two features give away only in part."""
    noise = lambda k: (F.abs(F.hash(F.col("id") * 31 + k)) % 1000) / 1000.0
    x, z = noise(1), noise(2)
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1717243200) + F.col("id") * 60).alias("timestamp"), F.lit("s").alias("segment"),
        x.alias("x"), z.alias("z"), ((x + z + noise(3)) > 1.7).cast("int").alias("will_have_incident"),
    )


def test_the_kept_trees_are_the_best_rounds(spark):
    """The AUC of every round equals that of the truncated model, and training keeps the first best."""
    df = noisy(spark)
    options = dict(depth=2, row_share=1.0, column_share="all")
    fitted = model.train_incident_model(df, ["x", "z"], trees=9, patience=3, **options)
    split = model.chronological_split(df)
    aucs = []
    for trees in range(1, 10):
        part = model.train_incident_model(df, ["x", "z"], trees=trees, patience=10**6, **options)
        held = split.where("NOT is_train")
        if part.stages[-1].getNumTrees == trees:  # the last round is the best so far
            aucs.append((trees, model.evaluate(held, part).first().auc))
    best = fitted.stages[-1].getNumTrees
    assert best in [t for t, _ in aucs]
    top = dict(aucs)[best]
    assert all(a <= top for t, a in aucs if t <= min(9, best + 3))
    assert all(a < top for t, a in aucs if t < best)
    pairs = [(r.p, r.y) for r in model._probability(split.where("NOT is_train"), fitted).select(F.col("probability").alias("p"), F.col("will_have_incident").alias("y")).collect()]
    assert model.evaluate(split.where("NOT is_train"), fitted).first().auc == pytest.approx(brute_auc(pairs), abs=1e-12)
