"""Incident-risk model: split, weight, train, score, evaluate, all on Spark ML."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import ratio, round_to
from telemetry_lake.operators import ranks
from telemetry_lake.operators.features import EVENT_FEATURES, feature_columns
from telemetry_lake.session import settle

# fixed values
TRAIN_SHARE = 0.8
ALERT_THRESHOLD = 0.6
TREES, DEPTH, STEP, ROW_SHARE, COLUMN_SHARE, SEED = 300, 6, 0.05, 0.8, "0.8", 42
PATIENCE = 30
LABEL = "will_have_incident"


def chronological_split(
    df: DataFrame, share: float = TRAIN_SHARE, time_col: str = "timestamp", ties: Sequence[str] = ("segment",)
) -> DataFrame:
    """Add ``is_train``: exactly the earliest ``share`` of rows, rounded down.

    Rows of one moment are ordered by ``ties``, so the cut may fall inside a moment that many rows
    share.  Ranks come from ranges (``ranks``): no task sorts the table.  Missing times come first.
    """
    placed = ranks.numbered(df, [time_col, *[c for c in ties if c in df.columns]])
    train = F.floor(F.lit(share) * df.select(F.count(F.lit(1))).scalar())
    return placed.withColumn("is_train", F.col("before") < train).drop("before")


def class_weight(df: DataFrame, label: str = LABEL, among: Column | None = None) -> DataFrame:
    """Add ``weight``: negatives per positive for positives, 1 for negatives; counted over ``among``."""
    counted = df if among is None else df.where(among)
    negative = F.count(F.when(F.col(label) == 0, 1))
    positive = F.greatest(F.count(F.when(F.col(label) == 1, 1)), F.lit(1))
    balance = counted.select((negative / positive).alias("w")).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, balance).otherwise(F.lit(1.0)))


def one_class_augment(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Where all rows share a label, add each row again with its events zeroed and the label flipped."""
    first, last = df.select(F.min(label)).scalar(), df.select(F.max(label)).scalar()
    zeroed = [c for c in EVENT_FEATURES if c in df.columns and c != "event_count"]
    kinds = dict(df.dtypes)
    mirrored = df.withColumns({c: F.lit(0).cast(kinds[c]) for c in zeroed}).withColumn(label, (1 - F.col(label)).cast("int"))
    return df.unionByName(mirrored.where(first == last))


def round_aucs(model: GBTClassificationModel, held_out: DataFrame, label: str = LABEL) -> list[float]:
    """AUC on ``held_out`` (features, label) of the ensemble's first tree, first two trees, and so on.

    One pass: a row's leaves give its score after every round, and all rounds are ranked together.
    """
    leaves = [
        [weight * float(v) for v in re.findall(r"Predict: (\S+)", tree)]
        for weight, tree in zip(model.treeWeights, re.split(r"\n\s*Tree \d+ ", model.toDebugString)[1:], strict=True)
    ]
    values = F.from_json(F.lit(json.dumps(leaves)), "array<array<double>>")  # as many numbers as the model has leaves
    placed = model.copy({model.leafCol: "_leaf"}).transform(held_out.select("features", label))
    steps = F.transform(vector_to_array("_leaf"), lambda leaf, i: F.element_at(F.element_at(values, i + 1), leaf.cast("int") + 1))
    upto = F.aggregate(
        steps,
        F.array().cast("array<double>"),
        lambda done, step: F.array_append(done, F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0.0)) + step),
    )
    rounds = placed.select(label, F.posexplode(upto).alias("round", "score"))
    rows = {r["round"]: r.auc for r in ranks.auc(rounds, "score", label, ["round"]).collect()}  # a row per round
    return [rows.get(i, 0.5) for i in range(len(leaves))]


def best_round(scores: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """The first round with the best score, counted from 1, and whether ``patience`` rounds without a better one followed it.

    What comes after those rounds is not looked at: training would have stopped there.
    """
    best = 0
    for i, score in enumerate(scores):
        if score > scores[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def train_incident_model(
    df: DataFrame,
    features: Sequence[str] | None = None,
    *,
    trees: int = TREES,
    patience: int = PATIENCE,
    depth: int = DEPTH,
    step: float = STEP,
    row_share: float = ROW_SHARE,
    column_share: str = COLUMN_SHARE,
    seed: int = SEED,
) -> PipelineModel:
    """Boosted trees on the earliest rows; the AUC on the later ones decides how many of ``trees`` are kept.

    Trees are grown in stretches of twice the length, since a tree depends only on those before it:
    the first ``patience + 1`` rounds already decide most trainings.  The model holds the trees up to
    the best round.
    """
    features = list(features or feature_columns(df))
    ready = class_weight(chronological_split(one_class_augment(df)), among=F.col("is_train"))
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    # written once, so that every stretch grows the same trees from the same partitions
    ready = settle(assembler.transform(ready).select("features", LABEL, "weight", "is_train"), "training")
    train, held_out = ready.where("is_train"), ready.where("NOT is_train")

    def grown(rounds: int) -> GBTClassificationModel:
        return GBTClassifier(
            labelCol=LABEL,
            featuresCol="features",
            weightCol="weight",
            maxIter=rounds,
            maxDepth=depth,
            stepSize=step,
            subsamplingRate=row_share,
            featureSubsetStrategy=column_share,
            seed=seed,
        ).fit(train)

    rounds = min(trees, patience + 1)
    while True:
        model = grown(rounds)
        best, stopped = best_round(round_aucs(model, held_out), patience)
        if stopped or rounds >= trees:
            break
        rounds = min(trees, 2 * rounds)
    return PipelineModel(stages=[assembler, model if best == rounds else grown(best)])


def _probability(df: DataFrame, model: PipelineModel) -> DataFrame:
    needed = model.stages[0].getInputCols()
    absent = {c: F.lit(0.0) for c in needed if c not in df.columns}
    scored = model.transform(df.withColumns(absent) if absent else df)
    return scored.withColumn("probability", vector_to_array("probability")[1])


def score_segments(df: DataFrame, model: PipelineModel, scored_at, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Rows for the prediction log.  Features the table lacks count as 0."""
    scored_at = scored_at if isinstance(scored_at, Column) else F.lit(scored_at).cast("timestamp")
    context = {"speed": "speed", "congestion": "congestion_ratio", "weather_risk": "weather_risk", "active_events": "active_events"}
    return _probability(df, model).select(
        "timestamp",
        "segment",
        F.expr(round_to("probability", 4)).alias("alert_prob"),
        (F.col("probability") >= threshold).cast("int").alias("will_alert"),
        *[
            (F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")).alias(name)
            for name, c in context.items()
        ],
        scored_at.alias("scored_at"),
    )


def evaluate(df: DataFrame, model: PipelineModel, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """One row: the metrics of ``score_metrics`` for the model's probabilities on ``df``."""
    return score_metrics(_probability(df, model), "probability", LABEL, threshold)


def score_metrics(scored: DataFrame, score: str = "probability", label: str = LABEL, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """One row: rows, exact AUC (0.5 with one class), precision, recall, F1 at the threshold (0 where undefined)."""
    scored = scored.select(F.col(label).alias("y"), F.col(score).alias("p"))
    hit, actual = F.col("p") >= threshold, F.col("y") == 1
    counts = scored.agg(
        F.count(F.when(hit & actual, 1)).alias("tp"),
        F.count(F.when(hit & ~actual, 1)).alias("fp"),
        F.count(F.when(~hit & actual, 1)).alias("fn"),
        F.count(F.lit(1)).alias("rows"),
    )
    area = F.coalesce(ranks.auc(scored, "p", "y").select("auc").scalar(), F.lit(0.5))
    return counts.select(
        "rows",
        area.alias("auc"),
        F.expr(f"coalesce({ratio('tp', 'tp + fp')}, 0D)").alias("precision"),
        F.expr(f"coalesce({ratio('tp', 'tp + fn')}, 0D)").alias("recall"),
        F.expr(f"coalesce({ratio('2 * tp', '2 * tp + fp + fn')}, 0D)").alias("f1"),
    )


def top20_feature_importance(model: PipelineModel, limit: int = 20) -> DataFrame:
    """The model's own importances, greatest first; one number per feature."""
    names, weights = model.stages[0].getInputCols(), model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(F.desc("importance"), "feature").limit(limit)

