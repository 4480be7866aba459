"""Toxic spans by a linear-chain conditional random field.

1. Evidence.  For every feature of a word (the word, its first 4 to 7 letters) the labelled
   documents that have it are counted, toxic and clean apart.  The counts cover the whole texts of at
   most ``LABELLED_DOCS`` labelled ids a class and fit a table of fixed size (features are hashed).  A feature's evidence is its log odds
   moved towards zero by some standard errors, so that a few chance meetings weigh nothing.
2. Token labels.  In a toxic document the words with strong evidence are labelled toxic, all other
   words of all documents clean.
3. Training.  Windows of tokens around labelled words, and windows of clean documents, from a bounded
   sample of labelled rows (``SAMPLE_DOCS`` per class).  Two states; one weight per kind of evidence,
   a bias and the transitions, by gradient ascent on the log likelihood with forward-backward.
4. Documents.  Forward-backward over the whole token chain of a text gives each token's chance of
   being toxic.  Their largest, their sum and their density enter a logistic function fitted on the
   same sample: one word that is toxic elsewhere does not condemn a long text.
5. Scoring.  The same for every text; stretches of tokens with a marginal of at least one half are the
   offending spans.

Labels are the only supervision; lang, source and doc_id are never looked at when scoring.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from telemetry_lake.llm.common import forget, in_small_batches, own_columns
from telemetry_lake.session import settle

BUCKETS = 1 << 22
LABELLED_DOCS = 20_000  # ids a class that the evidence is counted in
SAMPLE_DOCS = 1500  # ids a class that the weights are fitted to
WINDOW = 24
WINDOWS_PER_DOC = 4
ROUNDS = 120
ERRORS = 2.5
MARKED = 0.5
KINDS = ("word", "4", "5", "6", "7")
STRETCH = 4 << 20  # bytes of text whose chains are worked off together
REMEMBERED = 250_000  # numbers by token; lists of features take a tenth of it
PARTS = re.compile(r"\w+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def features(word: str) -> list[int]:
    """Buckets of a lower-case word's features, one per kind; -1 where the word is too short for it."""
    n = len(word)
    named = ["w" + word, *[f"{k}{word[:k]}" for k in range(4, min(n, 7) + 1)]]
    return [zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS for f in named] + [-1] * (len(KINDS) - len(named))


def parts_of(token: str) -> list[str]:
    """A white-space token's words."""
    return PARTS.findall(token.lower())


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text)


class Remembered(dict):
    """A bounded table of a function's values."""

    def __init__(self, compute, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        if len(key) < 100:
            self[key] = value
        return value


def feature_counts(labelled: DataFrame) -> DataFrame:
    """bucket, toxic, clean: in how many documents of (text, toxic) a feature occurs; all documents at bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros((2, BUCKETS + 1), np.int32)
        known = Remembered(lambda raw: [b for w in parts_of(raw.decode("utf-8", "replace")) for b in features(w) if b >= 0], REMEMBERED // 10)
        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                tokens = set((value.as_py() or "").encode("utf-8", "replace").split())
                found = {b for t in tokens for b in known[t]}
                found.add(BUCKETS)
                counts[1 if toxic > 0 else 0, np.fromiter(found, np.int64, len(found))] += 1
        some = np.flatnonzero(counts.sum(0))
        shown = np.where(some == BUCKETS, -1, some)
        yield pa.record_batch([pa.array(shown), *(pa.array(counts[y, some].astype(np.int64)) for y in (1, 0))], ["bucket", "toxic", "clean"])

    summed = labelled.select("text", "toxic").mapInArrow(run, "bucket long, toxic long, clean long")
    return summed.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Evidence:
    """The evidence of a word's features, from a table of document counts.

    Evidence is a feature's log odds moved towards zero by ``ERRORS`` standard errors.  For a document
    that was itself counted, its own contribution is taken out first: else a chance word of a toxic
    document would seem to occur in toxic documents only.
    """

    def __init__(self, buckets: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int):
        self.buckets, self.toxic, self.clean = (x.astype(np.int32) for x in (buckets, toxic, clean))
        self.sizes = (n_toxic, n_clean)
        self.tables: dict[int | None, array] = {}

    def __getstate__(self):
        return self.__dict__ | {"tables": {}}  # worked out again where it is needed

    def table(self, own: int | None) -> array:
        """Evidence by bucket, 4 bytes each; 0 at place -1.  ``own``: 1 or 0 for counted toxic or clean documents."""
        if own not in self.tables:
            toxic = np.maximum(self.toxic - (own == 1), 0) + 0.5
            clean = np.maximum(self.clean - (own == 0), 0) + 0.5
            odds = np.log(toxic / (self.sizes[0] + 1)) - np.log(clean / (self.sizes[1] + 1))
            sure = np.sign(odds) * np.maximum(np.abs(odds) - ERRORS * np.sqrt(1 / toxic + 1 / clean), 0)
            dense = np.zeros(BUCKETS + 1, np.float32)
            dense[self.buckets] = np.minimum(sure, 6.0)
            self.tables[own] = array("f", dense.tobytes())
        return self.tables[own]

    def of(self, word: str, own: int | None = None) -> list[float]:
        known = self.table(own)
        return [known[b] for b in features(word)]


def windows(labelled: DataFrame, evidence: Evidence) -> DataFrame:
    """seen (evidence by token and kind), labels: training windows of labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = [Remembered(lambda w, y=y: evidence.of(w, y), REMEMBERED // 10) for y in (0, 1)]
        for batch in batches:
            seen, labels = [], []
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = value.as_py() or ""
                words = [own[1 if toxic else 0][w] for t in tokens_of(text) for w in parts_of(t)]
                marks = [int(bool(toxic) and max(w) > MARKED) for w in words]
                # In clean documents: the words that look toxic and are not.
                hits = [i for i, w in enumerate(words) if (marks[i] if toxic else max(w) > 0)]
                if not words or toxic and not hits:
                    continue  # nothing known to tag in it
                spread = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
                starts = spread.integers(0, max(1, len(words) - WINDOW + 1), WINDOWS_PER_DOC)
                if hits:
                    starts[::2] = np.clip(spread.choice(hits, len(starts[::2])) - spread.integers(0, WINDOW, len(starts[::2])), 0, None)
                for s in starts:
                    seen.append(np.concatenate(words[s:s + WINDOW]))
                    labels.append(marks[s:s + WINDOW])
            yield pa.record_batch([pa.array(seen, pa.list_(pa.float64())), pa.array(labels, pa.list_(pa.int32()))], ["seen", "labels"])

    return labelled.select("text", "toxic").mapInArrow(run, "seen array<double>, labels array<int>")


class Model:
    """Weights of the kinds of evidence, a bias, log transition weights; the document's logistic weights."""

    def __init__(self, evidence: Evidence, weights: np.ndarray, bias: float, switch: np.ndarray):
        self.evidence, self.weights, self.bias, self.switch = evidence, [float(w) for w in weights], float(bias), switch
        self.document = np.r_[-6.0, np.zeros(4)]

    def token_odds(self, token: str, own: int | None = None) -> float:
        """A token of several words is as toxic as its most toxic one; one of no words has the bias."""
        known = self.evidence.table(own)
        words = parts_of(token)
        if not words:
            return self.bias
        return self.bias + max(sum(w * known[b] for w, b in zip(self.weights, features(x), strict=True)) for x in words)

    def score(self, node: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.document @ np.r_[1.0, summary(node)]))))


def summary(node: np.ndarray) -> np.ndarray:
    """Largest marginal, second largest, logarithm of the sum, and the sum per hundred tokens."""
    if not len(node):
        return np.asarray([0.0, 0.0, np.log(1e-2), 0.0])
    top = np.partition(node, -2)[-2:] if len(node) > 1 else np.asarray([0.0, node[0]])
    total = float(node.sum())
    return np.asarray([top[1], top[0], np.log(total + 1e-2), min(100 * total / (len(node) + 20), 10.0)])


def chains(texts, known) -> list[np.ndarray]:
    """The log odds of each text's tokens; the tokens of one text at a time are in memory."""
    out = []
    for text in texts:
        tokens = (text or "").encode("utf-8", "replace").split()
        out.append(np.fromiter(map(known.__getitem__, tokens), np.float64, len(tokens)))
    return out


def tagged(texts: pa.Array, known_of, trans: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Place and marginals of each text, longest texts first; ``known_of`` gives the table of log odds for a place.

    About ``STRETCH`` bytes of text are worked off together, so that memory does not follow the batch.
    """
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(-sizes, kind="stable")
    stretch = np.cumsum(sizes[order]) // STRETCH
    for some in np.split(order, np.flatnonzero(np.diff(stretch)) + 1):
        places = some.tolist()
        odds = [chains([texts[i].as_py()], known_of(i))[0] for i in places]
        yield from zip(places, marginals(odds, trans), strict=True)


def summaries(labelled: DataFrame, model: Model) -> DataFrame:
    """seen, toxic: what ``summary`` says of labelled documents, their own counts taken out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = [Remembered(lambda raw, y=y: model.token_odds(raw.decode("utf-8", "replace"), y)) for y in (0, 1)]
        for batch in batches:
            marks = [int(y > 0) for y in batch.column(1).to_pylist()]
            seen: list = [None] * len(marks)
            for i, node in tagged(batch.column(0), lambda i: own[marks[i]], model.switch):  # noqa: B023
                seen[i] = summary(node)
            yield pa.record_batch([pa.array(seen, pa.list_(pa.float64())), pa.array(marks, pa.int32())], ["seen", "toxic"])

    return labelled.select("text", "toxic").mapInArrow(run, "seen array<double>, toxic int")


def logistic(seen: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Weights of a logistic function by Newton's method, classes weighted to the given toxic share."""
    x = np.c_[np.ones(len(seen)), seen]
    theta = np.r_[-3.0, np.zeros(x.shape[1] - 1)]
    held = np.where(toxic == 1, share / max(toxic.mean(), 1e-9), (1 - share) / max(1 - toxic.mean(), 1e-9))
    ridge = np.diag(np.r_[0.0, np.full(x.shape[1] - 1, 1e-2)]) * len(x) / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (held * (toxic - p)) - ridge @ theta
        bend = (x * (held * p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(x.shape[1])
        theta = theta + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return theta


def train(evidence: Evidence, seen_by: list[np.ndarray], labels: list[np.ndarray]) -> Model:
    """Full-batch gradient ascent (Adam) on the windows' log likelihood."""
    k = len(KINDS)
    if not any(map(any, labels)):
        return Model(evidence, np.zeros(k), -6.0, np.zeros((2, 2)))
    rows, longest = labels, max(map(len, labels))
    mask, gold = np.zeros((len(rows), longest), bool), np.zeros((len(rows), longest))
    seen = np.zeros((len(rows), longest, k))
    for i, row in enumerate(rows):
        mask[i, : len(row)], gold[i, : len(row)] = True, row
        seen[i, : len(row)] = np.reshape(seen_by[i], (-1, k))
    both = mask[:, 1:] & mask[:, :-1]
    gold_pairs = np.asarray([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)], float)
    theta = np.r_[np.full(k, 0.5), -3.0, np.zeros(4)]
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        node, pairs = posterior(seen @ theta[:k] + theta[k], mask, theta[-4:].reshape(2, 2))
        miss = np.where(mask, gold - node, 0.0)
        slope = np.r_[np.einsum("ij,ijk->k", miss, seen), miss.sum(), (gold_pairs - pairs).reshape(-1)] / len(rows)
        slope -= 1e-3 * np.r_[theta[:k], 0.0, theta[-4:]]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(evidence, theta[:k], theta[k], theta[-4:].reshape(2, 2))


def posterior(odds: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state, and expected transition counts, of windows side by side."""
    t, u = np.exp(trans), np.exp(np.clip(odds, -30, 30))
    n = odds.shape[1]
    ahead, behind = np.empty_like(u), np.ones_like(u)
    ahead[:, 0] = u[:, 0]
    for j in range(1, n):
        ahead[:, j] = u[:, j] * (t[0, 1] + ahead[:, j - 1] * t[1, 1]) / (t[0, 0] + ahead[:, j - 1] * t[1, 0])
    for j in range(n - 2, -1, -1):
        on = mask[:, j + 1]
        x = u[:, j + 1] * behind[:, j + 1]
        behind[:, j] = np.where(on, (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x), 1.0)
    ratio = ahead * behind
    node = np.where(mask, ratio / (1 + ratio), 0.0)
    pairs = np.zeros((2, 2))
    joint = [[np.ones_like(u[:, 1:]) * t[0, 0], t[0, 1] * u[:, 1:] * behind[:, 1:]],
             [ahead[:, :-1] * t[1, 0], ahead[:, :-1] * t[1, 1] * u[:, 1:] * behind[:, 1:]]]
    total = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
    on = mask[:, 1:] & mask[:, :-1]
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = (joint[a][b] / total)[on].sum()
    return node, pairs


def marginals(odds: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """Marginals of the toxic state over whole chains: one step of all chains at a time, longest first."""
    order = sorted(range(len(odds)), key=lambda i: -len(odds[i]))
    sizes = np.asarray([len(odds[i]) for i in order], np.int64)
    flat = np.exp(np.clip(np.concatenate([odds[i] for i in order]), -30, 30)) if len(order) else np.empty(0)
    starts = np.r_[0, np.cumsum(sizes)[:-1]] if len(order) else np.empty(0, np.int64)
    ahead, behind, t = flat.copy(), np.ones_like(flat), np.exp(trans)
    longest = int(sizes[0]) if len(order) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # chains longer than j
    for j in range(1, longest):
        at = starts[: active[j]] + j
        last = ahead[at - 1]
        ahead[at] = flat[at] * (t[0, 1] + last * t[1, 1]) / (t[0, 0] + last * t[1, 0])
    for j in range(longest - 2, -1, -1):
        at = starts[: active[j + 1]] + j
        x = flat[at + 1] * behind[at + 1]
        behind[at] = (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x)
    ratio = ahead * behind
    node = ratio / (1 + ratio)
    out: list[np.ndarray] = [np.empty(0)] * len(odds)
    for place, i in enumerate(order):
        out[i] = node[starts[place]:starts[place] + sizes[place]]
    return out


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the documents whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def chosen_labels(labels: DataFrame, most: int = LABELLED_DOCS) -> tuple[DataFrame, float]:
    """doc_id, toxic: at most ``most`` labelled, not held out ids of each class, by a hash of the id.  And the toxic share of all.

    An id with a null label is not learned from; one with several labels counts as toxic if any says so.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~F.coalesce(held_out(), F.lit(True)))
    share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    classes = [known.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in ("toxic > 0", "toxic <= 0")]
    return settle(classes[0].unionByName(classes[1]), "labelled"), share


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows that are not held out, at most ``LABELLED_DOCS`` ids a class.

    Ids are chosen before any text is touched and are of bounded number, so they are broadcast and the
    texts stay where they are.  Class sizes are those of the labelled documents that exist.  Without
    labelled documents, or with those of one class alone, every score is low.
    """
    chosen, share = chosen_labels(labels)
    texts = in_small_batches(own_columns(docs, "doc_id", "text"))
    labelled = texts.join(F.broadcast(chosen), "doc_id")  # at most 2 * LABELLED_DOCS ids
    # At most BUCKETS rows; a feature of fewer toxic documents has no evidence.
    found = feature_counts(labelled).filter("toxic >= 2 OR bucket = -1").toPandas().astype(np.int64)
    everything = found["bucket"] == -1
    toxic, clean = (int(found.loc[everything, c].sum()) for c in ("toxic", "clean"))
    found = found[~everything]
    evidence = Evidence(found["bucket"].to_numpy(), found["toxic"].to_numpy(), found["clean"].to_numpy(), toxic, clean)
    turn = W.partitionBy(F.col("toxic") > 0).orderBy(F.xxhash64("doc_id"), "doc_id")
    few = chosen.withColumn("_turn", F.row_number().over(turn)).filter(F.col("_turn") <= SAMPLE_DOCS).drop("_turn")
    sample = texts.join(F.broadcast(few), "doc_id")  # at most 2 * SAMPLE_DOCS ids
    found = windows(sample, evidence).toPandas()
    model = train(evidence, found["seen"].tolist(), found["labels"].tolist())
    if toxic and clean:
        seen = summaries(sample, model).toPandas()  # a row per document of at most 2 * SAMPLE_DOCS ids
        if seen["toxic"].nunique() == 2:
            model.document = logistic(np.stack(seen["seen"]), seen["toxic"].to_numpy(), share)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with _score, _n_toxic_tokens, _spans: one row per row.

    ``_spans`` are start:end code points of the offending stretches, comma-joined.  Null, empty and
    blank texts have no tokens and the lowest score.  The other columns are passed through untouched.
    """
    added = ["_score", "_n_toxic_tokens", "_spans"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    schema = StructType([*docs.schema.fields, StructField(added[0], DoubleType()), StructField(added[1], LongType()), StructField(added[2], StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = Remembered(lambda raw: model.token_odds(raw.decode("utf-8", "replace")))
        for batch in batches:
            texts = batch.column("text")
            best, counts, spans = [0.0] * len(texts), [0] * len(texts), [""] * len(texts)
            for i, node in tagged(texts, lambda i: known, model.switch):
                best[i], counts[i] = model.score(node), int((node >= 0.5).sum())
                if counts[i]:
                    spans[i] = offending(texts[i].as_py(), node)
            found = [pa.array(best, pa.float64()), pa.array(counts, pa.int64()), pa.array(spans, pa.string())]
            yield pa.record_batch([*batch.columns, *found], names=[*batch.schema.names, *added])

    return in_small_batches(docs).mapInArrow(run, schema)


def offending(text: str, node: np.ndarray) -> str:
    """Neighbouring toxic tokens as one span."""
    spans: list[list[int]] = []
    last = -2
    for i, found in enumerate(TOKEN.finditer(text)):
        if node[i] >= 0.5:
            if last == i - 1:
                spans[-1][1] = found.end()
            else:
                spans.append([found.start(), found.end()])
            last = i
    return ",".join(f"{a}:{b}" for a, b in spans)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_tokens, spans: one row per row of ``docs``.

    A null doc_id is not held out.  Repeated rows are scored each.  An empty table gives an empty result.
    Extra columns are ignored.
    """
    scored = score(own_columns(docs, "doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"), F.col("_n_toxic_tokens").alias("n_toxic_tokens"), F.col("_spans").alias("spans"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    return score(docs, fit(docs, labels)).filter("_score < 0.5").drop("_score", "_n_toxic_tokens", "_spans")
