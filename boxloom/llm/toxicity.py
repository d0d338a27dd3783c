"""Toxicity scores by non-negative positive-unlabelled learning.

Features are words, and their first four to six letters, that occur in a document.
The training rows are a bounded sample: at most POSITIVES confirmed toxic documents,
and about UNLABELLED of all documents, whose labels are not looked at. All features
in LEAST_DOCS positives or more, whose shares in the two samples differ by LEAST_GAP
standard errors or more, are kept. A logistic score over these is trained in numpy on
the non-negative risk: prior * loss of positives as toxic + max(0, loss of unlabelled
as clean - prior * loss of positives as clean), where a negative bracket is stepped
back. The prior is the toxic share of the training labels. The samples bound the model,
so it travels to the executors as a broadcast.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .codec import release, trim

POSITIVES, UNLABELLED = 20_000, 40_000
LEAST_DOCS, LEAST_GAP = 5, 4.0
THRESHOLD = 0.3
STEPS, BATCH, RATE, DECAY = 600, 2048, 0.02, 1e-4
EDGES = ".,;:!?\"'()[]{}<>*&%$#|~_-+=/\\"
#: Words that a worker remembers at most.
MAX_WORDS = 200_000


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned: crc32 of the id's text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def forms(word: str) -> list[str]:
    """The features of a lower-case word: itself, and ^ with its first letters."""
    word = word.strip(EDGES)
    return [word, *("^" + word[:k] for k in (4, 5, 6) if len(word) > k)] if word else []


class Finder:
    """ids(text): the sorted numbers of the known features in a text."""

    def __init__(self, names: list[str]):
        self.number = {name: k for k, name in enumerate(names)}
        self.words: dict[str, tuple[int, ...]] = {}

    def ids(self, text: str | None) -> list[int]:
        found: set[int] = set()
        known, number = self.words, self.number
        for word in set(re.split(r"[\x20\x09-\x0D]+", (text or "").lower())):
            own = known.get(word)
            if own is None:
                own = tuple(number[f] for f in forms(word) if f in number)
                if len(known) >= MAX_WORDS:
                    known.clear()
                known[word] = own
            if own:
                found.update(own)
        return sorted(found)


@dataclass
class Model:
    names: list[str]
    weights: np.ndarray
    bias: float

    def scores(self, texts, finder: Finder) -> np.ndarray:
        logits = np.array([self.bias + self.weights[ids].sum() if (ids := finder.ids(t)) else self.bias for t in texts])
        return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def risk(params: np.ndarray, pos: list, unl: list, prior: float) -> tuple[float, float, np.ndarray]:
    """(part, bracket, slope) of the non-negative risk: the positives' loss as toxic times
    the prior, the bracket, and the slope in params of their sum, or of minus the bracket
    where that is negative. pos and unl: feature numbers of each row."""

    def side(rows):
        lengths = np.array([len(r) for r in rows])
        ids = np.concatenate([np.asarray(r, np.int64) for r in rows]) if lengths.sum() else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), lengths)
        logits = np.bincount(owner, params[ids], len(rows)) + params[-1]
        return logits, 1 / (1 + np.exp(-np.clip(logits, -50, 50))), ids, owner

    (zp, sp, ip, op), (zu, su, iu, ou) = side(pos), side(unl)
    part, bracket = prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    dp, du = -prior * sp / len(sp), su / len(su)  # of the bracket, in the logits
    dp, du = (dp + prior * (sp - 1) / len(sp), du) if bracket >= 0 else (-dp, -du)
    # of no features at all, bincount makes whole numbers
    slope = np.bincount(ip, dp[op], len(params)).astype(float) + np.bincount(iu, du[ou], len(params))
    slope[-1] += dp.sum() + du.sum()
    return float(part), float(bracket), slope


def fit(rows: list[list[int]], positive: np.ndarray, features: int, prior: float, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on mini-batches of both samples. rows: feature numbers."""
    rng = np.random.default_rng(seed)
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    params, first, second = (np.zeros(features + 1) for _ in range(3))
    params[-1] = np.log(prior / (1 - prior))
    if not len(pos) or not len(unl) or not features:
        return params[:-1], float(params[-1])
    for step in range(1, STEPS + 1):
        picks = [[rows[k] for k in rng.choice(x, min(BATCH, len(x)), replace=False)] for x in (pos, unl)]
        slope = risk(params, *picks, prior)[2]
        slope[:-1] += DECAY * params[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return params[:-1], float(params[-1])


def _counts(rows: DataFrame, names: list[str] | None) -> DataFrame:
    """(feature, docs) over rows (text): of all features, or of the named ones."""

    def count(batches):
        release()  # what an operator before this one has left in the worker
        finder, found = Finder(names) if names is not None else None, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column("text").to_pylist():
                    if finder:
                        own = finder.ids(text)
                    else:
                        own = {f for w in set(re.split(r"[\x20\x09-\x0D]+", (text or "").lower())) for f in forms(w)}
                    for f in own:
                        found[f] = found.get(f, 0) + 1
                if len(found) > 500_000:
                    yield batch_of(found)
                    found = {}
        if found:
            yield batch_of(found)
        trim()

    def batch_of(found):
        keys = [names[k] for k in found] if names is not None else list(found)
        return pa.RecordBatch.from_pydict({"feature": pa.array(keys, pa.string()), "docs": pa.array(list(found.values()), pa.int64())})

    return rows.select("text").mapInArrow(count, "feature string, docs bigint").groupBy("feature").agg(F.sum("docs").alias("docs"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic).

    Rows that held_out() names are neither sampled nor is their label read. A repeated
    label counts once, the largest where they differ; a null label or id is none. Of rows
    that repeat an id, one is a training row. With no positive label, no documents or no
    feature that tells the samples apart, the model gives every text the prior."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known, count = store.counted(known.select(F.col("doc_id").alias("__id"), (F.col("toxic") == 1).alias("toxic")), "known", toxic=F.count_if(F.col("toxic")))
    prior = min(max((count["toxic"] + 1) / (count["n"] + 2), 0.001), 0.9)
    order = F.xxhash64("__id", F.lit("sample"))
    chosen = store.table(known.where("toxic").orderBy(order, "__id").limit(POSITIVES).select("__id"), "chosen")
    rows = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = rows.agg(F.approx_count_distinct("doc_id")).first()[0]
    parts = 1 << 30
    cut = min(parts, int(parts * UNLABELLED / max(total, 1)) + 1)
    positive = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"), "left_semi").withColumn("positive", F.lit(True))
    unlabelled = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(parts)) < cut).withColumn("positive", F.lit(False))
    is_positive = F.count_if(F.col("positive"))
    sample, sizes = store.counted(positive.unionByName(unlabelled), "sample", positive=is_positive)
    if sample.select("doc_id", "positive").distinct().count() < sizes["n"]:
        single = sample.groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
        sample, sizes = store.counted(single, "sample", positive=is_positive)
    n_pos, n_unl = sizes["positive"], sizes["n"] - sizes["positive"]
    if not n_pos or not n_unl:
        return Model([], np.zeros(0), float(np.log(prior / (1 - prior))))
    # bounded by the samples
    top = _counts(sample.where("positive"), None).where(F.col("docs") >= LEAST_DOCS).orderBy(F.desc("docs"), "feature").toPandas()
    in_unl = _counts(sample.where("NOT positive"), top["feature"].tolist()).toPandas().set_index("feature")["docs"]
    p = top["docs"].to_numpy(float) / n_pos
    u = top["feature"].map(in_unl).fillna(0).to_numpy(float) / n_unl
    middle = np.clip((p * n_pos + u * n_unl) / (n_pos + n_unl), 1e-9, 1 - 1e-9)
    gap = (p - u) / np.sqrt(middle * (1 - middle) * (1 / n_pos + 1 / n_unl))
    names = top["feature"][np.abs(gap) >= LEAST_GAP].tolist()
    if not names:
        return Model([], np.zeros(0), float(np.log(prior / (1 - prior))))

    def features(batches):
        release()
        finder = Finder(names)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [np.array(finder.ids(t), np.int32).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("positive"), pa.array(found, pa.binary())], names=["doc_id", "positive", "ids"])

    data = sample.mapInArrow(features, "doc_id bigint, positive boolean, ids binary").toArrow().sort_by([("positive", "ascending"), ("doc_id", "ascending")])
    rows = [np.frombuffer(x.as_buffer(), np.int32) for x in data.column("ids")]  # views, no copies
    weights, bias = fit(rows, data.column("positive").to_numpy(), len(names), prior)
    return Model(names, weights, bias)


def scorer(spark: SparkSession, model: Model):
    """The model as a column function of text. A null text is an empty one, which
    has no features: it scores by the bias alone."""
    held, finders = spark.sparkContext.broadcast(model), {}

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        if "own" not in finders:
            release()
            finders["own"] = Finder(held.value.names)
        return pd.Series(held.value.scores(text, finders["own"]))

    return score


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, held_out, score and predicted (1 from the threshold on).
    Repeated rows score alike; a text of any length is scored whole; a score of just the
    threshold counts as toxic. An empty table gives no rows."""
    score = scorer(docs.sparkSession, train(docs, labels))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, in docs' columns."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.where(score("text") < threshold)
