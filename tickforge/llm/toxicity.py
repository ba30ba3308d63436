"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document is labelled.  A sentence's probability is logistic in the
weights of its words -- a word has its own feature and those of its first 4, 5 and 6 letters, so that inflected and
compounded forms are met too -- and a document's is their noisy-or with a leak:
``1 - (1 - leak) * prod(1 - p(sentence))``.  Sentences without a weighted word have no evidence and add nothing, so that long
clean documents stay clean.  Weights, bias and leak maximise the likelihood of the documents' labels; the sentences'
own probabilities then locate the offending ones.

Training uses a bounded sample: at most ``sample_docs`` labelled documents of each class (the first by hash of the id, whole texts,
reweighted to the classes' sizes).  Spark counts its features and keeps all that are in ``min_docs`` of its toxic documents and
``min_odds`` times as common there as elsewhere; there is no cap on their number.

Defined results: a null or empty text gets the leak as its score; rows with a null id are held out; several labels of a document
count as the largest, null labels not at all; repeated rows are scored row by row; without labels all scores are 0.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, released
from .langid import held_out
from .packing import slices

#: Labelled documents of each class that are learned from, at most.
SAMPLE_DOCS = 10_000
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?]+\s+|\n+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of a text's sentences."""
    out, start = [], 0
    for m in _END.finditer(text):
        if m.start() > start:
            out.append((start, m.start()))
        start = m.end()
    if start < len(text):
        out.append((start, len(text)))
    return out


def features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}-" for k in PREFIXES if len(word) > k)]


class Weights(dict):
    """Weight of a word, kept once it was met."""

    def __init__(self, of: dict[str, float], most: int = 100_000):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word: str) -> float:
        if len(self) > self.most:
            self.clear()
        w = self[word] = sum(self.of.get(f, 0.0) for f in features(word))
        return w


class NoisyOr:
    """``weights`` of features, ``bias`` of a sentence with evidence, ``leak`` of a document."""

    def __init__(self, weights: dict[str, float], bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak
        self._words = Weights(weights)

    def __reduce__(self):
        return NoisyOr, (self.weights, self.bias, self.leak)

    def _lowered(self, text: str) -> float:
        total = sum(map(self._words.__getitem__, _WORD.findall(text)))
        return 1 / (1 + math.exp(-(total + self.bias))) if total > 0 else 0.0

    def sentence(self, text: str) -> float:
        return self._lowered(text.lower())

    def score(self, text: str) -> float:
        clean = 1 - self.leak
        for s in _END.split(text.lower()):
            if s and (p := self._lowered(s)):
                clean *= 1 - p
        return 1 - clean

    def offending(self, text: str, least: float = 0.5) -> list[dict]:
        return [{"start": a, "end": b, "p": float(p)} for a, b in sentences(text) if (p := self.sentence(text[a:b])) >= least]

    @classmethod
    def fit(cls, bags: list[list[dict[int, int]]], labels: np.ndarray, weight: np.ndarray, names: list[str], steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> NoisyOr:
        """bags: for each document, for each sentence with evidence, features and how often.  Adam on the weighted likelihood; weights stay at least 0."""
        sentence, feature, times, doc = [], [], [], []
        for d, bag in enumerate(bags):
            for s in bag:
                for f, n in s.items():
                    sentence.append(len(doc))
                    feature.append(f)
                    times.append(n)
                doc.append(d)
        sentence, feature, times, doc = np.array(sentence, int), np.array(feature, int), np.array(times, float), np.array(doc, int)
        weight = weight / weight.sum()
        rate_1 = float((weight * labels).sum())
        params = np.concatenate([np.full(len(names), 1.0), [-2.0, np.log(max(rate_1, 1e-4) / 10)]])
        mean, square = np.zeros_like(params), np.zeros_like(params)
        for t in range(1, steps + 1):
            w, bias, leak = params[:-2], params[-2], 1 / (1 + np.exp(-params[-1]))
            z = np.bincount(sentence, w[feature] * times, len(doc)) + bias
            p = np.clip(1 / (1 + np.exp(-z)), 1e-9, 1 - 1e-9)
            clean = np.exp(np.bincount(doc, np.log1p(-p), len(bags)) + np.log1p(-leak))
            clean = np.clip(clean, 1e-12, 1 - 1e-9)
            # Of the log-likelihood, by log(clean): -clean / (1 - clean) for label 1, 1 for label 0.
            by_clean = weight * np.where(labels == 1, -clean / (1 - clean), 1.0)
            by_z = -by_clean[doc] * p
            grad = np.concatenate([np.bincount(feature, by_z[sentence] * times, len(names)) - decay * w / len(names), [by_z.sum(), -(by_clean.sum()) * leak]])
            mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
            params = params + rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
            params[:-2] = np.maximum(params[:-2], 0)
            params[-2] = min(params[-2], -1.0)
        return cls({n: float(x) for n, x in zip(names, params[:-2], strict=True) if x > 0.05}, float(params[-2]), float(1 / (1 + np.exp(-params[-1]))))


def _counts(batches):
    """feature, toxic, clean: how many of a stretch's documents of each class have each feature."""
    for b in batches:
        for at, size in slices(b.column("text"), 1 << 20):
            part, n = b.slice(at, size), {}
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                for f in {f for word in set(_WORD.findall((text or "").lower())) for f in features(word)}:
                    n.setdefault(f, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([x[1] for x in n.values()], pa.int64()), pa.array([x[0] for x in n.values()], pa.int64())], names=["feature", "toxic", "clean"])


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, min_docs: int = 4, min_odds: float = 6.0) -> NoisyOr | None:
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    labels = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    chosen = [labels.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", F.lit("toxicity")), "doc_id").limit(sample_docs) for c in (0, 1)]
    # At most 2 * sample_docs ids: the bound of this broadcast.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    sample = materialize(sample.select("text", "toxic"), "labelled")
    got = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(got) < 2:
        return None
    counts = sample.mapInArrow(released(_counts), "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = (F.col("toxic") + 0.5) / got[1] / ((F.col("clean") + 0.5) / got[0])
    names = sorted(r["feature"] for r in counts.where((F.col("toxic") >= min_docs) & (odds >= min_odds)).select("feature").collect())
    if not names:
        return NoisyOr({}, -2.0, size[1] / (size[0] + size[1]))
    of = {f: i for i, f in enumerate(names)}

    def bags(batches):
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                bag = []
                for s in _END.split((text or "").lower()):
                    own: dict[int, int] = {}
                    for word in _WORD.findall(s):
                        for f in features(word):
                            if f in of:
                                own[of[f]] = own.get(of[f], 0) + 1
                    if own:
                        bag.append([x for pair in own.items() for x in pair])
                out.append(bag)
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(out, pa.list_(pa.list_(pa.int64())))], names=["toxic", "bag"])

    rows = sample.mapInArrow(bags, "toxic int, bag array<array<long>>").toPandas()  # hits of the chosen features in the bounded sample
    y = rows["toxic"].to_numpy()
    weight = np.where(y == 1, size[1] / got[1], size[0] / got[0])
    return NoisyOr.fit([[dict(zip(s[::2], s[1::2], strict=True)) for s in (list(map(int, x)) for x in bag)] for bag in rows["bag"]], y, weight, names)


def keep_clean(docs: DataFrame, model: NoisyOr | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.leak) if model else None)

    def run(batches):
        model = NoisyOr(*shared.value) if shared.value else None
        for b in batches:
            yield b.filter(pa.array([model is None or model.score(t or "") < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)


def score(docs: DataFrame, model: NoisyOr | None) -> DataFrame:
    """The columns of ``docs`` with ``score`` and ``offending`` (spans of sentences, in characters, and their probability); columns of these names are replaced."""
    docs = docs.drop("score", "offending")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.leak) if model else None)

    def run(batches):
        model = NoisyOr(*shared.value) if shared.value else None
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            scores = [float(model.score(t)) if model else 0.0 for t in texts]
            spans = [model.offending(t) if model and s > model.leak else [] for t, s in zip(texts, scores, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))], names=[*b.schema.names, "score", "offending"])

    return docs.mapInArrow(released(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double, offending array<struct<start:long,end:long,p:double>>")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), F.size("offending").alias("n_offending"))
