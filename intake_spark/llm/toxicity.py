"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic texts, the unlabelled are texts of any kind; no label says that a text is clean. The risk is that of a
logistic loss with class prior p: p * E_P[loss(+)] + max(0, E_U[loss(-)] - p * E_P[loss(-)]); where the second part is negative its gradient is
followed upwards instead. Features are presence and density of hashed words and word beginnings; those kept are clearly and
several times more frequent in positives than in unlabelled texts. The fit uses a bounded sample: the `positives` and `unlabelled` texts with the
smallest hash of their id. Everything is scored.

Repeated rows are scored alike, and count as often as they occur where their id is in the sample. Of a very long text no more than its distinct words
is held. Nulls: a null text counts as empty, and empty texts get the score of a text without features; rows with a null label or id teach nothing,
rows with a null id are scored. With several labels the largest counts. Without any positive every score is the prior.
Empty input gives an empty result. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .caches import TEXT_ROWS, give_back
from .common import sliced, written
from .text_features import WordBuckets

BUCKETS, CHOSEN, POSITIVES, UNLABELLED, PRIOR = 1 << 20, 1024, 6_000, 12_000, 0.1
#: A feature is kept if its rates differ by this many variances, and it is this many times as frequent in confirmed texts (1 / prior at most).
STRENGTH, TIMES = 30, 3


@dataclass(frozen=True)
class Model:
    chosen: list[int]
    weights: np.ndarray
    bias: float

    def score(self, texts) -> np.ndarray:
        buckets = WordBuckets(BUCKETS, self.chosen)
        raw = np.array([self.bias + self.weights[buckets.features(t or "")].sum() for t in texts], np.float64)
        return 1 / (1 + np.exp(-np.clip(raw, -60, 60)))


@dataclass(frozen=True)
class Rows:
    """Texts as the features that occur in them, flat: text and feature of each occurrence."""

    n: int
    text: np.ndarray
    feature: np.ndarray

    @staticmethod
    def of(rows: list[list[int]]) -> Rows:
        sizes = [len(r) for r in rows]
        return Rows(len(rows), np.repeat(np.arange(len(rows)), sizes), np.array([f for r in rows for f in r], np.int64))

    def scores(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.text, w[self.feature], self.n) + b

    def mean(self, s: np.ndarray, features: int) -> np.ndarray:
        """Mean of s times each feature, and of s itself."""
        return np.append(np.bincount(self.feature, s[self.text], features), s.sum()) / max(1, self.n)


def nnpu(confirmed: Rows, unlabelled: Rows, features: int, prior: float, rounds: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier."""
    w, b = np.zeros(features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    loss = lambda s: np.mean(-np.log1p(-np.minimum(s, 1 - 1e-12)))
    for step in range(1, rounds + 1):
        sp, su = sigmoid(confirmed.scores(w, b)), sigmoid(unlabelled.scores(w, b))
        slope = unlabelled.mean(su, features) - prior * confirmed.mean(sp, features)
        grad = prior * confirmed.mean(sp - 1, features) + slope if loss(su) >= prior * loss(sp) else -slope
        grad[:-1] += ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, prior: float | None = None, id_column="doc_id", text_column="text", label_column="toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on the rows whose id meets learn_from (an expression over a column named `id`). prior: share of toxic texts; the labels' own if None."""
    spark = docs.sparkSession
    allowed = F.lit(True) if learn_from is None else learn_from
    known = labels.select(labels[id_column].alias("id"), labels[label_column].cast("int").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & allowed).groupBy("id").agg(F.max("label").alias("label"))
    first = lambda df, n: [r["id"] for r in df.orderBy(F.xxhash64("id"), "id").limit(n).collect()]
    facts = known.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    if prior is None:
        share = (facts["toxic"] or 0) / facts["n"] if facts["n"] else PRIOR
        prior = share if 0 < share < 1 else PRIOR
    confirmed = first(known.filter("label = 1").select("id"), positives)
    if not confirmed:
        return Model([], np.zeros(0), float(np.log(prior / (1 - prior))))
    others = first(docs.select(docs[id_column].alias("id")).filter(F.col("id").isNotNull() & allowed), unlabelled)
    id_type = docs.schema[id_column].dataType
    both = pd.DataFrame({"id": confirmed + others, "positive": [True] * len(confirmed) + [False] * len(others)})
    wanted = spark.createDataFrame(both, T.StructType([T.StructField("id", id_type), T.StructField("positive", T.BooleanType())]))
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")).join(F.broadcast(wanted), "id").select("positive", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets(BUCKETS)
        for batch in batches:
            for some in sliced(batch):
                found = [np.array(sorted(buckets.features(t.as_py() or "")), "<i4").tobytes() for t in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found, pa.binary())], names=["positive", "features"])

    sample = written(rows.mapInArrow(read, "positive boolean, features binary"), "toxicity-sample", TEXT_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = np.zeros((2, 2 * BUCKETS), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            for positive, features in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[int(positive), np.frombuffer(features.as_buffer(), "<i4")] += 1
                texts[int(positive)] += 1
        used = np.flatnonzero(sums.any(axis=0))
        columns = [np.append(used, -1), np.append(sums[1, used], texts[1]), np.append(sums[0, used], texts[0])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["feature", "p", "u"])

    seen = written(sample.mapInArrow(count, "feature bigint, p bigint, u bigint").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u")), "toxicity-counts")
    # Feature -1 counts the texts themselves: those that were found, each as often as it occurs.
    texts = seen.filter("feature = -1").first()
    p, u = (float(max(1, texts[c])) if texts else 1.0 for c in ("p", "u"))
    # The squared difference of the two rates in units of its variance.
    pooled = (F.col("p") + F.col("u") + 1) / (p + u)
    strength = F.pow(F.col("p") / p - F.col("u") / u, 2) / (pooled * (1 / p + 1 / u))
    clear = seen.filter("feature >= 0").withColumn("strength", strength).filter((F.col("strength") > STRENGTH) & (F.col("p") / p >= TIMES * F.col("u") / u))
    chosen = sorted(r["feature"] for r in clear.orderBy(F.desc("strength"), "feature").limit(CHOSEN).collect())

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(2 * BUCKETS, -1, np.int32)
        place[chosen] = np.arange(len(chosen), dtype=np.int32)
        for batch in batches:
            kept = [place[np.frombuffer(x.as_buffer(), "<i4")] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[x >= 0] for x in kept], pa.list_(pa.int32()))], names=["positive", "features"])

    rows = sorted(sample.mapInArrow(reduce, "positive boolean, features array<int>").collect())  # the same fit whatever their order
    split = {known: Rows.of([list(r["features"]) for r in rows if r["positive"] == known]) for known in (True, False)}
    weights, bias = nnpu(split[True], split[False], len(chosen), prior) if split[False].n else (np.zeros(len(chosen)), 0.0)
    return Model(chosen, weights, bias)


def scorer(spark: SparkSession, model):
    """A function from a text Column to its score; the model, of bounded size, is broadcast, and every whole text is read."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(sent.value.score(t for some in sliced(texts) for t in some.to_pylist()), pa.float64())
        give_back()

    return lambda text: scored(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model, text_column="text") -> DataFrame:
    """docs with a column score added, in place of one of that name."""
    return docs.withColumn("score", scorer(docs.sparkSession, model)(docs[text_column]))


def drop_toxic(docs: DataFrame, model, least: float = 0.7, text_column="text") -> DataFrame:
    """The rows of docs that score below `least`, with the same columns."""
    return docs.filter(scorer(docs.sparkSession, model)(docs[text_column]) < least)
