"""Text quality by a factorisation machine.

Inputs are hashed words (square-rooted counts, at unit length) and standardised statistics of the text's structure and size. All pairs of
inputs interact through vectors of RANK numbers: half of (sum v x)^2 - sum (v x)^2, so a score takes time linear in the text. The fit is by
Adam on a bounded sample: of each class, the `per_class` labelled texts with the smallest hash of their id, weighted back to the labels' shares.

Repeated rows are scored alike. A very long text is held with the list of its words while it is read, texts one at a time.
Nulls: a null text counts as empty; rows with a null label or id teach nothing, rows with a null id are scored. With several labels the largest counts.
With one class only, every score is that class's share. Empty input gives an empty result. Other columns take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .caches import Generations
from .common import sliced, written

BUCKETS, RANK, PER_CLASS, EPOCHS = 4096, 8, 3000, 60
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
STATISTICS = 14
#: Bytes of words that a task remembers, about, and what Python needs for one.
CACHE_BYTES, WORD_BYTES = 24 << 20, 130


class _Hashed(Generations):
    """Word to its bucket."""

    def __init__(self):
        super().__init__(CACHE_BYTES)

    def weigh(self, entries: dict[str, int]) -> int:
        return WORD_BYTES * len(entries) + sum(map(len, entries))

    def make(self, words: list[str]) -> dict[str, int]:
        return {w: zlib.crc32(w.lower().encode("utf-8", "replace")) % BUCKETS for w in words}


def statistics(text: str, words: list[str]) -> list[float]:
    """Structure of a text: size, word and line lengths, repetition, and kinds of characters."""
    n, chars, lines = max(1, len(words)), max(1, len(text)), text.split("\n")
    counts = Counter(words)
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    ascii_ = text.encode("ascii", "ignore")
    total = lambda marks: sum(ascii_.count(m) for m in marks)
    letters = len(re.findall(r"[^\W\d_]", text))
    upper = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
    return [
        np.log1p(len(text)), np.log1p(len(words)), chars / n / 10, len(counts) / n, repeated / n, max(counts.values(), default=0) / n, letters / chars, upper / max(1, letters),
        sum(map(text.count, "0123456789")) / chars, total((b"!", b"?")) / n, total((b"#", b"$", b"%", b"&", b"*", b"@", b"^", b"~", b"|", b"<", b">", b"{", b"}")) / n,
        total((b".", b",", b";", b":")) / n, len({*lines}) / len(lines), np.log1p(len(text) / len(lines)),
    ]


def inputs(text: str, hashed: _Hashed) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets, their values, and the statistics."""
    words = _WORD.findall(text)
    hashed.learn(words)
    places, counts = np.unique(np.fromiter(map(hashed.known.__getitem__, words), np.int64, len(words)), return_counts=True)
    values = np.sqrt(counts)
    return places, values / max(1e-9, float(np.sqrt((values**2).sum()))), statistics(text, words)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    deviation: np.ndarray
    bias: float
    linear: np.ndarray
    vectors: np.ndarray

    def score(self, texts) -> np.ndarray:
        hashed, raw = _Hashed(), []
        for text in texts:
            places, values, stats = inputs(text or "", hashed)
            x = np.concatenate([values, np.clip((np.array(stats) - self.mean) / self.deviation, -4, 4)])
            at = np.concatenate([places, np.arange(BUCKETS, BUCKETS + STATISTICS)])
            v = self.vectors[at] * x[:, None]
            raw.append(self.bias + self.linear[at] @ x + 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return 1 / (1 + np.exp(-np.clip(np.array(raw, np.float64), -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float = 0.01, ridge: float = 1e-3, seed: int = 0) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, linear weights and vectors, by Adam in batches of 256."""
    rng = np.random.default_rng(seed)
    share = float(np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    theta = [np.array(np.log(share / (1 - share))), np.zeros(x.shape[1], np.float32), rng.normal(0, 0.01, (x.shape[1], RANK)).astype(np.float32)]
    first, second, step = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            rows, step = order[i : i + 256], step + 1
            b, w, v = theta
            xb, squares = x[rows], x[rows] ** 2
            sums = xb @ v
            raw = b + xb @ w + 0.5 * (sums**2 - squares @ (v**2)).sum(axis=1)
            off = ((1 / (1 + np.exp(-np.clip(raw, -60, 60))) - y[rows]) * weight[rows] / weight[rows].mean() / len(rows)).astype(np.float32)
            grads = [np.array(off.sum()), xb.T @ off + ridge * w, xb.T @ (off[:, None] * sums) - v * (squares.T @ off)[:, None] + ridge * v]
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                theta[k] = theta[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return float(theta[0]), theta[1], theta[2]


def train(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_column="doc_id", text_column="text", label_column="quality", per_class: int = PER_CLASS) -> Model:
    """Fit on the labelled rows whose id meets learn_from (an expression over a column named `id`)."""
    allowed = F.lit(True) if learn_from is None else learn_from
    known = labels.select(labels[id_column].alias("id"), labels[label_column].cast("int").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & allowed).groupBy("id").agg(F.max("label").alias("label"))
    share = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    ids = [(r["id"], c) for c in (0, 1) for r in known.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class).collect()]
    wide = BUCKETS + STATISTICS
    nothing = lambda p: Model(np.zeros(STATISTICS), np.ones(STATISTICS), float(np.log(p / (1 - p))), np.zeros(wide), np.zeros((wide, RANK)))
    if not share.get(0) or not share.get(1):
        return nothing(0.999 if share.get(1) else 0.001 if share.get(0) else 0.5)
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), T.StructField("label", T.IntegerType())])
    sample = docs.sparkSession.createDataFrame(ids, schema)
    texts = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")).join(F.broadcast(sample), "id").select("text", "label")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed()
        for some in (part for batch in batches for part in sliced(batch)):
            found = [inputs(t.as_py() or "", hashed) for t in some.column(0)]
            at, x = ([f[k].astype(kind).tobytes() for f in found] for k, kind in ((0, "<i2"), (1, "<f4")))
            stats = pa.array([[float(s) for s in f[2]] for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([some.column(1), pa.array(at, pa.binary()), pa.array(x, pa.binary()), stats], names=["label", "at", "x", "stats"])

    rows = written(texts.mapInArrow(each, "label int, at binary, x binary, stats array<double>"), "quality-sample").collect()
    if len({r["label"] for r in rows}) < 2:
        return nothing(share[1] / (share[0] + share[1]))
    stats = np.array([r["stats"] for r in rows])
    mean, deviation = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    x, y = np.zeros((len(rows), wide), np.float32), np.array([r["label"] for r in rows], np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], "<i2")] = np.frombuffer(r["x"], "<f4")
    x[:, BUCKETS:] = np.clip((stats - mean) / deviation, -4, 4)
    had = np.array([(y == 0).sum(), (y == 1).sum()], float)
    weight = np.where(y == 1, share[1] / had[1], share[0] / had[0])
    order = np.lexsort((*stats.T[:3], y))  # the same fit whatever the order of the rows
    bias, linear, vectors = fit(x[order], y[order], weight[order])
    return Model(mean, deviation, bias, linear, vectors)
