"""Nearest neighbours by a permutation index.

Every vector is represented by its pivots in order of nearness, and posted in the inverted files of its POSTED nearest ones, with its order
and itself. A query visits the files of its own nearest pivots: a SHARE of all, and more where those hold under LEAST_VISITED
postings. In each file, what is posted is ranked by the footrule distance of the first PREFIX places of the two orders; the RERANK share with
the smallest, and LEAST at least (ties included), is ranked again by exact Euclidean distance in double precision. A vector that a query meets in
several files is looked at in the first of them only. So work goes with the length of the files that are visited. Pivots are a
bounded sample: the PIVOTS vectors with the smallest hash of their id. Every vector is indexed; long files are dealt in chunks, and so are their visitors.

Takes no part: vectors that are null, empty or zero, that hold a null or non-finite component, whose id is null, or whose length differs
from the most frequent one (ties to the larger). Of rows with the same id the smallest vector counts. Ties go to the smaller id. Other columns take no part.
Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

PIVOTS, PREFIX, POSTED, SHARE, RERANK, LEAST, LEAST_VISITED = 128, 64, 2, 0.5, 0.3, 32, 512
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 2048
POSTING = "pivot int, position int, vec_id bigint, nearest binary, vector binary"
FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The `prefix` nearest pivots of each vector, nearest first; ties to the first pivot."""
    far = (pivots**2).sum(1)[None] - 2 * (vectors @ pivots.T)
    return np.argsort(far, axis=1, kind="stable")[:, :prefix].astype(np.uint16)


def index(vectors: DataFrame, id_column="vec_id", vector_column="embedding", pivots: int = PIVOTS, posted: int = POSTED) -> DataFrame:
    """The stored posting files: pivot, position of the pivot in the vector's order (below `posted`), vec_id, nearest (all pivots in order, 2 bytes
    each) and vector (doubles), as binary."""
    rows = vectors.select(vectors[id_column].cast("long").alias("vec_id"), vectors[vector_column].cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    width = sizes.agg(F.max(F.struct("n", "width")).getField("width").alias("width")).first()["width"] or 1
    rows = written(rows.filter(F.size("vector") == width).groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-vectors")
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    centres = np.array([r["vector"] for r in chosen], np.float64).reshape(-1, width)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            near = orders(x, centres, len(centres))
            both = pa.array([r.tobytes() for r in near], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())
            for at in range(min(posted, len(centres))):
                files = pa.array(near[:, at].astype(np.int32)), pa.array(np.full(len(x), at, np.int32))
                yield pa.RecordBatch.from_arrays([*files, batch.column(0), *both], names=["pivot", "position", "vec_id", "nearest", "vector"])

    return written(rows.mapInArrow(place, POSTING), "ann-postings")


class Postings:
    """The orders posted in a file, as the place of each pivot in each; a pivot missing from an order counts as at place `prefix`."""

    def __init__(self, nearest: np.ndarray):
        rows, self.prefix = nearest.shape
        self.place = np.full((rows, int(nearest.max(initial=0)) + 1), self.prefix, np.int16)
        np.put_along_axis(self.place, nearest.astype(np.int64), np.arange(self.prefix, dtype=np.int16)[None], axis=1)

    def footrule(self, nearest: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Footrule distance of the rows to one order."""
        own, pivots = np.full(self.place.shape[1], self.prefix, np.int16), nearest.astype(np.int64)
        known = pivots < len(own)
        own[pivots[known]] = np.flatnonzero(known)
        return np.abs(self.place[rows] - own).sum(axis=1, dtype=np.int32) + int((self.prefix - np.flatnonzero(~known)).sum())


def _matrix(column: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def visits(asked: DataFrame, sizes: dict[int, int], share: float) -> DataFrame:
    """asked (query_id, nearest, vector) with one row per file that the query visits: pivot, visit (its place among them) and visited (how many)."""
    held = np.array([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = []
            for order in batch.column(1):
                near = np.frombuffer(order.as_buffer(), np.uint16).astype(np.int32)
                enough = int(np.searchsorted(np.cumsum(np.where(near < len(held), held[np.minimum(near, len(held) - 1)], 0)), LEAST_VISITED)) + 1
                files.append(near[: max(int(np.ceil(share * len(near))), enough)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(files, pa.list_(pa.int32()))], names=["query_id", "nearest", "vector", "files"])

    each_file = asked.mapInArrow(each, "query_id bigint, nearest binary, vector binary, files array<int>")
    return each_file.select("query_id", "nearest", "vector", F.size("files").alias("visited"), F.posexplode("files").alias("visit", "pivot"))


def search(indexed: DataFrame, queries: Column, k: int = 10, rerank: float = RERANK, share: float = SHARE, posted: int = POSTED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each indexed vector for which `queries` holds, among all but itself.

    share: of the posting files that a query visits; posted: as given to index.
    """
    by_file = lambda rows: {r["pivot"]: r["count"] for r in rows.groupBy("pivot").count().collect()}  # noqa: E731  a row per pivot
    sizes = by_file(indexed)
    asked = indexed.filter(queries).filter("position = 0").select(F.col("vec_id").alias("query_id"), "nearest", "vector")
    sent = written(visits(asked, sizes, share), "ann-visits")
    visitors = by_file(sent)
    cut = lambda n, most: max(1, -(-n // most))
    files = [(p, cut(n, BLOCK_VECTORS), cut(visitors.get(p, 0), BLOCK_QUERIES)) for p, n in sizes.items() if visitors.get(p)]
    dealt = F.broadcast(indexed.sparkSession.createDataFrame(files, "pivot int, chunks int, blocks int"))

    def tile(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asks.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, x, near = rows["vec_id"].to_numpy(), _matrix(rows["vector"], np.float64), _matrix(rows["nearest"], np.uint16)
        files, sizes, found, scores = Postings(near[:, :PREFIX]), [], [], []
        posts = near[:, :posted].astype(np.int64)
        rank = np.full(near.shape[1], near.shape[1], np.int64)
        for query, visit, visited, order, vector in zip(asks["query_id"], asks["visit"], asks["visited"], _matrix(asks["nearest"], np.uint16), _matrix(asks["vector"], np.float64), strict=True):
            rank[:] = len(rank)
            rank[order[:visited]] = np.arange(visited)
            here = np.flatnonzero((rank[posts].min(axis=1) == visit) & (ids != query))
            if not len(here):
                sizes.append(0)
                continue
            far = files.footrule(order[:PREFIX], here)
            size = min(len(here), max(k, LEAST, int(np.ceil(rerank * len(here)))))
            some = here[far <= np.partition(far, size - 1)[size - 1]]
            score = np.sqrt(((x[some] - vector) ** 2).sum(axis=1))
            best = np.lexsort((ids[some], score))[:k]
            sizes.append(len(best)), found.append(ids[some][best]), scores.append(score[best])
        none = [np.zeros(0)]
        return pd.DataFrame({"query_id": np.repeat(asks["query_id"].to_numpy(), sizes), "vec_id": np.concatenate(found or none), "score": np.concatenate(scores or none)})

    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = ["pivot", "chunk", "block"]
    stored = indexed.join(dealt, "pivot").withColumn("chunk", part("vec_id", "chunks")).withColumn("block", every("blocks")).select(*key, "vec_id", "nearest", "vector")
    sent = sent.join(dealt, "pivot").withColumn("block", part("query_id", "blocks")).withColumn("chunk", every("chunks")).select(*key, "query_id", "visit", "visited", "nearest", "vector")
    found = stored.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(tile, FOUND)
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
