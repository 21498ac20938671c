"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables

#: A word, for every operator here: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


#: Characters of a text that are looked at together, at least; a longer one is cut before white space after so many.
PART_CHARS = 1_000_000
_GAP = re.compile(r"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]")


def parts_of(text: str, size: int | None = None, gap: re.Pattern = _GAP) -> Iterator[str]:
    """The text in parts, cut where gap matches (between a word and the white space behind it); joined they are the text. Most texts are one part."""
    at, size = 0, size or PART_CHARS
    while len(text) - at > size and (cut := gap.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    return tables.shared_dir(spark)


def new_path(spark: SparkSession, kind: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """At most so many rows go to Python at once, where rows are large; the session's own setting holds again afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        if rows:
            spark.conf.set(name, str(min(rows, int(before) if int(before) > 0 else rows)))
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, kind: str, arrow_rows: int | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors. arrow_rows: see arrow_batches."""
    spark = df.sparkSession
    path = new_path(spark, kind)
    with arrow_batches(spark, arrow_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batch, rows: int = 256):
    """An Arrow batch or array in slices, so that a task turns no more than a few texts at a time into Python objects."""
    for i in range(0, len(batch), rows):
        yield batch.slice(i, rows)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(df[column], F.lit(""))


def join_small(left: DataFrame, dim: DataFrame, on: list[str], rows: int, how: str = "left", limit: int = 10_000) -> DataFrame:
    """Join with a dimension of a counted number of rows: broadcast up to limit, else a shuffled join that Spark may split on skew."""
    return left.join(F.broadcast(dim) if rows <= limit else dim.hint("merge"), on, how)
