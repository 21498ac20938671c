"""The corpus pipeline: toxic documents go, then copies, then near copies; sources are mixed to weights and packed into windows.

Each stage takes the documents that its predecessor kept, as a DataFrame read back from Parquet. All but the last return the columns of
documents; mixing repeats rows that it takes again and cuts the text of those it takes in part.

In every stage a null text counts as empty, texts of any length are read whole, columns besides those named are carried as they are whatever
their names, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake_spark.llm import exact_dedup, mixing, near_copies, packing, toxicity
from intake_spark.llm.common import written

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below TOXIC_FROM, by the classifier that learns from the rows outside the held-out third.

    Rows with a null id are scored and teach nothing; repeated rows are judged alike; without a toxic label nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, learn_from=F.crc32(F.col("id").cast("string")) % 3 != 1)
    return toxicity.drop_toxic(docs, model, TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: that with the largest doc_id. A null id ranks below all others; of rows with equal id and text one stays."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that texts with a similarity (Jaccard of their shingles of five words) of 0.8 or more link: that with the smallest doc_id.

    SimHash with pivot tables links what is close, shingles find the rest. Texts without words are alike; rows with a null id stay; of rows with equal id and text one stays.
    """
    return near_copies.drop_similar(docs, width=5, least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix that op7 plans, as rows dealt to their shards and shuffled there; n_chars follows the text.

    A null source is a source of its own; a null id is permuted as the text "null"; repeated rows are separate documents; texts without words don't occur.
    """
    mixed = mixing.dealt(mixing.mix(docs, weights=(5.0, 2.0, 1.0), epochs=1.5, cap=2.0))
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else mixed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their place in a sequence, and row, which tells rows of one id apart. A text without words is its end id."""
    pieces = packing.cut(docs, capacity=2048, end_id=1, added=True).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces, capacity=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: A trained classifier, fingerprint components and a tokenizer have no SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
