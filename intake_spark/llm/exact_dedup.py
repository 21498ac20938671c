"""Exact duplicates by sorting content: range partitions from sampled splitters, an external sort inside each, equal neighbours compared in full.

Splitters are taken over (64 leading characters, 64-bit hash, salt), so that the sample the driver sees is small
however long the texts are; the full text follows in the sort and in the comparison. Texts with more than PART_ROWS rows
would crowd one partition, whatever their share of all rows. They are found by counting rows by hash, before any text is moved, and their rows
are salted over as many sort groups as hold PART_ROWS each. Every group is sorted and its neighbours compared like any other;
what the groups of one text find (how many, and which id is best) is then put together.

Nulls: a null text counts as empty; a null id ranks below all others. Ties: of rows with equal id and text exactly one stays.
Empty input gives an empty result. Columns other than the two named are carried through whatever their names. Texts of any length are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, text_of, written

#: Rows of one text that one sort group takes; texts with more are salted.
PART_ROWS = 1024


def hot_texts(keyed: DataFrame) -> DataFrame:
    """The stored table of hashes (_hash) that more than PART_ROWS rows have, and over how many groups to salt those."""
    hot = keyed.groupBy("_hash").count().filter(F.col("count") > PART_ROWS)
    return written(hot.select("_hash", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("_salts")), "hot-texts")


def content_sort(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest", normalise=None) -> DataFrame:
    """Every row of docs as struct `row`, with keep_id, group_size, kept and text_sha256 of its group of equal texts.

    keep: "largest" or "smallest" id stays. normalise: from a text Column to the Column that is compared; none by default.
    """
    largest = keep == "largest"
    text: Column = text_of(docs, text_column)
    id_ = docs[id_column]
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c != text_column]).alias("_row") if len(docs.columns) > 1 else F.struct(F.lit(1)).alias("_row"),
        docs[text_column].isNull().alias("_null") if normalise is None else docs[text_column].alias("_text"),
        (normalise(text) if normalise else text).alias("_key"),
        id_.alias("_id"),
        (id_.isNotNull() if largest else id_.isNull()).alias("_none"),
    ).withColumns({"_head": F.substring("_key", 1, 64), "_hash": F.xxhash64("_key")})
    hot = hot_texts(keyed)
    many = hot.count()
    salt = F.pmod(F.hash("_id", "_row"), F.col("_salts"))
    salted = join_small(keyed, hot, ["_hash"], many).withColumn("_part", F.coalesce(salt, F.lit(-1)))
    place = ["_head", "_hash", "_part"]
    group = Window.partitionBy(*place, "_key")
    order = group.orderBy(F.col("_none").desc() if largest else F.col("_none"), F.col("_id").desc() if largest else F.col("_id"))
    ranked = salted.repartitionByRange(*place).withColumns({
        "_rank": F.row_number().over(order),
        "_best": F.first("_id").over(order),
        "_n": F.count("*").over(group),
    }).withColumn("_sha", F.sha2("_key", 256))
    total, best, first = F.col("_n"), F.col("_best"), F.col("_rank") == 1
    if many:
        parts = written(ranked.filter("_part >= 0").filter("_rank = 1").select("_sha", "_n", F.struct("_none", "_best", "_part").alias("_top")), "hot-parts")
        whole = parts.groupBy("_sha").agg(F.sum("_n").alias("_hot_n"), (F.max if largest else F.min)("_top").alias("_hot"))
        ranked = join_small(ranked, whole, ["_sha"], many)
        salted_ = F.col("_part") >= 0
        total, best = F.when(salted_, F.col("_hot_n")).otherwise(total), F.when(salted_, F.col("_hot._best")).otherwise(best)
        first = first & (~salted_ | (F.col("_hot._part") == F.col("_part")))
    text_back = F.when(F.col("_null"), F.lit(None)).otherwise(F.col("_key")) if normalise is None else F.col("_text")
    return ranked.select(
        F.struct(*[(text_back if c == text_column else F.col("_row")[c]).alias(c) for c in docs.columns]).alias("row"),
        best.alias("keep_id"), total.alias("group_size"), first.alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, with the same columns."""
    return content_sort(docs, **options).filter("kept").select("row.*")
