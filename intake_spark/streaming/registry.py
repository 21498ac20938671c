"""Keys that earlier micro-batches have registered, in hash buckets with a Bloom filter each.

A micro-batch asks the filters of the buckets that its keys hit, and reads the rows of those buckets alone in which a filter knows one of them. The number of
buckets doubles with the rows, so a bucket holds about as many rows however long the history is. Filters are numbered like the rows:
version v + 1 is what micro-batch v leaves, and is made anew if that runs again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.buckets import Buckets
from ..sources.tables import staged

#: Rows of a bucket, about; bits of its filter for each, and probes for a key.
BUCKET_ROWS, BITS, PROBES = 1 << 16, 16, 4


@dataclass(frozen=True)
class Registry:
    path: str
    bucket_rows: int = BUCKET_ROWS

    @property
    def rows(self) -> Buckets:
        return Buckets(f"{self.path}/keys", "key", T.StructType([T.StructField("key", T.StringType())]))

    @property
    def filters(self) -> Buckets:
        """bits: the filter of bucket `part`, 64 bits to a number."""
        return Buckets(f"{self.path}/filters", "part", T.StructType([T.StructField("part", T.IntegerType()), T.StructField("bits", T.ArrayType(T.LongType()))]))

    @property
    def words(self) -> int:
        return max(1, self.bucket_rows * BITS // 64)

    def places(self) -> list[Column]:
        """The bits that a key sets."""
        mixed = lambda i: F.xxhash64(F.lit(i + 1), "key")
        return [F.pmod(mixed(i), F.lit(self.words * 64)) for i in range(PROBES)]

    def asked(self, keys: DataFrame, version: int) -> tuple[DataFrame, set[int]]:
        """Of keys (key), those that a filter knows, and their buckets."""
        spark, of = keys.sparkSession, self.buckets(keys.sparkSession, version)
        hit = self.rows.hit(keys, of)
        parts = spark.createDataFrame([(b,) for b in hit], "part int")
        filters = self.filters.read(spark, version, self.filters.hit(parts, of)) if hit else self.filters.read(spark, -1)
        test = F.lit(True)
        for at in self.places():
            word = F.get("bits", F.floor(at / 64).cast("int"))
            test = test & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        # Merged, so that Spark splits a bucket with very many keys; a filter is never copied for each of them.
        known = keys.withColumn("_part", self.rows.bucket(of)).join(filters.hint("merge"), (F.col("_part") == F.col("part")) & test, "left_semi")
        known = staged(known.drop("_part"), "asked")
        return known, self.rows.hit(known, of)

    def buckets(self, spark: SparkSession, version: int) -> int:
        entries = self.rows.entries(spark, version)
        return entries[0].of if entries else 1

    def known(self, keys: DataFrame, version: int) -> DataFrame:
        """Of distinct keys (key), those that are registered."""
        if not self.rows.entries(keys.sparkSession, version):
            return keys.limit(0)
        maybe, buckets = self.asked(keys, version)
        return maybe.join(self.rows.read(keys.sparkSession, version, buckets), "key", "left_semi")

    def register(self, keys: DataFrame, version: int) -> None:
        """Make version + 1 with these distinct keys, none of which is registered."""
        spark = keys.sparkSession
        entries = self.rows.entries(spark, version)
        of, held = (entries[0].of if entries else 1), sum(e.rows for e in entries)
        wanted, total = of, held + keys.count()
        while wanted * self.bucket_rows < total:
            wanted *= 2
        if not entries or wanted > of:  # each row is dealt anew about once
            every = keys.select("key").unionByName(self.rows.read(spark, version))
            self.rows.create(every, wanted, version + 1)
            self.filters.create(self.built(every, wanted), wanted, version + 1)
            return
        touched = self.rows.hit(keys, of)
        self.rows.append(keys, version + 1)
        parts = self.filters.hit(spark.createDataFrame([(b,) for b in touched], "part int"), of) if touched else set()
        old = self.filters.read(spark, version, parts)
        self.filters.replace(self.merged(old, self.built(keys, of)), version + 1, parts)

    def built(self, keys: DataFrame, of: int) -> DataFrame:
        """The filters of keys by bucket."""
        set_ = keys.select(self.rows.bucket(of).alias("part"), F.explode(F.array(*self.places())).alias("at"))
        return self.merged(None, set_.select("part", F.floor(F.col("at") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, CAST(pmod(at, 64) AS INT))").alias("bits")))

    def merged(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        """Filters by bucket of words (part, word, bits), or of filters old and new."""
        spread = lambda f: f.select("part", F.posexplode("bits").alias("word", "bits"))
        words = new if old is None else spread(old).unionByName(spread(new))
        zero = words.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(self.words - 1))).alias("word"), F.lit(0).cast("bigint").alias("bits"))
        each = words.unionByName(zero).groupBy("part", "word").agg(F.bit_or("bits").alias("bits"))
        return each.groupBy("part").agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits"))
