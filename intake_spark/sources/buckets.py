"""Tables in hash buckets with a manifest for each version: readers open the buckets they ask for, writers touch the buckets they change.

Rows of a version lie below data/version=v/bucket=b and never change; manifest/version=v names, for each bucket, the versions whose rows make it up. A
version is made from the one before it and takes the place of one that was made under its number before, so a job that runs again changes nothing.
Only bucket numbers and versions (a line a bucket) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import existing

#: Versions that a bucket is read from at most; then its rows are written together.
MOST_VERSIONS = 8
_ENTRIES = "bucket int, versions array<int>, rows bigint, of int"


@dataclass(frozen=True)
class Buckets:
    """path: where the table lies. key: the column whose hash deals rows to buckets. schema: of the rows."""

    path: str
    key: str
    schema: T.StructType

    def bucket(self, of: int, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(of)).cast("int")

    def entries(self, spark: SparkSession, version: int) -> list:
        """What the version is made of; nothing before the first one."""
        found = existing(spark, f"{self.path}/manifest/version={version}") if version >= 0 else None
        return [] if found is None else found.collect()

    def paths(self, entries: list, only: set[int] | None = None) -> list[str]:
        return [f"{self.path}/data/version={v}/bucket={e.bucket}" for e in entries if only is None or e.bucket in only for v in e.versions]

    def read(self, spark: SparkSession, version: int, only: set[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets."""
        paths = self.paths(self.entries(spark, version), only)
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def hit(self, keys: DataFrame, of: int) -> set[int]:
        """The buckets of keys (a column named like the key); no more than there are buckets."""
        return {r.b for r in keys.select(self.bucket(of).alias("b")).distinct().collect()}

    def create(self, rows: DataFrame, of: int, version: int = 0) -> None:
        """A version made of these rows alone, in `of` buckets."""
        self._write(rows, of, version, [])

    def replace(self, rows: DataFrame, version: int, touched: set[int]) -> None:
        """The version after `version - 1`, in which the touched buckets hold exactly these rows."""
        old = self.entries(rows.sparkSession, version - 1)
        self._write(rows, old[0].of, version, [e for e in old if e.bucket not in touched])

    def append(self, rows: DataFrame, version: int) -> None:
        """The version after `version - 1` with these rows besides. Buckets in many versions, of those that are touched, are written together."""
        spark = rows.sparkSession
        old = self.entries(spark, version - 1)
        of = old[0].of
        full = {e.bucket for e in old if len(e.versions) >= MOST_VERSIONS}
        full = full & self.hit(rows, of) if full else full
        if full:
            rows = rows.select(*self.schema.names).unionByName(self.read(spark, version - 1, full))
        self._write(rows, of, version, [e for e in old if e.bucket not in full])

    def _write(self, rows: DataFrame, of: int, version: int, kept: list) -> None:
        spark, data = rows.sparkSession, f"{self.path}/data/version={version}"
        # Rebalanced, a bucket is one file, unless it is large.
        rows.select(*self.schema.names).withColumn("bucket", self.bucket(of)).hint("rebalance", "bucket").write.partitionBy("bucket").mode("overwrite").parquet(data)
        written = existing(spark, data)
        counts = {} if written is None or "bucket" not in written.columns else {r.bucket: r.n for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        lines = {e.bucket: (e.bucket, [*e.versions], e.rows, of) for e in kept}
        for b, n in counts.items():
            _, versions, before, _ = lines.get(b, (b, [], 0, of))
            lines[b] = (b, [*versions, version], before + n, of)
        # A table without rows still says how many buckets it has.
        spark.createDataFrame([*lines.values()] or [(0, [], 0, of)], _ENTRIES).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
