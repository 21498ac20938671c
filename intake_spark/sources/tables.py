"""Reading intake files, and writing batches and ledgers as partitioned Parquet."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_json_object

BATCH = r"^\d{4}-\d{2}-\d{2}[b-z]?$"
#: Order keys of one file; longer than any file has bytes.
FILE_SPAN = 1 << 40
#: Columns of an accounts export and ours.
ACCOUNT_COLUMNS = {
    "Company Name": "name", "Website": "domain", "Industry": "industry", "# Employees": "headcount", "Company Country": "country", "Keywords": "keywords", "Technologies": "technologies",
    "Apollo Account Id": "account_id", "Parent company (Apollo data)": "parent_company",
}


def parse_jsonl(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """lines with a struct `row` (null for what is not a JSON object) and `bad`; blank lines are left out."""
    parsed = lines.filter(F.trim(line) != "").withColumn("bad", ~is_json_object(line))
    return parsed.withColumn("row", F.when(~F.col("bad"), F.from_json(line, schema)))


def in_file_order(rows: DataFrame) -> DataFrame:
    """rows as a reader gives them, with file and block (where the split begins in it), to rows with order_key and line_no.

    order_key is a number: files follow each other by page number, then name, and rows by place in their file. A reader hands out splits
    in an order of its own, so the place of a row in its split is counted from the first of that split. Only one row per split is gathered.
    """
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = numbered.groupBy("file", "block").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")).withColumns({
        "_before": F.coalesce(F.sum("_rows").over(in_file), F.lit(0)),
        "_file": F.dense_rank().over(Window.orderBy(page_number(F.col("file")), "file")).cast("long") - 1,
    })
    # A row takes a byte of its file at least, so that the rows of a split end before the next one begins.
    place = F.col("_at") - F.col("_first")
    out = numbered.join(splits, ["file", "block"]).withColumns({"order_key": F.col("_file") * FILE_SPAN + F.col("block") + place, "line_no": F.col("_before") + place + 1})
    return out.drop("_at", "_first", "_rows", "_before", "_file", "block")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with file and order_key, a number that keeps line order; bad lines as file, line_no and value)."""
    lines = spark.read.text(path).selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS block")
    parsed = parse_jsonl(in_file_order(lines), schema)
    return parsed.filter("NOT bad").select("file", "order_key", "row.*"), parsed.filter("bad").select("file", "line_no", "value")


def page_number(file: Column) -> Column:
    return F.regexp_extract(file, r"page-(\d+)", 1).try_cast("int")


def read_pages(spark: SparkSession, path: str, schema: T.StructType, batch: str | None = None) -> DataFrame:
    """Rows of page files, ready for the selection: page_no, an order_key that has page-2 before page-10 and keeps line order, and the batch, if given."""
    rows, _ = read_jsonl(spark, path, schema)
    rows = rows.withColumn("page_no", page_number(F.col("file")))
    return rows if batch is None else rows.withColumn("batch", F.lit(batch))


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a field of a CSV file may hold a line break: then a line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_accounts_csv(spark: SparkSession, path: str, batch: str | None = None, line_breaks: bool | None = None) -> DataFrame:
    """An accounts export with our column names, in file order, ready for the import; technologies are split on commas.

    A file is split over tasks unless its fields hold line breaks. line_breaks: whether they do, where that is known; else the files are looked through.
    """
    whole = has_line_breaks(spark, path) if line_breaks is None else line_breaks
    df = spark.read.csv(path, header=True, multiLine=whole, escape='"')
    names = {c: c.lstrip("\ufeff").strip() for c in df.columns}
    if "Apollo Account Id" not in names.values():
        raise ValueError("this is no accounts export: it has no column 'Apollo Account Id'")
    known = [F.col(f"`{c}`").alias(ACCOUNT_COLUMNS[name]) for c, name in names.items() if name in ACCOUNT_COLUMNS]
    out = in_file_order(df.select(*known, "_metadata.file_path", "_metadata.file_block_start").withColumnsRenamed({"file_path": "file", "file_block_start": "block"}))
    if "technologies" in out.columns:
        parts = F.transform(F.split("technologies", ","), lambda x: F.trim(x))
        out = out.withColumn("technologies", F.filter(parts, lambda x: x != ""))
    return out.drop("file", "line_no") if batch is None else out.drop("file", "line_no").withColumn("batch", F.lit(batch))


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # nothing written there yet
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def absent_batches(df: DataFrame, old: DataFrame | None) -> DataFrame:
    """Rows of batches that old does not hold."""
    return df if old is None else df.join(old.select(F.col("batch").cast("string").alias("batch")).distinct(), "batch", "left_anti")


def write_batch_once(df: DataFrame, path: str) -> None:
    """Append the batches that are not there yet; a batch that exists is never changed."""
    # Rebalanced, a small batch is one file, and Spark splits a large one over several writers.
    absent_batches(df, existing(df.sparkSession, path)).hint("rebalance", "batch").write.partitionBy("batch").mode("append").parquet(path)


def rewrite_batches(df: DataFrame, path: str) -> None:
    """Replace exactly the batches that df holds."""
    df.hint("rebalance", "batch").write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def append_ledger(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append rows whose keys the ledger does not hold yet."""
    old = existing(df.sparkSession, path)
    new = df if old is None else df.join(old.select(keys).distinct(), keys, "left_anti")
    new.dropDuplicates(keys).write.mode("append").parquet(path)


def append_bucketed_ledger(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = 256) -> DataFrame:
    """Append rows whose keys the ledger does not hold yet to a table of the session's catalog that is bucketed and sorted by the keys; the table.

    A join or anti-join on these keys takes the history as it lies, without an exchange: only the other side is dealt out.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        new = df.join(spark.table(table).select(keys), keys, "left_anti").dropDuplicates(keys)
        new.write.bucketBy(buckets, *keys).sortBy(*keys).mode("append").saveAsTable(table, path=path)
    else:
        df.dropDuplicates(keys).repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table, path=path)
    return spark.table(table)


def assign_batch_ids(arrivals: DataFrame, used: DataFrame) -> DataFrame:
    """arrivals (day, order_key) with `batch`: the day, then the day with b ... z, in order, skipping used ones; null when all 26 are taken."""
    spark = arrivals.sparkSession
    letters = spark.range(26).select(F.when(F.col("id") == 0, "").otherwise(F.chr(F.col("id") + 97)).alias("letter"))
    free = arrivals.select("day").distinct().withColumn("_one", F.lit(1)).join(F.broadcast(letters.withColumn("_one", F.lit(1))), "_one").select("day", F.concat("day", "letter").alias("batch"))
    free = free.join(used.select("batch").distinct(), "batch", "left_anti").withColumn("n", F.row_number().over(Window.partitionBy("day").orderBy("batch")))
    # Only the first 26 of a day can get an id, and Spark leaves out the others before it shuffles.
    first = arrivals.select("day", "order_key").withColumn("n", F.row_number().over(Window.partitionBy("day").orderBy("order_key"))).filter("n <= 26")
    named = first.join(free, ["day", "n"]).groupBy("day", "order_key").agg(F.min("batch").alias("batch"))
    return arrivals.join(named, ["day", "order_key"], "left")


def latest_batch(queue: DataFrame, today: str) -> DataFrame:
    """One row: the newest valid batch id, at least today."""
    return queue.filter(F.col("batch").rlike(BATCH)).agg(F.greatest(F.coalesce(F.max("batch"), F.lit(today)), F.lit(today)).alias("batch"))


def credits_used(files: DataFrame) -> DataFrame:
    """files (batch, length) to the number of non-empty page files of each batch."""
    return files.filter(F.col("length") > 0).groupBy("batch").agg(F.count("*").alias("credits"))


def orphan_batches(candidates: DataFrame, queue: DataFrame, before: str) -> DataFrame:
    """Valid batches before a date with candidates and no queue."""
    return candidates.select("batch").filter(F.col("batch").rlike(BATCH) & (F.col("batch") < before)).distinct().join(queue.select("batch").distinct(), "batch", "left_anti")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where all of Spark is one process, a temporary one will do."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def new_path(spark: SparkSession, kind: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def staged(df: DataFrame, kind: str) -> DataFrame:
    """Write df below the shared folder and read it back: it is computed once, however often it is used."""
    path = new_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
