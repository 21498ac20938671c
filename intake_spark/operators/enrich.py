"""Filling empty fields of records that were written, each company at most once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

#: Actions after which a record is ours.
PUSHED = ("created", "updated", "exists", "unchanged")


def pushed(queue: DataFrame, actions=PUSHED) -> DataFrame:
    """domain, the CRM id of its last row, and the place of its first."""
    rows = queue.filter(C.blank_to_null("crm_id").isNotNull() & F.col("action").isin(*actions)).withColumn("domain", C.normalize_domain("domain", "crm"))
    at = F.struct("batch", "order_key")
    return rows.groupBy("domain").agg(F.max_by("crm_id", at).alias("crm_id"), F.min(at).alias("place"))


def enrich_todo(push: DataFrame, crm: DataFrame, done: DataFrame) -> DataFrame:
    """Pushed domains that are not done: state todo, or not_needed where both fields are filled."""
    rows = push.join(done.select("domain").distinct(), "domain", "left_anti").join(crm.select(F.col("id").alias("crm_id"), "numberofemployees", "industry"), "crm_id", "left")
    full = C.blank_to_null("numberofemployees").isNotNull() & C.blank_to_null("industry").isNotNull()
    return rows.select("domain", "crm_id", "place", F.when(full, "not_needed").otherwise("todo").alias("state"))


def limit_todo(todo: DataFrame, n: int) -> DataFrame:
    """todo rows with state todo or waiting: the first n, by place, are done now. The n first are found by a top-n, not by a window over all."""
    open_ = todo.filter("state = 'todo'")
    now = open_.orderBy("place", "domain").limit(max(0, n)).select("domain").withColumn("_now", F.lit(True))
    return open_.join(now, "domain", "left").withColumn("state", F.when(F.col("_now"), "todo").otherwise("waiting")).drop("_now")


def _plain(c: Column | str, drop_and: bool = False) -> Column:
    text = F.replace(F.replace(F.lower(F.coalesce(C.as_col(c), F.lit(""))), F.lit("_"), F.lit(" ")), F.lit("&"), F.lit(" and "))
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\band\b", " ") if drop_and else text, "[^a-z0-9]", "")


def industry_index(options: DataFrame) -> DataFrame:
    """options (order_key, label, value) to key and the value of the first option that has it: label and value, with and without the word and."""
    keys = F.array(*[F.struct(F.lit(i).alias("i"), _plain(c, d).alias("key")) for i, (c, d) in enumerate((("label", False), ("label", True), ("value", False), ("value", True)))])
    rows = options.select("order_key", "value", F.explode(keys).alias("x")).filter("x.key <> ''")
    return rows.groupBy(F.col("x.key").alias("key")).agg(F.min_by("value", F.struct("order_key", "x.i")).alias("value"))


def map_industry(df: DataFrame, index: DataFrame, column: str = "industry", into: str = "mapped") -> DataFrame:
    one, two = index.withColumnsRenamed({"key": "_k1", "value": "_v1"}), index.withColumnsRenamed({"key": "_k2", "value": "_v2"})
    out = df.join(one, _plain(column) == F.col("_k1"), "left").join(two, _plain(column, True) == F.col("_k2"), "left")
    return out.withColumn(into, F.coalesce("_v1", "_v2")).drop("_k1", "_v1", "_k2", "_v2")


def apply_enrichment(results: DataFrame, push: DataFrame, crm: DataFrame, done: DataFrame, index: DataFrame) -> DataFrame:
    """results (order_key, domain, found, estimated_num_employees, industry) of pushed domains that are not done: the last of each domain, with
    status ok, no_new_data or not_found, and what is written into fields that were empty."""
    rows = results.withColumn("domain", C.normalize_domain("domain", "crm"))
    last = rows.groupBy("domain").agg(F.max_by(F.struct("found", "estimated_num_employees", "industry"), "order_key").alias("r")).select("domain", "r.*")
    ours = last.join(done.select("domain").distinct(), "domain", "left_anti").join(push.select("domain", "crm_id"), "domain")
    record = crm.select(F.col("id").alias("crm_id"), C.blank_to_null("numberofemployees").alias("_n"), C.blank_to_null("industry").alias("_i"))
    df = map_industry(ours.join(record, "crm_id", "left"), index)
    found = F.coalesce("found", F.lit(False))
    n = F.when(found & F.col("_n").isNull(), C.employees("estimated_num_employees").cast("string"))
    i = F.when(found & F.col("_i").isNull() & (F.coalesce("industry", F.lit("")) != ""), F.col("mapped"))
    unmapped = F.when(found & F.col("_i").isNull() & (F.coalesce("industry", F.lit("")) != "") & F.col("mapped").isNull(), F.concat("domain", F.lit(": "), "industry"))
    status = F.when(~found, "not_found").when(F.coalesce(n, i).isNotNull(), "ok").otherwise("no_new_data")
    return df.select("domain", "crm_id", status.alias("status"), n.alias("numberofemployees"), i.alias("industry"), unmapped.alias("unmapped"))


def leftover(results: DataFrame, ledger: DataFrame, push: DataFrame) -> DataFrame:
    """Results of pushed domains that the ledger does not hold yet; they are tried again."""
    rows = results.withColumn("domain", C.normalize_domain("domain", "crm"))
    return rows.join(ledger.select("domain").distinct(), "domain", "left_anti").join(push.select("domain"), "domain", "left_semi")


def unmapped_industries(applied: DataFrame) -> DataFrame:
    """The industries that no option stands for, one row per company: domain and text."""
    return applied.filter("unmapped IS NOT NULL").select("domain", F.col("unmapped").alias("text"))


def enrich_summary(applied: DataFrame) -> DataFrame:
    """Counts; the unmapped industries themselves are rows of unmapped_industries."""
    of = lambda s: F.count_if(F.col("status") == s)
    return applied.agg(of("ok").alias("enriched"), of("not_found").alias("not_found"), of("no_new_data").alias("no_new_data"), F.count("unmapped").alias("unmapped"))


