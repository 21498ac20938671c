"""Matching candidates with registered accounts, building queues, and recording results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .selection import count_before

#: Verdict tokens and the result they stand for.
RESULTS = {"QUALIFIED": "Qualified", "MAYBE": "Maybe", "NOT_QUALIFIED": "Not Qualified"}


def _registered(reg: DataFrame) -> DataFrame:
    return reg.select(
        C.normalize_domain("domain").alias("r_domain"), F.lower(C.strip("name")).alias("r_name"), F.col("account_id").alias("r_account"), F.col("organization_id").alias("r_org"), F.col("reg_order")
    )


def match_registered(cands: DataFrame, reg: DataFrame) -> DataFrame:
    """cands with matched_id: their own account id, else that of the first registered row by org id, else by domain, else by name where
    either side has no domain. The first tier that matches decides, even if its account id is null. Candidates are told apart by (batch, order_key)."""
    r = _registered(reg)
    # The first registered row of each key, so that no tier multiplies rows.
    first = lambda key, df: df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by("r_account", "reg_order").alias("_id")).withColumn("_hit", F.lit(True))
    named = lambda df, suffix: df.withColumnsRenamed({"_id": f"_id{suffix}", "_hit": f"_hit{suffix}"})
    out = cands.withColumn("_name", F.lower("name"))
    for key, own, suffix, rows in (("r_org", "org_id", "1", r), ("r_domain", "domain", "2", r), ("r_name", "_name", "3", r), ("r_name", "_name", "4", r.filter("r_domain IS NULL"))):
        side = named(first(key, rows), suffix).withColumnRenamed(key, f"_k{suffix}")
        out = out.join(side, F.col(own) == F.col(f"_k{suffix}"), "left").drop(f"_k{suffix}")
    by_name = F.when(F.col("domain").isNull(), F.col("_id3")).otherwise(F.col("_id4"))
    found = F.when(C.blank_to_null("account_id").isNotNull(), F.col("account_id")).when(F.col("_hit1"), F.col("_id1")).when(F.col("_hit2"), F.col("_id2")).otherwise(by_name)
    return out.withColumn("matched_id", found).drop("_name", *[f"_{x}{i}" for x in ("id", "hit") for i in "1234"])


def name_collisions(cands: DataFrame, reg: DataFrame) -> DataFrame:
    """Unmatched candidates with a domain, and the domain of the first account of the same name and another domain."""
    left = match_registered(cands, reg).filter("domain IS NOT NULL AND matched_id IS NULL").withColumn("r_name", F.lower(F.coalesce("name", F.lit(""))))
    r = _registered(reg).filter("r_domain IS NOT NULL").withColumn("r_name", F.coalesce("r_name", F.lit("")))
    # Of each name, the first row, and the first row with another domain than that: one of the two differs from the candidate's.
    per_domain = r.groupBy("r_name", "r_domain").agg(F.min("reg_order").alias("at"))
    two = per_domain.withColumn("n", F.row_number().over(Window.partitionBy("r_name").orderBy("at"))).filter("n <= 2")
    hit = left.join(two, "r_name").filter("r_domain <> domain")
    first = hit.groupBy("batch", "order_key", "domain").agg(F.min_by("r_domain", "at").alias("other"))
    return first.select("batch", "domain", "other", F.concat(F.lit("dedupe_name_collision: "), "domain", F.lit(" vs "), "other").alias("note"))


def build_queue(cands: DataFrame, reg: DataFrame, list_pattern: str = "sourced-{date}") -> DataFrame:
    """Queue rows: the candidate with the account id that was matched and the list name of its batch."""
    before, dated, after = list_pattern.partition("{date}")
    name = F.concat(F.lit(before), "batch", F.lit(after)) if dated else F.lit(before)
    return match_registered(cands, reg).withColumn("account_id", F.col("matched_id")).drop("matched_id").withColumn("list_name", name)


def build_summary(queue: DataFrame) -> DataFrame:
    none = C.blank_to_null("account_id").isNull()
    return queue.groupBy("batch").agg(F.count("*").alias("lines"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "skipped_prefilter").alias("prefiltered"), F.count_if(none).alias("missing_ids"))


def result_value() -> Column:
    """What is recorded for a row once its status is final, else null."""
    labels = F.create_map(*[F.lit(x) for pair in RESULTS.items() for x in pair])
    judged = F.coalesce(labels[F.upper(F.coalesce("verdict", F.lit("")))], F.lit("Error"))
    return F.when(F.col("status") == "skipped_prefilter", "Prefiltered").when(F.col("status") == "error", "Error").when(F.col("status").isin("done", "hubspot_error", "needs_review"), judged)


def unregistered(queue: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows with an account id and a final result that the ledger (account_id, result) does not hold; one that is bucketed by both is read as it lies."""
    rows = queue.withColumn("result", result_value()).filter(C.blank_to_null("account_id").isNotNull() & F.col("result").isNotNull())
    return rows.join(ledger.select("account_id", "result"), ["account_id", "result"], "left_anti")


def unregistered_batches(queue: DataFrame, ledger: DataFrame, upto: str) -> DataFrame:
    return unregistered(queue, ledger).filter(F.col("batch") <= upto).select("batch").distinct()


def mark_registered(todo: DataFrame, ids: DataFrame) -> DataFrame:
    """todo and ids by account id: state is registered (both), unknown (only in ids) or remaining (only in todo)."""
    given = ids.select("account_id").distinct().withColumn("_given", F.lit(True))
    both = todo.select("account_id", "result").join(given, "account_id", "full_outer")
    return both.select("account_id", "result", F.when(F.col("result").isNull(), "unknown").when(F.col("_given"), "registered").otherwise("remaining").alias("state"))


def prioritize(queue: DataFrame, wanted: DataFrame, list_name: str) -> DataFrame:
    """queue with hit, priority and position: pending rows whose account id or domain the list holds come first, the rest keep their order."""
    keys = lambda c: wanted.select(c.alias("_k")).filter("_k IS NOT NULL").distinct().withColumn("_h", F.lit(True))
    ids, domains = keys(C.blank_to_null(C.strip("account_id"))).withColumnsRenamed({"_k": "_ki", "_h": "_hi"}), keys(C.normalize_domain("website")).withColumnsRenamed({"_k": "_kd", "_h": "_hd"})
    out = queue.join(ids, F.col("account_id") == F.col("_ki"), "left").join(domains, F.col("domain") == F.col("_kd"), "left")
    out = out.withColumn("hit", F.coalesce("_hi", F.lit(False)) | F.coalesce("_hd", F.lit(False))).drop("_ki", "_hi", "_kd", "_hd")
    moved = F.col("hit") & F.coalesce(F.col("status") == "pending", F.lit(False))
    out = count_before(out.withColumns({"_moved": moved, "_stays": ~moved}), {"_first": "_moved", "_then": "_stays"}, {"_all_moved": "_first"})
    position = F.when(F.col("_moved"), F.col("_first")).otherwise(F.col("_all_moved") + F.col("_then")) + 1
    return out.withColumns({"priority": F.when(F.col("_moved"), list_name), "position": position}).drop("_moved", "_stays", "_first", "_then", "_all_moved")
