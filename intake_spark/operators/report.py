"""What a run has done, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def run_counts(queue: DataFrame, lines: DataFrame) -> DataFrame:
    """Counters per run (run is the batch date): queue gives pulled, prefiltered and pending_left; lines (run, backlog, status, qualification, action) the rest."""
    q = queue.groupBy(F.col("batch").alias("run")).agg(
        F.count_if(F.col("status") != "skipped_prefilter").alias("pulled"), F.count_if(F.col("status") == "skipped_prefilter").alias("prefiltered"), F.count_if(F.col("status") == "pending").alias("pending_left"),
    )
    is_ = lambda c, *v: F.count_if(F.coalesce(F.col(c).isin(*v), F.lit(False)))
    done = lines.groupBy("run").agg(
        F.count_if("backlog").alias("backlog"), F.count("*").alias("processed"), is_("qualification", "QUALIFIED").alias("qualified"), F.count_if(F.col("qualification").isNotNull() & (F.col("qualification") != "QUALIFIED")).alias("not_qualified"),
        is_("status", "error", "hubspot_error").alias("errors"), is_("action", "created").alias("crm_created"), is_("action", "updated").alias("crm_updated"), is_("action", "exists", "unchanged").alias("crm_skipped"),
        is_("status", "needs_review").alias("needs_review"), is_("action", "held").alias("held"),
    )
    return q.join(done, "run", "left").na.fill(0)


def _text(c: str) -> Column:
    return C.blank_to_null(C.as_col(c))


def report_rows(lines: DataFrame, portal: str = "") -> DataFrame:
    """lines with why (the reason, and before it notes on dry run, rules, scope and crawl; one line, 220 characters) and link to the record."""
    why = F.coalesce(_text("error"), _text("reason"), F.lit(""))
    why = F.when((F.col("action") == "dry_run") & _text("action_note").isNotNull(), F.concat(F.lit("("), "action_note", F.lit(") "), why)).otherwise(why)
    why = F.when(_text("backstop").isNotNull(), F.concat("backstop", F.lit(". "), why)).otherwise(why)
    why = F.when(_text("scope").isNotNull(), F.concat(F.lit("[scope: "), "scope", F.lit("] "), why)).otherwise(why)
    why = F.when(_text("crawl").isNotNull(), F.concat(F.lit("[crawl: "), "crawl", F.lit("] "), why)).otherwise(why)
    why = F.translate(why, "|\n", "/ ")
    link = F.when((C.first_filled("crm_id").isNotNull()) & F.lit(bool(portal)), F.concat(F.lit(f"https://app-na2.hubspot.com/contacts/{portal}/record/0-2/"), "crm_id")).otherwise("")
    return lines.withColumn("why", C.let(why, lambda w: F.when(F.char_length(w) > 220, F.concat(F.left(w, F.lit(217)), F.lit("..."))).otherwise(w))).withColumn("link", link)


def needs_review(lines: DataFrame) -> DataFrame:
    return lines.filter("status = 'needs_review'")


def held_rows(lines: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Qualified companies that were kept out of the CRM, with what the verdict says of them."""
    wanted = ["account_tier", "need_strength", "current_approach", "timing", "evidence_confidence", "buyer_or_vendor", "qualification_reason", "strongest_signal", "main_uncertainty", "roles_to_contact"]
    return lines.filter("action = 'held'").select("run", "domain", "name").join(verdicts.select("domain", *[c for c in wanted if c in verdicts.columns]), "domain")


def run_cost(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("run").agg(F.count("*").alias("calls"), F.sum("cost").alias("cost"), F.sum("duration").alias("seconds"), F.avg("duration").alias("mean_seconds"))


#: Normalised rank error of a sketch, with 99 % confidence, for twice as far (sketches of SKETCH_K entries).
SKETCH_K, RANK_ERROR = 400, 0.015


def duration_sketches(outcomes: DataFrame, *by: str) -> DataFrame:
    """A mergeable quantile sketch of the durations of each group, to be stored beside the run's report: a few KB, however many calls there were."""
    given = outcomes.filter("duration IS NOT NULL").withColumn("duration", F.col("duration").cast("double"))
    return given.groupBy(*by).agg(F.kll_sketch_agg_double("duration", F.lit(SKETCH_K)).alias("durations"))


def merged_durations(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches put together: nights, batches, or all there are; no call is read again."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("durations", F.lit(SKETCH_K)).alias("durations"))


def duration_quantiles(sketches: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """sketches with calls, and a column for each wanted quantile."""
    return sketches.select(
        *[c for c in sketches.columns if c != "durations"], F.kll_sketch_get_n_double("durations").alias("calls"),
        *[F.kll_sketch_get_quantile_double("durations", F.lit(p)).alias(name) for name, p in wanted.items()],
    )


def run_notes(missing: DataFrame, resurfaced: DataFrame, collisions: DataFrame, unmapped: DataFrame) -> DataFrame:
    """(run, kind, text): rows without an account id and resurfaced ones as counts, collisions and unmapped industries one by one."""
    counted = lambda df, kind, what: df.groupBy("run").agg(F.count("*").alias("n")).select("run", F.lit(kind).alias("kind"), F.concat(F.col("n").cast("string"), F.lit(what)).alias("text"))
    each = lambda df, kind: df.select("run", F.lit(kind).alias("kind"), "text")
    return counted(missing, "missing_ids", " without an account id").unionByName(counted(resurfaced, "resurfaced", " seen before")).unionByName(each(collisions, "name_collision")).unionByName(each(unmapped, "unmapped_industry"))
