"""Work lists, outcomes of judging calls, stop points and state changes of runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.tables import BATCH, staged
from .selection import RUN, count_before

#: How a message of the judging tool that a limit is reached begins, and signs of a passing failure.
LIMIT = (
    r"(?im)^[\s\W]{0,3}(?:error:\s*)?(?:claude(?: ai)? usage limit reached|usage limit reached|api error:? (?:429\b|.{0,40}?rate limit)|you(?:'|’)?(?:ve| have) (?:hit|reached) your (?:usage )?limit"
    r"|you(?:'|’)?re out of extra usage|(?:\d+-hour|weekly|daily|session|opus|sonnet) limit reached|your (?:usage )?limit will reset)"
)
PASSING = r"(?i)overloaded|api error: 5\d\d|internal server error|connection (error|reset)|ECONNRESET|ETIMEDOUT|socket hang up"


def retryable(max_attempts: int) -> Column:
    status = F.coalesce("status", F.lit("pending"))
    return (
        (status == "pending") | ((status == "error") & (F.coalesce("attempts", F.lit(0)) < max_attempts))
        | ((status == "hubspot_error") & (F.coalesce("hubspot_attempts", F.lit(0)) < max_attempts))
    )


def work_list(queue: DataFrame, batch: str, max_attempts: int) -> DataFrame:
    """Retryable rows up to the batch, oldest batch first, each domain once; position from 1 and whether a row is backlog.

    Positions are sums: of the batches before, then of the runs of order keys before in the batch, then inside the run.
    """
    rows = queue.withColumn("domain", C.normalize_domain("domain", "crm")).filter((F.col("domain") != "") & F.col("batch").rlike(BATCH) & (F.col("batch") <= batch) & retryable(max_attempts))
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("domain").orderBy("batch", "order_key"))).filter("_n = 1").drop("_n")
    first = staged(first.withColumn("_one", F.lit(True)), "work")
    sizes = first.groupBy("batch").agg(F.count("*").alias("_size")).withColumn("_base", F.coalesce(F.sum("_size").over(Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = count_before(first, {"_before": "_one"}).join(sizes, "batch").withColumn("position", F.col("_base") + F.col("_before") + 1)
    return placed.withColumn("backlog", F.col("batch") < batch).drop("_size", "_base", "_before", "_one")


def pull_quota(work: DataFrame, cap: int) -> DataFrame:
    backlog = F.count_if("backlog")
    return work.agg(backlog.alias("backlog"), F.greatest(F.lit(0), F.lit(cap) - backlog).alias("quota"))


def classify_outcome() -> Column:
    """timeout, usage_limit, transient, error or ok, from rc, timed_out, stdout, stderr and the struct json."""
    j = F.col("json")
    failed = ~F.coalesce(F.col("rc") == 0, F.lit(False)) | F.coalesce(j["is_error"], F.lit(False)) | j.isNull()
    parts = [C.blank_to_null(x) for x in (j["result"], j["error"], j["subtype"], F.col("stderr"))]
    text = F.concat_ws("\n", *parts, F.when(j.isNull(), C.blank_to_null("stdout")))
    code = j["api_error_status"].try_cast("int")
    # Where the text is the tool's own JSON, only its message fields count.
    fields = [F.coalesce(F.get_json_object(text, f"$.{k}"), F.lit("")) for k in ("result", "error")]
    own = F.when(C.is_json_object(text), F.concat_ws("\n", *fields)).otherwise(text)
    limit = F.coalesce(code == 429, F.lit(False)) | (~(F.coalesce(F.col("rc") == 0, F.lit(False)) & (text == "")) & own.rlike(LIMIT))
    passing = F.coalesce(code >= 500, F.lit(False)) | text.rlike(PASSING)
    return F.when(F.coalesce("timed_out", F.lit(False)), "timeout").when(failed & limit, "usage_limit").when(failed & passing, "transient").when(failed, "error").otherwise("ok")


@dataclass(frozen=True)
class Limits:
    cap: int
    seconds: float
    errors: int = 5
    transients: int = 3
    reserve: float = 120


def scanned(df: DataFrame, by: str, sums: dict[str, Column], streaks: dict[str, tuple[Column, Column]], segment: int | None = None) -> DataFrame:
    """df (by, order_key) with, for each of sums, its sum over earlier rows of the group, and, for each of streaks, how many rows with its first flag there
    are since the last one with its second, up to the row itself.

    Rows are scanned in segments of order keys. A segment's summary is its sums, its trailing streak, and whether any row has ended one before; summaries
    combine in order, so a group of any size is many tasks, and only a line a segment meets in one.
    """
    rows = df.withColumn("_seg", F.floor(F.col("order_key") / (segment or RUN)).cast("long"))
    inside = Window.partitionBy(by, "_seg").orderBy("order_key")
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    flags = {f"_f_{k}": zero(flag.cast("int")) for k, (flag, _) in streaks.items()} | {f"_r_{k}": zero(end.cast("int")) for k, (_, end) in streaks.items()}
    rows = rows.withColumns(flags | {f"_v_{k}": zero(v) for k, v in sums.items()})
    rows = rows.withColumns({f"_b_{k}": zero(F.sum(f"_v_{k}").over(before)) for k in sums} | {f"_i_{k}": F.sum(f"_r_{k}").over(upto) for k in streaks})
    island = lambda k: Window.partitionBy(by, "_seg", f"_i_{k}").orderBy("order_key").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_s_{k}": F.sum(f"_f_{k}").over(island(k)) for k in streaks})

    trailing = {f"_t_{k}": F.max_by(f"_s_{k}", "order_key") for k in streaks} | {f"_e_{k}": F.max(f"_r_{k}") for k in streaks}
    parts = rows.groupBy(by, "_seg").agg(*[F.sum(f"_v_{k}").alias(f"_w_{k}") for k in sums], *[c.alias(k) for k, c in trailing.items()])
    earlier = Window.partitionBy(by).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    ends = {f"_g_{k}": zero(F.sum(f"_e_{k}").over(Window.partitionBy(by).orderBy("_seg"))) for k in streaks}
    parts = parts.withColumns({f"_c_{k}": zero(F.sum(f"_w_{k}").over(earlier)) for k in sums} | ends)
    # What a segment hands on: its own trailing streak, and, if none of its rows has ended one, what was handed to it.
    parts = parts.withColumns({f"_u_{k}": F.sum(f"_t_{k}").over(Window.partitionBy(by, f"_g_{k}").orderBy("_seg")) for k in streaks})
    handed = {f"_h_{k}": zero(F.lag(f"_u_{k}").over(Window.partitionBy(by).orderBy("_seg"))) for k in streaks}
    parts = parts.withColumns(handed).select(by, "_seg", *[f"_c_{k}" for k in sums], *handed)
    out = rows.join(parts, [by, "_seg"])
    made = {k: F.col(f"_b_{k}") + F.col(f"_c_{k}") for k in sums} | {k: F.col(f"_s_{k}") + F.when(F.col(f"_i_{k}") == 0, F.col(f"_h_{k}")).otherwise(0) for k in streaks}
    return out.select(*df.columns, *[c.alias(k) for k, c in made.items()])


def stop_point(outcomes: DataFrame, limits: Limits, segment: int | None = None) -> DataFrame:
    """outcomes (run, order_key, kind, good, crm_only, duration) with `processed` so far, `state` and the run's stop reason.

    state: done (worked on and counted), left (the row at which the run stopped, untouched) or after. A usage limit, the cap and the deadline stop at
    their row without counting it; the streaks count the row that completes them. Only a good verdict ends a streak of errors, any outcome but
    a transient one ends a streak of those, and retries of the CRM write alone touch neither.
    """
    crm = F.coalesce("crm_only", F.lit(False))
    limit, transient = ~crm & (F.col("kind") == "usage_limit"), ~crm & (F.col("kind") == "transient")
    good = ~crm & F.coalesce("good", F.lit(False))
    error = ~crm & ~F.coalesce("good", F.lit(False)) & (F.col("kind") != "usage_limit")
    df = scanned(outcomes, "run", {"_before": F.lit(1), "_spent": F.col("duration")}, {"_es": (error, good), "_ts": (transient, ~transient & ~crm)}, segment)
    why = (
        F.when(F.col("_before") >= limits.cap, "cap_reached").when(F.lit(limits.seconds) - F.col("_spent") < limits.reserve, "deadline").when(limit, "usage_limit")
        .when(transient & (F.col("_ts") >= limits.transients), "api_errors").when(error & (F.col("_es") >= limits.errors), "consecutive_errors")
    )
    df = df.withColumn("_why", why)
    stopped = df.groupBy("run").agg(F.min(F.when(F.col("_why").isNotNull(), F.struct("order_key", "_why"))).alias("_stop"))
    df = df.join(stopped, "run")
    at, counted = F.col("_stop.order_key"), F.col("_stop._why").isin("api_errors", "consecutive_errors")
    state = F.when(at.isNull() | (F.col("order_key") < at) | ((F.col("order_key") == at) & counted), "done").when(F.col("order_key") == at, "left").otherwise("after")
    return df.select(*outcomes.columns, F.col("_stop._why").alias("stop_reason"), state.alias("state"))


def apply_outcomes(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Queue with the outcomes (batch, domain, state, kind, verdict, message, crm) folded in; rows without an outcome, or after the stop, stay.

    crm: the action of the CRM write, or error; conflict, invalid and human_verdict_exists go to review. Of several outcomes of a row the first by
    order_key counts, if outcomes have that, so that no row is ever doubled.
    """
    said = F.struct("kind", "verdict", "message", "crm")
    one = F.min_by(said, "order_key") if "order_key" in outcomes.columns else F.min(said)
    o = outcomes.filter("state = 'done'").groupBy("batch", "domain").agg(one.alias("_o")).select("batch", "domain", *[F.col(f"_o.{c}").alias(f"_{c}") for c in ("kind", "verdict", "message", "crm")])
    new = (
        F.when(F.col("_kind").isNull(), F.col("status")).when(F.col("_verdict").isNull(), "error").when(F.col("_crm") == "error", "hubspot_error")
        .when(F.col("_crm").isin("conflict", "invalid", "human_verdict_exists"), "needs_review").otherwise("done")
    )
    hit = F.col("_kind").isNotNull()
    return queue.join(o, ["batch", "domain"], "left").withColumns({
        "attempts": F.coalesce("attempts", F.lit(0)) + hit.cast("int"),
        "hubspot_attempts": F.coalesce("hubspot_attempts", F.lit(0)) + F.coalesce(hit & F.col("_verdict").isNotNull() & (F.col("_crm") == "error"), F.lit(False)).cast("int"),
        "verdict": F.coalesce("_verdict", "verdict"), "error": F.when(hit & (new.isin("error", "hubspot_error", "needs_review")), F.col("_message")), "status": new,
    }).drop("_kind", "_verdict", "_message", "_crm")


def crm_retries(queue: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows whose CRM write failed and whose verdict is kept: no new judging."""
    return queue.filter("status = 'hubspot_error'").join(verdicts.select("domain").distinct(), "domain", "left_semi")


def left_counts(queue: DataFrame, batch: str, max_attempts: int) -> DataFrame:
    rows = queue.filter(F.col("batch").rlike(BATCH) & (F.col("batch") <= batch))
    return rows.agg(F.count_if(F.col("status") == "pending").alias("pending_left"), F.count_if(retryable(max_attempts)).alias("retryable_left"))


def resume_decision(runs: DataFrame, max_api_errors: int = 4) -> DataFrame:
    """runs (chain, order_key, stopped_reason, processed, message, at) with decision and wait_seconds.

    After a row of API errors longer than allowed, or a run that got through nothing, the chain stops.
    """
    api = F.coalesce(F.col("stopped_reason") == "api_errors", F.lit(False))
    df = scanned(runs, "chain", {}, {"_streak": (api, ~api)}).withColumn("_streak", F.col("_streak") - 1)
    goes_on = F.coalesce("stopped_reason", F.lit("")).isin("", "completed", "deadline", "cap_reached")
    decision = (
        F.when(F.col("stopped_reason") == "usage_limit", "wait_reset").when(api, F.when(F.col("_streak") < max_api_errors, "wait_api").otherwise("stop"))
        .when(goes_on & (F.coalesce("processed", F.lit(0)) > 0), "continue").otherwise("stop")
    )
    return df.withColumn("decision", decision).withColumn("wait_seconds", F.when(F.col("decision") == "wait_reset", C.reset_wait("message", F.col("at")))).drop("_streak")
