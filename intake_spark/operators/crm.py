"""Reconciling qualified companies with a CRM snapshot: matches, properties, actions, field changes and the next snapshot.

A record's empty string and null mean the same. A verdict that a person has set is never reversed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.tables import staged
from . import verdicts as G

IDENTITY = ("name", "domain", "website")
ONLY_IF_EMPTY = ("sourcing_sourced_from", "numberofemployees", "hubspot_owner_id")
STAGE = "sourcing_account_stage"
STATUS = "sourcing_qualification_status"
ENUMS = tuple(f"sourcing_{k}" for k in G.TOKENS)
TEXTS = tuple(f"sourcing_{k}" for k in G.TEXTS)
#: The properties that are written.
PROPERTIES = (*IDENTITY, STATUS, STAGE, "sourcing_sourced_from", "sourcing_p1_date", "hubspot_owner_id", *ENUMS, *TEXTS, "sourcing_evidence_links", "numberofemployees")
#: Actions that a person has to look at.
REVIEW = ("conflict", "invalid", "human_verdict_exists")


def crm_hosts(crm: DataFrame) -> DataFrame:
    """(id, host): the hosts of each record's domain and website."""
    both = F.array_distinct(F.array(C.normalize_domain("domain", "crm"), C.normalize_domain("website", "crm")))
    return crm.select("id", F.explode(both).alias("host")).filter("host <> ''")


def new_id(key: Column | str) -> Column:
    """The id of the record that is created for a domain."""
    return F.concat(F.lit("new-"), F.substring(F.sha1(C.as_col(key)), 1, 16))


def crm_matches(verdicts: DataFrame, crm: DataFrame) -> DataFrame:
    """verdicts (domain) with matches, the number of records whose domain or website has that host, and id of the record if it is one."""
    counted = crm_hosts(crm).groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("matches"), F.min("id").alias("id"))
    out = verdicts.join(counted, verdicts["domain"] == counted["_host"], "left").drop("_host")
    return out.withColumn("matches", F.coalesce("matches", F.lit(0))).withColumn("id", F.when(F.col("matches") == 1, F.col("id")))


def build_properties(verdicts: DataFrame, queue: DataFrame, date: str, sourced_from: str = "Apollo", owner: str = "") -> DataFrame:
    """Per qualified verdict (fields of the contract, and queue rows by domain: domain, name, headcount): domain, the properties, or a reason."""
    # Of several queue rows of a domain the first in queue order counts, as a whole row.
    row = F.struct(F.col("name").alias("_qn"), C.to_int("headcount").alias("_qh"))
    place = [c for c in ("batch", "order_key") if c in queue.columns]
    q = queue.select(C.normalize_domain("domain", "crm").alias("_qd"), row.alias("_row"), F.struct(*place, row).alias("_place")).filter("_qd <> ''")
    q = q.groupBy("_qd").agg(F.min_by("_row", "_place").alias("_row")).select("_qd", "_row.*")
    v = verdicts.withColumn("_vd", C.normalize_domain("domain", "crm"))
    df = v.join(q, F.col("_vd") == F.col("_qd"), "left")
    labels = lambda tokens: F.create_map(*[F.lit(x) for pair in tokens.items() for x in pair])
    text = lambda k: C.blank_to_null(C.strip(k))
    links = F.filter(F.transform("evidence_links", C.strip), lambda x: x != "")
    values = {
        "name": C.strip(C.first_filled("name", "_qn", "_vd")), "domain": F.col("_vd"), "website": F.concat(F.lit("https://"), "_vd"), STATUS: F.lit("Qualified"), STAGE: F.lit("Qualified"), "sourcing_sourced_from": F.lit(sourced_from),
        "sourcing_p1_date": F.lit(date), "hubspot_owner_id": C.blank_to_null(F.lit(owner)), **{f"sourcing_{k}": labels(t)[F.col(k)] for k, t in G.TOKENS.items()}, **{f"sourcing_{k}": text(k) for k in G.TEXTS},
        "sourcing_evidence_links": C.blank_to_null(F.array_join(links, " | ")), "numberofemployees": F.when(F.col("_qh") != 0, F.col("_qh").cast("string")),
    }
    reason = (
        F.when(~F.coalesce(F.col("qualification") == "QUALIFIED", F.lit(False)), "only QUALIFIED verdicts are written").when(~F.coalesce(F.col("buyer_or_vendor") == "BUYER", F.lit(False)), "QUALIFIED requires BUYER")
        .when(~F.lit(date).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(f"bad date {date}")).when(F.col("_vd") == "", "no domain").when(F.col("_qd").isNull(), "domain mismatch: not in the queue")
    )
    carried = [c for c in verdicts.columns if c not in values and c not in G.STRINGS and c not in ("evidence_links", "status", "error")]
    return df.select(*carried, F.col("_vd").alias("key"), reason.alias("reason"), F.when(reason.isNull(), F.struct(*[values[p].alias(p) for p in PROPERTIES])).alias("props"))


def bad_options(props: DataFrame, options: DataFrame, checked=(STATUS, STAGE, "sourcing_sourced_from", *ENUMS)) -> DataFrame:
    """props (key, props) to (key, property, value) of values that the live options do not hold; a property without options has no valid value."""
    pairs = F.array(*[F.struct(F.lit(p).alias("property"), F.col("props")[p].alias("value")) for p in checked])
    long = props.filter("props IS NOT NULL").select("key", F.explode(pairs).alias("x")).select("key", "x.*").filter("value IS NOT NULL")
    return long.join(options.select("property", "value").distinct(), ["property", "value"], "left_anti").select("key", "property", "value")


def _changes(old: Column, new: Column) -> dict[str, Column]:
    """Property to its new value where the rules let it change, else null."""
    out = {}
    for p in PROPERTIES:
        had, want = F.coalesce(old[p], F.lit("")), new[p]
        if p in IDENTITY:
            test = F.lit(False)
        elif p == STAGE:
            test = had.isin("", "Sourced")
        elif p in ONLY_IF_EMPTY:
            test = had == ""
        else:
            test = had != want
        out[p] = F.when(test, want)
    return out


def plan_actions(props: DataFrame, crm: DataFrame, options: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """props (key, reason, props) with action, id and changes (a struct of what is to be written): one row per domain, the smallest name first."""
    one = props.filter("props IS NOT NULL").withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("props"))).filter("_n = 1").drop("_n")
    one = staged(one.select("key", "props"), "properties")  # matched and checked below, but made once
    found = crm_matches(one.withColumn("domain", F.col("key")), crm).drop("domain")
    record = crm.select(F.col("id").alias("_rid"), F.struct(*[(F.col(p) if p in crm.columns else F.lit(None).cast("string")).alias(p) for p in PROPERTIES]).alias("old"))
    df = found.join(record, F.col("id") == F.col("_rid"), "left").drop("_rid")
    bad = bad_options(one, options).select("key").distinct().withColumn("_bad", F.lit(True)) if options is not None else None
    df = df.join(bad, "key", "left") if bad is not None else df.withColumn("_bad", F.lit(False))
    status = F.coalesce(F.col("old")[STATUS], F.lit(""))
    made = C.let(F.struct("old", "props"), lambda both: F.struct(*[c.alias(p) for p, c in _changes(both["old"], both["props"]).items()]))
    df = df.withColumn("_changes", made)
    nothing = C.let(F.col("_changes"), lambda x: F.coalesce(*[x[p] for p in PROPERTIES]).isNull())
    action = (
        F.when(F.coalesce("_bad", F.lit(False)), "invalid").when(F.col("matches") > 1, "conflict").when(F.col("matches") == 0, "created").when(status == "Qualified", "exists")
        .when(~status.isin("", "Not Reviewed"), "human_verdict_exists").when(nothing, "unchanged").otherwise("updated")
    )
    df = df.withColumn("plan", action)
    shown = F.when(F.lit(dry_run) & F.col("plan").isin("created", "updated"), "dry_run").otherwise(F.col("plan"))
    written = F.when(F.col("plan") == "created", F.col("props")).when(F.col("plan") == "updated", F.col("_changes"))
    return df.select("key", "id", "matches", shown.alias("action"), "plan", written.alias("changes"))


def field_changes(plan: DataFrame, crm: DataFrame) -> DataFrame:
    """One row per record and property that changes: id, property, old_value, new_value."""
    pairs = F.array(*[F.struct(F.lit(p).alias("property"), (F.col(p) if p in crm.columns else F.lit(None).cast("string")).alias("old_value"), F.col("changes")[p].alias("new_value")) for p in PROPERTIES])
    return plan.filter("plan = 'updated'").select("id", "changes").join(crm, "id").select("id", F.explode(pairs).alias("x")).select("id", "x.*").filter("new_value IS NOT NULL")


def merge_crm(crm: DataFrame, plan: DataFrame) -> DataFrame:
    """The next snapshot: records as they were, updated ones, and created ones with an id from their domain. The same plan again changes nothing."""
    update = plan.filter("action = 'updated'").select("id", "changes")
    new = F.col("changes")
    merged = crm.join(update, "id", "left").select([F.coalesce(new[c], F.col(c)).alias(c) if c in PROPERTIES else F.col(c) for c in crm.columns])
    created = plan.filter("action = 'created'").select(new_id("key").alias("id"), *[F.col("changes")[p].alias(p) for p in PROPERTIES if p in crm.columns])
    return merged.unionByName(created, allowMissingColumns=True)


def action_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("n")).withColumn("needs_review", F.col("action").isin(*REVIEW))
