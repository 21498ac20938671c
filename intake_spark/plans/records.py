"""Queries for the CRM, enrichment and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import crm as H
from ..operators import enrich as I  # noqa: E741
from ..operators import register as R
from ..operators import report as K
from ..operators import selection as S
from ..operators import verdicts as G
from . import judging as J
from . import views as V
from .intake import MATCHED, WALK
from .views import QUEUE, SCOPE, table


def crm(s, d):
    """customer as a CRM: some domains twice, status by segment, some fields empty."""
    return table(s, d, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS id", "concat(CASE WHEN c_custkey % 4 = 0 THEN 'https://www.' ELSE '' END, 'c', c_custkey % 1200, '.example') AS domain", "CASE WHEN c_custkey % 5 = 0 THEN concat('http://c', c_custkey % 1200, '.example/home') END AS website", "c_name AS name",
        "element_at(array('', 'Not Reviewed', 'Qualified', 'Needs Review', NULL), CAST(c_nationkey % 5 + 1 AS INT)) AS sourcing_qualification_status", "element_at(array('', 'Sourced', 'In Outreach'), CAST(c_custkey % 3 + 1 AS INT)) AS sourcing_account_stage",
        "CASE WHEN c_custkey % 2 = 0 THEN 'Import' END AS sourcing_sourced_from", "CASE WHEN c_custkey % 3 = 0 THEN '77' ELSE '' END AS numberofemployees", "CASE WHEN c_custkey % 4 = 1 THEN 'OLD' END AS industry", "'' AS sourcing_p1_date",
    )


def _verdicts(s, d):
    """Verdicts of documents, their domain that of the customer with the document's number."""
    df = G.accepted(J.verdict_texts(s, d).select("doc_id", "text")).filter("status = 'ok'")
    return df.withColumn("domain", F.concat(F.lit("www.C"), F.col("doc_id"), F.lit(".example")))


def _rows(s, d):
    return table(s, d, "customer").selectExpr("concat('c', c_custkey, '.example') AS domain", "c_name AS name", "CASE WHEN c_acctbal > 0 THEN concat(CAST(c_custkey AS STRING), ',000.5') END AS headcount")


def crm_matches(s, d):
    return H.crm_matches(_rows(s, d).select("domain"), crm(s, d))


def _props(s, d):
    return H.build_properties(_verdicts(s, d), _rows(s, d), "2030-01-15")


def build_properties(s, d):
    p = _props(s, d)
    return p.select("doc_id", "key", "reason", *[F.col("props")[c].alias(c) for c in ("name", "website", "sourcing_account_tier", "sourcing_qualification_reason", "sourcing_strongest_signal", "sourcing_evidence_links", "numberofemployees")])


def options(s, d):
    """Options from the verdicts' own labels, but for one label; nation and part add industries."""
    known = [(p, v) for p, vs in [*[(f"sourcing_{k}", t.values()) for k, t in G.TOKENS.items()], (H.STATUS, ["Qualified"]), (H.STAGE, ["Qualified"]), ("sourcing_sourced_from", ["Apollo"])] for v in vs if v != "Tier B"]
    pairs = F.array(*[F.struct(F.lit(p).alias("property"), F.lit(v).alias("value")) for p, v in known])
    return table(s, d, "region").select(F.explode(pairs).alias("x")).select("x.*").distinct()


def bad_options(s, d):
    return H.bad_options(_props(s, d), options(s, d))


def _plan(s, d, **more):
    return H.plan_actions(_props(s, d), crm(s, d), **more)


def plan_actions(s, d):
    return _plan(s, d, options=options(s, d)).select("key", "matches", "action")


def field_changes(s, d):
    return H.field_changes(_plan(s, d), crm(s, d))


def merge_crm(s, d):
    return H.merge_crm(crm(s, d), _plan(s, d)).select("domain", "sourcing_qualification_status", "sourcing_account_stage", "sourcing_sourced_from", "numberofemployees")


def action_counts(s, d):
    return H.action_counts(_plan(s, d))


def pushed(s, d):
    return I.pushed(V.queue(s, d)).select("domain", "crm_id", F.col("place.batch").alias("batch"), F.col("place.order_key").alias("order_key"))


def _done(s, d):
    return table(s, d, "customer").filter("c_custkey % 7 = 0").selectExpr("concat('c', c_custkey, '.example') AS domain")


def enrich_todo(s, d):
    return I.enrich_todo(I.pushed(V.queue(s, d)), crm(s, d), _done(s, d)).select("domain", "crm_id", "state")


def limit_todo(s, d):
    return I.limit_todo(I.enrich_todo(I.pushed(V.queue(s, d)), crm(s, d), _done(s, d)), 10).select("domain", "state")


def industry_options(s, d):
    return table(s, d, "part").selectExpr("p_partkey AS order_key", "concat(p_type, ' & ', p_name) AS label", "upper(concat(p_type, '_', replace(p_name, ' ', '_'))) AS value")


def industry_index(s, d):
    return I.industry_index(industry_options(s, d))


def _results(s, d):
    return table(s, d, "orders").selectExpr(
        "o_orderkey AS order_key", "concat('www.c', o_custkey, '.example') AS domain", "o_orderkey % 6 <> 0 AS found", "CASE WHEN o_orderkey % 8 = 0 THEN '0' ELSE concat(o_orderkey, '.7') END AS estimated_num_employees",
        "CASE WHEN o_orderkey % 10 = 2 THEN 'Vertical Farming' WHEN o_orderkey % 10 <> 4 THEN 'economy AND Small Ring' END AS industry",
    )


def map_industry(s, d):
    return I.map_industry(_results(s, d), I.industry_index(industry_options(s, d))).select("order_key", "industry", "mapped")


def _applied(s, d):
    return I.apply_enrichment(_results(s, d), I.pushed(V.queue(s, d)), crm(s, d), _done(s, d), I.industry_index(industry_options(s, d)))


def apply_enrichment(s, d):
    return _applied(s, d).select("domain", "status", "numberofemployees", "industry", "unmapped")


def enrich_leftover(s, d):
    ledger = _applied(s, d).filter("status = 'ok'").select("domain")
    return I.leftover(_results(s, d), ledger, I.pushed(V.queue(s, d))).select("order_key", "domain")


def unmapped_industries(s, d):
    return I.unmapped_industries(_applied(s, d))


def enrich_summary(s, d):
    return I.enrich_summary(_applied(s, d))


def lines(s, d):
    """orders as lines of runs."""
    return V.queue(s, d).selectExpr(
        "batch AS run", "order_key", "domain", "concat('Co ', order_key) AS name", "order_key % 3 = 0 AS backlog", "CASE WHEN order_key % 12 = 5 THEN 'needs_review' ELSE status END AS status", "verdict AS qualification", "action", "crm_id",
        "CASE WHEN order_key % 4 = 1 THEN repeat(concat('err|', order_key, '\\n'), CAST(order_key % 40 AS INT)) END AS error", "'reason' AS reason", "CASE WHEN order_key % 5 = 0 THEN 'would create' END AS action_note",
        "CASE WHEN order_key % 6 = 0 THEN 'lowered' END AS backstop", "CASE WHEN order_key % 7 = 0 THEN 'country=X' ELSE '' END AS scope", "CASE WHEN order_key % 11 = 0 THEN 'blocked' END AS crawl",
    ).withColumn("action", F.expr("CASE WHEN order_key % 10 = 0 THEN 'dry_run' ELSE action END"))


def run_counts(s, d):
    return K.run_counts(V.queue(s, d), lines(s, d))


def report_rows(s, d):
    return K.report_rows(lines(s, d), "123").select("run", "order_key", "why", "link")


def needs_review(s, d):
    return K.needs_review(lines(s, d)).select("run", "order_key", "domain")


def held_rows(s, d):
    verdicts = _verdicts(s, d).withColumn("domain", C.normalize_domain("domain", "crm"))
    return K.held_rows(lines(s, d), verdicts).select("run", "domain", "name", "account_tier", "need_strength", "qualification_reason")


def run_cost(s, d):
    out = K.run_cost(J.outcomes(s, d).withColumn("cost", F.lit(0.5)))
    return out.select("run", "calls", "cost", F.round("seconds", 6).alias("seconds"), F.round("mean_seconds", 6).alias("mean_seconds"))


def run_quantiles(s, d):
    """Durations of runs as sketches, merged by night, a seventh of the runs each: whether the quantiles they give are those of the durations, within the error."""
    runs = J.outcomes(s, d).filter("duration IS NOT NULL").withColumn("night", F.substring_index("run", "-", 1).cast("bigint") % 7)
    merged = K.merged_durations(K.duration_sketches(runs, "night", "run"), "night")
    found = K.duration_quantiles(merged, {"median": 0.5, "p95": 0.95})
    both = runs.select("night", "duration").join(found, "night")
    shares = [F.avg((F.col("duration") < F.col(c)).cast("double")).alias(f"below_{c}") for c in ("median", "p95")] + [F.avg((F.col("duration") <= F.col(c)).cast("double")).alias(f"upto_{c}") for c in ("median", "p95")]
    held = both.groupBy("night").agg(F.first("calls").alias("calls"), *shares)
    near = lambda c, p: (F.col(f"below_{c}") <= p + K.RANK_ERROR) & (F.col(f"upto_{c}") >= p - K.RANK_ERROR)
    return held.select("night", "calls", near("median", 0.5).alias("median_held"), near("p95", 0.95).alias("p95_held"))


def run_notes(s, d):
    missing = V.queue(s, d).filter("account_id IS NULL").select(F.col("batch").alias("run"))
    walked = S.walk(V.source_rows(s, d), S.seen_domains(V.seen(s, d)), V.excluded(s, d), SCOPE, V.CAP)
    found = R.name_collisions(S.clean_rows(V.source_rows(s, d)).filter("problem IS NULL"), V.registered(s, d)).select(F.col("batch").alias("run"), F.col("note").alias("text"))
    unmapped = _applied(s, d).filter("unmapped IS NOT NULL").select(F.lit("all").alias("run"), F.col("unmapped").alias("text"))
    return K.run_notes(missing, walked.filter("status = 'resurfaced'").select(F.col("batch").alias("run")), found, unmapped)


QUERIES = {f.__name__: f for f in (
    crm_matches, build_properties, bad_options, plan_actions, field_changes, merge_crm, action_counts, pushed, enrich_todo, limit_todo, industry_index, map_industry, apply_enrichment, enrich_leftover, unmapped_industries, enrich_summary, run_counts, report_rows,
    needs_review, held_rows, run_cost, run_quantiles, run_notes,
)}

CRM = """crm AS (SELECT c_custkey::VARCHAR AS id, 'c' || c_custkey % 1200 || '.example' AS host, ['', 'Not Reviewed', 'Qualified', 'Needs Review', NULL][(c_nationkey % 5 + 1)::INT] AS st, ['', 'Sourced', 'In Outreach'][(c_custkey % 3 + 1)::INT] AS stage,
    CASE WHEN c_custkey % 2 = 0 THEN 'Import' END AS src, CASE WHEN c_custkey % 3 = 0 THEN '77' ELSE '' END AS emp, CASE WHEN c_custkey % 4 = 1 THEN 'OLD' END AS ind, CASE WHEN c_custkey % 4 = 0 THEN 'https://www.' ELSE '' END || 'c' || c_custkey % 1200 || '.example' AS domain FROM customer),
    hosts AS (SELECT host, count(*) AS matches, min(id) AS id FROM crm GROUP BY 1)"""
PROPS = J.DOCS + """, r AS (SELECT 'c' || c_custkey || '.example' AS domain, c_name AS name, CASE WHEN c_acctbal > 0 THEN c_custkey * 1000 END AS h FROM customer),
    pr AS (SELECT doc_id, 'c' || doc_id || '.example' AS key, t, h, CASE WHEN q <> 'QUALIFIED' THEN 'only QUALIFIED verdicts are written' WHEN b <> 'BUYER' THEN 'QUALIFIED requires BUYER' WHEN r.domain IS NULL THEN 'domain mismatch: not in the queue' END AS reason
        FROM c LEFT JOIN r ON r.domain = 'c' || doc_id || '.example' WHERE problem IS NULL AND doc_id % 19 <> 0)"""
PLAN = PROPS + ", " + CRM + """, pl AS (SELECT pr.*, coalesce(hosts.matches, 0) AS matches, CASE WHEN hosts.matches = 1 THEN hosts.id END AS id FROM pr LEFT JOIN hosts ON pr.key = hosts.host WHERE reason IS NULL),
    ac AS (SELECT pl.*, crm.st, crm.stage, crm.src, crm.emp, CASE WHEN matches > 1 THEN 'conflict' WHEN matches = 0 THEN 'created' WHEN crm.st = 'Qualified' THEN 'exists' WHEN coalesce(crm.st, '') NOT IN ('', 'Not Reviewed') THEN 'human_verdict_exists' ELSE 'updated' END AS action
        FROM pl LEFT JOIN crm ON pl.id = crm.id)"""
PUSHED = QUEUE + ", pu AS (SELECT domain, arg_max(crm_id, (batch, order_key)) AS crm_id, min((batch, order_key)) AS place, min(struct_pack(b := batch, k := order_key)) AS p FROM v_queue WHERE crm_id IS NOT NULL AND action IN ('created', 'updated', 'exists', 'unchanged') GROUP BY 1)"
TODO = PUSHED + ", " + CRM + ", td AS (SELECT pu.domain, pu.crm_id, pu.p, CASE WHEN nullif(emp, '') IS NOT NULL AND ind IS NOT NULL THEN 'not_needed' ELSE 'todo' END AS state FROM pu LEFT JOIN crm ON crm.id = pu.crm_id WHERE pu.domain NOT IN (SELECT 'c' || c_custkey || '.example' FROM customer WHERE c_custkey % 7 = 0))"
KEY = lambda x, d: "regexp_replace(%s, '[^a-z0-9]', '', 'g')" % (f"regexp_replace(replace(replace(lower({x}), '_', ' '), '&', ' and '), '\\band\\b', ' ', 'g')" if d else f"replace(replace(lower({x}), '_', ' '), '&', ' and ')")
INDEX = "op AS (SELECT p_partkey AS k, p_type || ' & ' || p_name AS label, upper(p_type || '_' || replace(p_name, ' ', '_')) AS value FROM part), ks AS (%s), ix AS (SELECT key, arg_min(value, k * 4 + i) AS value FROM ks WHERE key <> '' GROUP BY 1)" % " UNION ALL ".join(
    f"SELECT k, {i} AS i, value, {KEY(x, w)} AS key FROM op" for i, (x, w) in enumerate((("label", 0), ("label", 1), ("value", 0), ("value", 1))))
RESULTS = f"""rs AS (SELECT o_orderkey AS k, 'c' || o_custkey || '.example' AS domain, o_orderkey % 6 <> 0 AS found, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey END AS n, CASE WHEN o_orderkey % 10 = 2 THEN 'Vertical Farming' WHEN o_orderkey % 10 <> 4 THEN 'economy AND Small Ring' END AS industry FROM orders),
    mp AS (SELECT rs.*, coalesce((SELECT value FROM ix WHERE key = {KEY("rs.industry", 0)}), (SELECT value FROM ix WHERE key = {KEY("rs.industry", 1)})) AS mapped FROM rs)"""
APPLIED = TODO + ", " + INDEX + ", " + RESULTS + """, la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY k DESC) AS n2 FROM mp) WHERE n2 = 1),
    ap AS (SELECT la.domain, la.found, CASE WHEN found AND nullif(emp, '') IS NULL AND n > 0 THEN n::VARCHAR END AS numberofemployees, CASE WHEN found AND ind IS NULL AND industry IS NOT NULL THEN mapped END AS industry,
        CASE WHEN found AND ind IS NULL AND industry IS NOT NULL AND mapped IS NULL THEN la.domain || ': ' || industry END AS unmapped FROM la JOIN pu USING (domain) LEFT JOIN crm ON crm.id = pu.crm_id WHERE la.domain NOT IN (SELECT 'c' || c_custkey || '.example' FROM customer WHERE c_custkey % 7 = 0)),
    ad AS (SELECT domain, CASE WHEN NOT found THEN 'not_found' WHEN coalesce(numberofemployees, industry) IS NOT NULL THEN 'ok' ELSE 'no_new_data' END AS status, numberofemployees, industry, unmapped FROM ap)"""
LINES = QUEUE + """, ln AS (SELECT batch AS run, order_key, domain, 'Co ' || order_key AS name, order_key % 3 = 0 AS backlog, CASE WHEN order_key % 12 = 5 THEN 'needs_review' ELSE status END AS status, verdict AS qualification, CASE WHEN order_key % 10 = 0 THEN 'dry_run' ELSE action END AS action, crm_id,
    nullif(CASE WHEN order_key % 4 = 1 THEN repeat('err|' || order_key || chr(10), order_key % 40) END, '') AS error FROM v_queue)"""
WHY = """replace(replace(CASE WHEN order_key % 11 = 0 THEN '[crawl: blocked] ' ELSE '' END || CASE WHEN order_key % 7 = 0 THEN '[scope: country=X] ' ELSE '' END || CASE WHEN order_key % 6 = 0 THEN 'lowered. ' ELSE '' END
    || CASE WHEN action = 'dry_run' AND order_key % 5 = 0 THEN '(would create) ' ELSE '' END || coalesce(error, 'reason'), '|', '/'), chr(10), ' ')"""

SQL = {
    "crm_matches": f"WITH {CRM} SELECT 'c' || c_custkey || '.example' AS domain, coalesce(matches, 0) AS matches, CASE WHEN matches = 1 THEN id END AS id FROM customer LEFT JOIN hosts ON host = 'c' || c_custkey || '.example'",
    "build_properties": f"""WITH {PROPS} SELECT doc_id, key, reason, CASE WHEN reason IS NULL THEN 'Co ' || doc_id END AS name, CASE WHEN reason IS NULL THEN 'https://' || key END AS website, CASE WHEN reason IS NULL THEN 'Tier ' || right(t, 1) END AS sourcing_account_tier,
        CASE WHEN reason IS NULL THEN 'because ' || doc_id END AS sourcing_qualification_reason, NULL::VARCHAR AS sourcing_strongest_signal, CASE WHEN reason IS NULL THEN 'http://a' END AS sourcing_evidence_links, CASE WHEN reason IS NULL AND h <> 0 THEN h::VARCHAR END AS numberofemployees FROM pr""",
    "bad_options": f"WITH {PROPS} SELECT key, 'sourcing_account_tier' AS property, 'Tier B' AS value FROM pr WHERE reason IS NULL AND t = 'TIER_B'",
    "plan_actions": f"WITH {PLAN} SELECT key, matches, CASE WHEN t = 'TIER_B' THEN 'invalid' ELSE action END AS action FROM ac",
    "field_changes": f"""WITH {PLAN}, u AS (SELECT * FROM ac WHERE action = 'updated') SELECT id, 'sourcing_qualification_status' AS property, st AS old_value, 'Qualified' AS new_value FROM u UNION ALL SELECT id, 'sourcing_p1_date', '', '2030-01-15' FROM u
        UNION ALL SELECT id, 'sourcing_account_tier', NULL, 'Tier ' || right(t, 1) FROM u UNION ALL SELECT id, 'sourcing_need_strength', NULL, 'Strong' FROM u UNION ALL SELECT id, 'sourcing_current_approach', NULL, 'Manual' FROM u
        UNION ALL SELECT id, 'sourcing_timing', NULL, 'Unknown' FROM u UNION ALL SELECT id, 'sourcing_evidence_confidence', NULL, 'High' FROM u UNION ALL SELECT id, 'sourcing_qualification_reason', NULL, 'because ' || doc_id FROM u
        UNION ALL SELECT id, 'sourcing_main_uncertainty', NULL, 'none' FROM u UNION ALL SELECT id, 'sourcing_roles_to_contact', NULL, 'CEO' FROM u UNION ALL SELECT id, 'sourcing_evidence_links', NULL, 'http://a' FROM u
        UNION ALL SELECT id, 'sourcing_account_stage', stage, 'Qualified' FROM u WHERE stage IN ('', 'Sourced') UNION ALL SELECT id, 'sourcing_sourced_from', src, 'Apollo' FROM u WHERE src IS NULL UNION ALL SELECT id, 'numberofemployees', emp, h::VARCHAR FROM u WHERE emp = '' AND h <> 0""",
    "merge_crm": f"""WITH {PLAN}, n AS (SELECT crm.*, u.key IS NOT NULL AS up, u.h AS nh FROM crm LEFT JOIN (SELECT * FROM ac WHERE action = 'updated') u ON u.id = crm.id)
        SELECT domain, CASE WHEN up THEN 'Qualified' ELSE st END AS sourcing_qualification_status, CASE WHEN up AND stage IN ('', 'Sourced') THEN 'Qualified' ELSE stage END AS sourcing_account_stage, CASE WHEN up AND src IS NULL THEN 'Apollo' ELSE src END AS sourcing_sourced_from,
            CASE WHEN up AND emp = '' AND nh <> 0 THEN nh::VARCHAR ELSE emp END AS numberofemployees FROM n
        UNION ALL SELECT key, 'Qualified', 'Qualified', 'Apollo', CASE WHEN h <> 0 THEN h::VARCHAR END FROM ac WHERE action = 'created'""",
    "action_counts": f"WITH {PLAN} SELECT action, count(*) AS n, action IN ('conflict', 'invalid', 'human_verdict_exists') AS needs_review FROM ac GROUP BY 1",
    "pushed": f"WITH {PUSHED} SELECT domain, crm_id, p.b AS batch, p.k AS order_key FROM pu",
    "enrich_todo": f"WITH {TODO} SELECT domain, crm_id, state FROM td",
    "limit_todo": f"WITH {TODO} SELECT domain, CASE WHEN row_number() OVER (ORDER BY p, domain) <= 10 THEN 'todo' ELSE 'waiting' END AS state FROM td WHERE state = 'todo'",
    "industry_index": f"WITH {INDEX} SELECT key, value FROM ix",
    "map_industry": f"WITH {INDEX}, {RESULTS} SELECT k AS order_key, industry, mapped FROM mp",
    "apply_enrichment": f"WITH {APPLIED} SELECT * FROM ad",
    "enrich_leftover": f"WITH {APPLIED} SELECT k AS order_key, domain FROM rs WHERE domain IN (SELECT domain FROM pu) AND domain NOT IN (SELECT domain FROM ad WHERE status = 'ok')",
    "unmapped_industries": f"WITH {APPLIED} SELECT domain, unmapped AS text FROM ad WHERE unmapped IS NOT NULL",
    "enrich_summary": f"WITH {APPLIED} SELECT count(*) FILTER (status = 'ok') AS enriched, count(*) FILTER (status = 'not_found') AS not_found, count(*) FILTER (status = 'no_new_data') AS no_new_data, count(unmapped) AS unmapped FROM ad",
    "run_counts": f"""WITH {LINES}, q AS (SELECT batch AS run, count(*) FILTER (status <> 'skipped_prefilter') AS pulled, count(*) FILTER (status = 'skipped_prefilter') AS prefiltered, count(*) FILTER (status = 'pending') AS pending_left FROM v_queue GROUP BY 1),
        l AS (SELECT run, count(*) FILTER (backlog) AS backlog, count(*) AS processed, count(*) FILTER (qualification = 'QUALIFIED') AS qualified, count(*) FILTER (qualification <> 'QUALIFIED') AS not_qualified, count(*) FILTER (status IN ('error', 'hubspot_error')) AS errors,
            count(*) FILTER (action = 'created') AS crm_created, count(*) FILTER (action = 'updated') AS crm_updated, count(*) FILTER (action IN ('exists', 'unchanged')) AS crm_skipped, count(*) FILTER (status = 'needs_review') AS needs_review, count(*) FILTER (action = 'held') AS held FROM ln GROUP BY 1)
        SELECT * FROM q JOIN l USING (run)""",
    "report_rows": f"WITH {LINES}, w AS (SELECT *, {WHY} AS y FROM ln) SELECT run, order_key, CASE WHEN length(y) > 220 THEN left(y, 217) || '...' ELSE y END AS why, CASE WHEN crm_id IS NOT NULL THEN 'https://app-na2.hubspot.com/contacts/123/record/0-2/' || crm_id ELSE '' END AS link FROM w",
    "needs_review": f"WITH {LINES} SELECT run, order_key, domain FROM ln WHERE status = 'needs_review'",
    "held_rows": f"WITH {LINES}, {J.DOCS} SELECT run, domain, name, t AS account_tier, 'STRONG' AS need_strength, 'because ' || doc_id AS qualification_reason FROM ln JOIN c ON domain = 'c' || doc_id || '.example' WHERE action = 'held' AND problem IS NULL AND doc_id % 19 <> 0",
    "run_quantiles": f"WITH {J.OUT} SELECT split_part(run, '-', 1)::BIGINT % 7 AS night, count(*) AS calls, true AS median_held, true AS p95_held FROM o WHERE dur IS NOT NULL GROUP BY 1",
    "run_cost": f"WITH {J.OUT} SELECT run, count(*) AS calls, count(*) * 0.5::DOUBLE AS cost, round(sum(dur), 6) AS seconds, round(avg(dur), 6) AS mean_seconds FROM o GROUP BY 1",
    "run_notes": f"""WITH {WALK}, {MATCHED}, {APPLIED}
        SELECT batch AS run, 'missing_ids' AS kind, count(*) || ' without an account id' AS text FROM v_queue WHERE account_id IS NULL GROUP BY 1
        UNION ALL SELECT batch, 'resurfaced', count(*) || ' seen before' FROM v_walk WHERE status = 'resurfaced' GROUP BY 1
        UNION ALL SELECT batch, 'name_collision', 'dedupe_name_collision: ' || domain || ' vs ' || other FROM (SELECT v.batch, v.domain, v.order_key, arg_min(r.domain, r.reg_order) AS other FROM v_id v JOIN v_reg r ON coalesce(r.name, '') = coalesce(lower(v.name), '') AND r.domain <> v.domain WHERE v.domain IS NOT NULL AND v.matched_id IS NULL GROUP BY 1, 2, 3)
        UNION ALL SELECT 'all', 'unmapped_industry', unmapped FROM ad WHERE unmapped IS NOT NULL""",
}
