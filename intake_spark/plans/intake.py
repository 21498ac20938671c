"""Queries for sources, cleaning, selection and registration."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import register as R
from ..operators import selection as S
from ..sources import tables
from . import views as V
from .views import CAP, CLEAN, EXCLUDED, QUEUE, REGISTERED, ROWS, SCOPE, SEEN, table

PROPS = T.StructType([T.StructField("k", T.LongType())])


def scratch(spark) -> str:
    """A new folder for written tables."""
    return tables.new_path(spark, "intake")


def clean(s, d):
    return S.clean_rows(V.source_rows(s, d))


def valid(s, d):
    return clean(s, d).filter("problem IS NULL")


def broken_lines(s, d):
    """props of events as lines, some of them broken, an array, or blank."""
    return table(s, d, "events").selectExpr("event_id", "CASE WHEN event_id % 50 = 7 THEN concat(props, '}') WHEN event_id % 50 = 8 THEN concat('[', props, ']') WHEN event_id % 50 = 9 THEN '  ' ELSE props END AS value")


def read_jsonl_quarantine(s, d):
    return tables.parse_jsonl(broken_lines(s, d), PROPS).select("event_id", "bad", F.col("row.k").alias("k"))


def page_order(s, d):
    """events written as JSON lines in page files, and read back in page order: the place of each line."""
    path = scratch(s)
    events = table(s, d, "events").selectExpr("coalesce(concat('page-', event_id DIV 1000 + 1), 'none') AS page", "event_id", "to_json(named_struct('event_id', event_id)) AS value")
    # Sorted by the column that the writer parts by, which has no nulls: else the writer sorts anew, and the order within a page is lost.
    events.repartition("page").sortWithinPartitions("page", "event_id").select("page", "value").write.partitionBy("page").text(path)
    rows = tables.read_pages(s, path, T.StructType([T.StructField("event_id", T.LongType())]))
    ends = [F.min_by("event_id", "order_key").alias("first_event"), F.max_by("event_id", "order_key").alias("last_event")]
    return rows.groupBy("page_no").agg(F.count("*").alias("lines"), *ends)


def write_once(s, d):
    path, rows = scratch(s), V.queue(s, d).select("batch", "order_key", "status")
    tables.write_batch_once(rows.filter("batch < '1997-01-01'"), path)
    tables.write_batch_once(rows.withColumn("status", F.lit("again")), path)
    return s.read.parquet(path).groupBy(F.col("batch").cast("string").alias("batch"), "status").agg(F.count("*").alias("n"))


def rewrite_batches(s, d):
    path, rows = scratch(s), V.queue(s, d).select("batch", "order_key", "status")
    rows.write.partitionBy("batch").parquet(path)
    tables.rewrite_batches(rows.filter("batch >= '1998-01-01'").withColumn("status", F.lit("new")), path)
    return s.read.parquet(path).groupBy(F.col("batch").cast("string").alias("batch"), "status").agg(F.count("*").alias("n"))


def append_ledger(s, d):
    path, rows = scratch(s), V.queue(s, d).withColumn("result", R.result_value()).filter("account_id IS NOT NULL AND result IS NOT NULL").select("account_id", "result")
    tables.append_ledger(rows.filter("result = 'Error'"), path, ["account_id", "result"])
    tables.append_ledger(rows, path, ["account_id", "result"])
    return s.read.parquet(path).select("account_id", "result")


def batch_ids(s, d):
    arrivals = table(s, d, "orders").selectExpr("date_format(o_orderdate, 'yyyy-MM-dd') AS day", "o_orderkey AS order_key")
    used = table(s, d, "orders").filter("o_orderkey % 3 = 0").selectExpr("concat(date_format(o_orderdate, 'yyyy-MM-dd'), element_at(array('', 'b', 'd'), CAST(o_orderkey DIV 3 % 3 + 1 AS INT))) AS batch")
    return tables.assign_batch_ids(arrivals, used).select("order_key", "day", "batch")


def latest_batch(s, d):
    odd = table(s, d, "orders").selectExpr("concat(date_format(o_orderdate, 'yyyy-MM-dd'), element_at(array('', 'b', 'e', 'A', '-x'), CAST(o_orderkey % 5 + 1 AS INT))) AS batch")
    return tables.latest_batch(odd, "1993-01-01")


def credits_used(s, d):
    return tables.credits_used(V.source_rows(s, d).select("batch", F.when(F.col("order_key") % 4 == 0, 0).otherwise(F.length("domain")).alias("length")))


def orphan_batches(s, d):
    return tables.orphan_batches(V.source_rows(s, d), V.source_rows(s, d).filter("order_key DIV 100 % 3 = 1"), "2031-01-01")


def clean_rows(s, d):
    lists = [F.array_join(c, "|").alias(c) for c in ("tech", "job_titles")]
    return S.clean_rows(V.listed_rows(s, d)).select("batch", "order_key", "domain", "name", "org_id", "account_id", "industry", "headcount", "country", F.col("funding.total").alias("funding_total"), *lists)


def row_problems(s, d):
    return clean(s, d).filter("problem IS NOT NULL").select("batch", "order_key", "problem")


def keyword_excluded(s, d):
    rows = V.source_rows(s, d)
    return rows.filter(S.keyword_excluded(rows, ["WHOLE", "fr"])).select("order_key", "keywords", "industry")


def seen_domains(s, d):
    return S.seen_domains(V.source_rows(s, d), "2030-01-02")


def first_seen(s, d):
    return S.first_seen(valid(s, d)).select("batch", "order_key", "domain", "name")


def net_new(s, d):
    new, again = S.net_new(S.first_seen(valid(s, d)), S.seen_domains(V.seen(s, d)))
    return new.withColumn("state", F.lit("new")).unionByName(again.withColumn("state", F.lit("resurfaced"))).select("batch", "order_key", "domain", "state")


def flag_excluded(s, d):
    return S.flag_excluded(valid(s, d), V.excluded(s, d)).select("order_key", "excluded")


def prefilter(s, d):
    return valid(s, d).select("order_key", "name", S.prefilter(SCOPE).alias("reason"))


def scope_warnings(s, d):
    return valid(s, d).select("order_key", F.array_join(S.scope_warnings(SCOPE), "; ").alias("warnings"))


def cap_pending(s, d):
    return S.cap_pending(V.queue(s, d), 25).select("batch", "order_key", "status")


def _walk(s, d):
    return S.walk(V.source_rows(s, d), S.seen_domains(V.seen(s, d)), V.excluded(s, d), SCOPE, CAP)


def select_candidates(s, d):
    out = S.select_candidates(V.source_rows(s, d), S.seen_domains(V.seen(s, d)), V.excluded(s, d), SCOPE, CAP)
    return out.select("batch", "order_key", "domain", "name", "org_id", "status", "skip_reason", F.array_join("scope_warnings", "; ").alias("scope_warnings"), "source_rank")


def candidate_signals(s, d):
    """What the search has matched on, on each candidate."""
    out = S.select_candidates(V.source_rows(s, d), S.seen_domains(V.seen(s, d)), V.excluded(s, d), SCOPE, CAP, V.FILTERS)
    pairs = F.transform(F.array_sort(F.map_entries("search_signals")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return out.select("batch", "order_key", F.array_join(pairs, "; ").alias("signals"))


def selection_summary(s, d):
    return S.selection_summary(_walk(s, d), V.source_rows(s, d), CAP)


def skip_counts(s, d):
    return S.skip_counts(_walk(s, d))


def import_accounts(s, d):
    rows = V.source_rows(s, d).drop("org_id")
    return S.import_accounts(rows, S.seen_domains(V.seen(s, d)), SCOPE, ["wholesale"]).select("batch", "order_key", "domain", "status", "skip_reason")


def _export(s, d):
    """source rows as an accounts export, written as CSV in several files and read back."""
    path = scratch(s)
    columns = {"Company Name": "name", "Website": "domain", "Industry": "industry", "# Employees": "headcount", "Company Country": "country", "Keywords": "keywords", "Apollo Account Id": "account_id", "Parent company (Apollo data)": "parent_company"}
    rows = V.source_rows(s, d).repartitionByRange(4, "order_key").sortWithinPartitions("order_key")
    rows.select([F.col(c).alias(name) for name, c in columns.items()]).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return tables.read_accounts_csv(s, path, "2030-01-15")


def import_csv(s, d):
    """An accounts export, read, tagged, selected and built into a queue."""
    picked = S.import_accounts(_export(s, d), S.seen_domains(V.seen(s, d)), SCOPE, ["wholesale"])
    built = R.build_queue(picked, V.registered(s, d), "csv:accounts")
    return built.select("batch", "source_rank", "domain", "status", "skip_reason", "list_name")


def import_counts(s, d):
    rows = _export(s, d)
    return S.import_counts(S.walk_accounts(rows, S.seen_domains(V.seen(s, d)), SCOPE, ["wholesale"]), rows)


def match_registered(s, d):
    return R.match_registered(valid(s, d), V.registered(s, d)).select("order_key", "domain", "matched_id")


def name_collisions(s, d):
    return R.name_collisions(valid(s, d), V.registered(s, d)).select("batch", "domain", "note")


def build_queue(s, d):
    return R.build_queue(valid(s, d), V.registered(s, d)).select("batch", "order_key", "domain", "account_id", "list_name")


def build_summary(s, d):
    return R.build_summary(V.queue(s, d))


def result_value(s, d):
    return V.queue(s, d).select("order_key", "status", "verdict", R.result_value().alias("result"))


def _ledger(s, d):
    return V.queue(s, d).filter("order_key % 2 = 0").select("account_id", R.result_value().alias("result"))


def unregistered(s, d):
    return R.unregistered(V.queue(s, d), _ledger(s, d)).select("batch", "order_key", "account_id", "result")


def unregistered_batches(s, d):
    return R.unregistered_batches(V.queue(s, d), _ledger(s, d), "1997-06-01")


def mark_registered(s, d):
    ids = table(s, d, "customer").filter("c_custkey % 2 = 0").selectExpr("concat('acc', c_custkey) AS account_id")
    todo = R.unregistered(V.queue(s, d), _ledger(s, d)).select("account_id", "result").distinct()
    return R.mark_registered(todo, ids)


def prioritize(s, d):
    wanted = table(s, d, "customer").filter("c_acctbal < 0").selectExpr("CASE WHEN c_custkey % 2 = 0 THEN concat(' acc', c_custkey) END AS account_id", "CASE WHEN c_custkey % 2 = 1 THEN concat('https://www.C', c_custkey, '.example/x') END AS website")
    return R.prioritize(V.queue(s, d), wanted, "front.csv").select("batch", "order_key", "hit", "priority", "position")


QUERIES = {f.__name__: f for f in (
    read_jsonl_quarantine, page_order, write_once, rewrite_batches, append_ledger, batch_ids, latest_batch, credits_used, orphan_batches, clean_rows, row_problems, keyword_excluded, seen_domains, first_seen, net_new, flag_excluded,
    prefilter, scope_warnings, cap_pending, select_candidates, candidate_signals, selection_summary, skip_counts, import_accounts, import_csv, import_counts, match_registered, name_collisions, build_queue, build_summary, result_value, unregistered, unregistered_batches,
    mark_registered, prioritize,
)}

FIRST = CLEAN + """, v_valid AS (SELECT * FROM v_clean WHERE problem IS NULL), v_key AS (SELECT *, coalesce(domain, 'name:' || coalesce(lower(name), '')) AS key FROM v_valid),
    v_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch, key ORDER BY order_key) AS n FROM v_key) WHERE n = 1 AND key <> 'name:')"""
REASON = "CASE WHEN regexp_matches(name, '(?i)tion ther|schaft|quele') THEN 'name_match' WHEN regexp_matches(industry, '(?i)^es$') THEN 'industry_match' WHEN parent_company <> '' THEN 'subsidiary' END"
COUNTRY = "CASE WHEN lower(country) IN ('us', 'usa') THEN 'united states' WHEN lower(country) = 'ca' THEN 'canada' WHEN lower(country) = 'u.k.' THEN 'united kingdom' ELSE coalesce(lower(country), '') END"
WARNINGS = f"concat_ws('; ', CASE WHEN {COUNTRY} NOT IN ('', 'united states', 'canada') THEN 'country=' || country END, CASE WHEN headcount < 1000 OR headcount > 9000 THEN 'headcount=' || headcount END)"
WALK = FIRST + f""", {SEEN}, {EXCLUDED}, v_all AS (
    SELECT *, NULL AS why, 'invalid' AS status FROM (SELECT * EXCLUDE (problem) FROM v_clean WHERE problem IS NOT NULL)
    UNION ALL SELECT * EXCLUDE (problem, key, n, why), why, CASE WHEN domain IN (SELECT domain FROM v_seen) THEN 'resurfaced' WHEN why IS NULL THEN 'pending' ELSE 'skipped_prefilter' END AS status
    FROM (SELECT *, CASE WHEN domain IS NULL THEN 'no_domain' WHEN org_id IN (SELECT org_id FROM v_excluded WHERE org_id IS NOT NULL) OR domain IN (SELECT domain FROM v_excluded WHERE domain IS NOT NULL) THEN 'excluded_keyword_tag' ELSE {REASON} END AS why FROM v_first)),
    v_walk AS (SELECT *, CASE WHEN status = 'skipped_prefilter' THEN why END AS skip_reason FROM (SELECT *, coalesce(sum((status = 'pending')::INT) OVER (PARTITION BY batch ORDER BY order_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM v_all) WHERE before < 40)"""
RESULT = "CASE WHEN status = 'skipped_prefilter' THEN 'Prefiltered' WHEN status = 'error' THEN 'Error' WHEN status IN ('done', 'hubspot_error', 'needs_review') THEN CASE verdict WHEN 'QUALIFIED' THEN 'Qualified' WHEN 'MAYBE' THEN 'Maybe' WHEN 'NOT_QUALIFIED' THEN 'Not Qualified' ELSE 'Error' END END"
TODO = QUEUE + f""", v_res AS (SELECT *, {RESULT} AS result FROM v_queue), v_todo AS (SELECT * FROM v_res r WHERE account_id IS NOT NULL AND result IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM v_res l WHERE l.order_key % 2 = 0 AND l.account_id = r.account_id AND l.result = r.result))"""
MATCHED = f"""{REGISTERED}, v_match AS (SELECT v.*, (SELECT count(*) FROM v_reg r WHERE r.organization_id = v.org_id) AS h1, (SELECT arg_min(struct_pack(a := account_id), reg_order) FROM v_reg r WHERE r.organization_id = v.org_id).a AS m1,
    (SELECT count(*) FROM v_reg r WHERE r.domain = v.domain) AS h2, (SELECT arg_min(struct_pack(a := account_id), reg_order) FROM v_reg r WHERE r.domain = v.domain).a AS m2,
    (SELECT arg_min(struct_pack(a := account_id), reg_order) FROM v_reg r WHERE r.name = lower(v.name) AND (v.domain IS NULL OR r.domain IS NULL)).a AS m3 FROM v_valid v),
    v_id AS (SELECT *, CASE WHEN account_id IS NOT NULL THEN account_id WHEN h1 > 0 THEN m1 WHEN h2 > 0 THEN m2 ELSE m3 END AS matched_id FROM v_match)"""
MATCH = f"{FIRST}, {MATCHED}"
IMPORT = f"""{ROWS}, {SEEN}, r AS (SELECT *, {V.sql_domain('domain')} AS dom, nullif(trim(name), '') AS nm FROM v_rows),
    p AS (SELECT *, account_id IS NOT NULL AND NOT regexp_matches(account_id, '^[a-f0-9]{{24}}$') OR domain IS NOT NULL AND dom IS NULL OR coalesce(nm, domain) IS NULL AS bad, coalesce(dom, 'name:' || coalesce(lower(nm), '')) AS key FROM r),
    f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY order_key) AS n FROM p WHERE NOT bad) WHERE n = 1 AND key <> 'name:'),
    t AS (SELECT DISTINCT dom FROM r WHERE contains(lower(concat_ws(', ', keywords, industry)), 'wholesale') AND dom IS NOT NULL),
    w AS (SELECT *, coalesce(dom IN (SELECT domain FROM v_seen), false) AS again, CASE WHEN dom IS NULL THEN 'no_domain' WHEN dom IN (SELECT dom FROM t) THEN 'excluded_keyword_tag' ELSE {REASON} END AS why FROM f)"""

SQL = {
    "read_jsonl_quarantine": "SELECT event_id, event_id % 50 IN (7, 8) AS bad, CASE WHEN event_id % 50 NOT IN (7, 8) THEN json_extract_string(props, '$.k')::BIGINT END AS k FROM events WHERE event_id % 50 <> 9",
    "page_order": "SELECT (event_id // 1000 + 1)::INT AS page_no, count(*) AS lines, min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY 1",
    "write_once": f"WITH {QUEUE} SELECT batch, CASE WHEN batch < '1997-01-01' THEN status ELSE 'again' END AS status, count(*) AS n FROM v_queue GROUP BY 1, 2",
    "rewrite_batches": f"WITH {QUEUE} SELECT batch, CASE WHEN batch < '1998-01-01' THEN status ELSE 'new' END AS status, count(*) AS n FROM v_queue GROUP BY 1, 2",
    "append_ledger": f"WITH {QUEUE} SELECT DISTINCT account_id, {RESULT} AS result FROM v_queue WHERE account_id IS NOT NULL AND {RESULT} IS NOT NULL",
    "batch_ids": """WITH a AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey AS order_key, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS n FROM orders),
        u AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') || ['', 'b', 'd'][(o_orderkey // 3 % 3 + 1)::INT] AS batch FROM orders WHERE o_orderkey % 3 = 0),
        f AS (SELECT day, batch, row_number() OVER (PARTITION BY day ORDER BY batch) AS n FROM (SELECT DISTINCT day, day || CASE WHEN i = 0 THEN '' ELSE chr((97 + i)::INT) END AS batch FROM a, range(26) t(i)) WHERE batch NOT IN (SELECT batch FROM u))
        SELECT a.order_key, a.day, f.batch FROM a LEFT JOIN f USING (day, n)""",
    "latest_batch": "SELECT greatest(max(b), '1993-01-01') AS batch FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') || ['', 'b', 'e', 'A', '-x'][(o_orderkey % 5 + 1)::INT] AS b FROM orders) WHERE regexp_matches(b, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[b-z]?$')",
    "credits_used": f"WITH {ROWS} SELECT batch, count(*) AS credits FROM v_rows WHERE order_key % 4 <> 0 AND length(domain) > 0 GROUP BY 1",
    "orphan_batches": f"WITH {ROWS} SELECT DISTINCT batch FROM v_rows WHERE batch < '2031-01-01' AND batch NOT IN (SELECT batch FROM v_rows WHERE order_key // 100 % 3 = 1)",
    "clean_rows": f"""WITH {CLEAN}, l AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN ['erp', NULL, '', regexp_extract(html, 'lang="([a-z]+)"', 1)] WHEN 1 THEN ['', NULL] WHEN 2 THEN [] WHEN 3 THEN ['crm'] END AS t,
            CASE WHEN page_id % 3 <> 0 THEN [r.name, '', r.country] END AS j FROM pages JOIN v_rows r ON r.order_key = page_id)
        SELECT batch, order_key, domain, name, org_id, account_id, industry, headcount, country, funding_total, nullif(array_to_string(list_filter(t, lambda x: x <> ''), '|'), '') AS tech, nullif(array_to_string(list_filter(j, lambda x: x <> ''), '|'), '') AS job_titles
        FROM v_clean JOIN l ON page_id = order_key""",
    "row_problems": f"WITH {CLEAN} SELECT batch, order_key, problem FROM v_clean WHERE problem IS NOT NULL",
    "keyword_excluded": f"WITH {ROWS} SELECT order_key, keywords, industry FROM v_rows WHERE contains(lower(concat_ws(', ', keywords, industry)), 'whole') OR contains(lower(concat_ws(', ', keywords, industry)), 'fr')",
    "seen_domains": f"WITH {ROWS} SELECT DISTINCT dom AS domain FROM (SELECT {V.sql_domain('domain')} AS dom FROM v_rows WHERE batch <> '2030-01-02') WHERE dom IS NOT NULL",
    "first_seen": f"WITH {FIRST} SELECT batch, order_key, domain, name FROM v_first",
    "net_new": f"WITH {FIRST}, {SEEN} SELECT batch, order_key, domain, CASE WHEN domain IN (SELECT domain FROM v_seen) THEN 'resurfaced' ELSE 'new' END AS state FROM v_first",
    "flag_excluded": f"WITH {FIRST}, {EXCLUDED} SELECT order_key, org_id IN (SELECT org_id FROM v_excluded WHERE org_id IS NOT NULL) OR coalesce(domain IN (SELECT domain FROM v_excluded WHERE domain IS NOT NULL), false) AS excluded FROM v_valid",
    "prefilter": f"WITH {FIRST} SELECT order_key, name, {REASON} AS reason FROM v_valid",
    "scope_warnings": f"WITH {FIRST} SELECT order_key, {WARNINGS} AS warnings FROM v_valid",
    "cap_pending": f"WITH {QUEUE} SELECT batch, order_key, status FROM (SELECT *, coalesce(sum((status = 'pending')::INT) OVER (PARTITION BY batch ORDER BY order_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM v_queue) WHERE b < 25",
    "select_candidates": f"WITH {WALK} SELECT batch, order_key, domain, name, org_id, status, skip_reason, {WARNINGS} AS scope_warnings, row_number() OVER (PARTITION BY batch ORDER BY order_key) AS source_rank FROM v_walk WHERE status IN ('pending', 'skipped_prefilter')",
    "selection_summary": f"""WITH {WALK}, n AS (SELECT batch, count(*) AS rows FROM v_rows GROUP BY 1), c AS (SELECT batch, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'skipped_prefilter') AS prefiltered,
        count(*) FILTER (status = 'resurfaced') AS resurfaced, count(*) FILTER (status = 'invalid') AS invalid, count(*) FILTER (skip_reason = 'excluded_keyword_tag') AS excluded FROM v_walk GROUP BY 1) SELECT *, pending < 40 AS need_more FROM n JOIN c USING (batch)""",
    "skip_counts": f"WITH {WALK} SELECT skip_reason, count(*) AS n FROM v_walk WHERE skip_reason IS NOT NULL GROUP BY 1",
    "import_accounts": f"""WITH {ROWS}, {SEEN}, r AS (SELECT *, {V.sql_domain('domain')} AS dom, nullif(trim(name), '') AS nm FROM v_rows),
        ok AS (SELECT *, coalesce(dom, 'name:' || coalesce(lower(nm), '')) AS key FROM r WHERE (account_id IS NULL OR regexp_matches(account_id, '^[a-f0-9]{{24}}$')) AND NOT (domain IS NOT NULL AND dom IS NULL) AND coalesce(nm, domain) IS NOT NULL),
        f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch, key ORDER BY order_key) AS n FROM ok) WHERE n = 1 AND key <> 'name:' AND coalesce(dom NOT IN (SELECT domain FROM v_seen), true)),
        t AS (SELECT DISTINCT dom FROM r WHERE contains(lower(concat_ws(', ', keywords, industry)), 'wholesale') AND dom IS NOT NULL),
        w AS (SELECT *, CASE WHEN dom IS NULL THEN 'no_domain' WHEN dom IN (SELECT dom FROM t) THEN 'excluded_keyword_tag' ELSE {REASON} END AS why FROM f)
        SELECT batch, order_key, dom AS domain, CASE WHEN why IS NULL THEN 'pending' ELSE 'skipped_prefilter' END AS status, why AS skip_reason FROM w""",
    "import_csv": f"""WITH {IMPORT} SELECT '2030-01-15' AS batch, row_number() OVER (ORDER BY order_key) AS source_rank, dom AS domain, CASE WHEN why IS NULL THEN 'pending' ELSE 'skipped_prefilter' END AS status, why AS skip_reason, 'csv:accounts' AS list_name FROM w WHERE NOT again""",
    "import_counts": f"""WITH {IMPORT}, x AS (SELECT 'rows' AS what FROM r UNION ALL SELECT 'invalid' FROM p WHERE bad UNION ALL SELECT CASE WHEN again THEN 'already_queued' WHEN why IS NULL THEN 'to_qualify' ELSE 'skipped: ' || why END FROM w)
        SELECT '2030-01-15' AS batch, what, count(*) AS n FROM x GROUP BY what""",
    "candidate_signals": f"""WITH {WALK} SELECT batch, order_key, 'job_posted_since=30_days_ago; naics=4451, 4452; technologies_any=crm, erp' AS signals FROM v_walk WHERE status IN ('pending', 'skipped_prefilter')""",
    "match_registered": f"WITH {MATCH} SELECT order_key, domain, matched_id FROM v_id",
    "name_collisions": f"""WITH {MATCH} SELECT batch, domain, 'dedupe_name_collision: ' || domain || ' vs ' || other AS note FROM (SELECT v.batch, v.domain, v.order_key, arg_min(r.domain, r.reg_order) AS other FROM v_id v JOIN v_reg r
        ON coalesce(r.name, '') = coalesce(lower(v.name), '') AND r.domain <> v.domain WHERE v.domain IS NOT NULL AND v.matched_id IS NULL GROUP BY 1, 2, 3)""",
    "build_queue": f"WITH {MATCH} SELECT batch, order_key, domain, matched_id AS account_id, 'sourced-' || batch AS list_name FROM v_id",
    "build_summary": f"WITH {QUEUE} SELECT batch, count(*) AS lines, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'skipped_prefilter') AS prefiltered, count(*) FILTER (account_id IS NULL) AS missing_ids FROM v_queue GROUP BY 1",
    "result_value": f"WITH {QUEUE} SELECT order_key, status, verdict, {RESULT} AS result FROM v_queue",
    "unregistered": f"WITH {TODO} SELECT batch, order_key, account_id, result FROM v_todo",
    "unregistered_batches": f"WITH {TODO} SELECT DISTINCT batch FROM v_todo WHERE batch <= '1997-06-01'",
    "mark_registered": f"WITH {TODO}, t AS (SELECT DISTINCT account_id, result FROM v_todo), i AS (SELECT 'acc' || c_custkey AS account_id, true AS given FROM customer WHERE c_custkey % 2 = 0) SELECT account_id, result, CASE WHEN result IS NULL THEN 'unknown' WHEN given THEN 'registered' ELSE 'remaining' END AS state FROM t FULL JOIN i USING (account_id)",
    "prioritize": f"""WITH {QUEUE}, h AS (SELECT *, coalesce(account_id IN (SELECT 'acc' || c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey % 2 = 0), false) OR domain IN (SELECT 'c' || c_custkey || '.example' FROM customer WHERE c_acctbal < 0 AND c_custkey % 2 = 1) AS hit FROM v_queue)
        SELECT batch, order_key, hit, CASE WHEN hit AND status = 'pending' THEN 'front.csv' END AS priority, row_number() OVER (PARTITION BY batch ORDER BY CASE WHEN hit AND status = 'pending' THEN 0 ELSE 1 END, order_key) AS position FROM h""",
}
