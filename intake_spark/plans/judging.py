"""Queries for saved searches, runs and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import runs as N
from ..operators import searches as E
from ..operators import verdicts as G
from ..sources.tables import staged
from . import views as V
from .views import QUEUE, table

LIMITS = N.Limits(cap=60, seconds=5000.0, errors=3, transients=2)


#: A parameter that the address has besides those that all have, by the search's number; and whether its values are a list, a range or one value.
MORE = {
    **dict.fromkeys(("organizationNotLocations", "currentlyUsingAnyOfTechnologyUids", "qOrganizationJobTitles", "organizationJobLocations", "qOrganizationKeywordTags", "notOrganizationNaicsCodes", "organizationSicCodes", "notOrganizationSicCodes", "marketSegments", "qOrganizationDomainsList", "organizationIds"), "list"),
    **dict.fromkeys(("organizationFoundedYearRange", "organizationNumJobsRange", "organizationHeadcountGrowthRange"), "number"), "organizationJobPostedAtRange": "date", "latestFundingDetectedAtRange": "text", "qOrganizationName": "one", "organizationHeadcountGrowthPastNMonths": "whole",
}
MORE_VALUES = {
    "list": lambda p: f"{p}[]=v+', p_size, '&{p}[]=v+', p_size, '&{p}[]=&{p}[]=w%252Fx", "number": lambda p: f"{p}[min]=$1%2C', p_size, '000.9&{p}[max]=1e30", "date": lambda p: f"{p}[min]=today&{p}[max]=99999999_years_ago",
    "text": lambda p: f"{p}[min]=x&{p}[max]=2%2C000", "one": lambda p: f"{p}=a%20b&{p}=last', p_size, '", "whole": lambda p: f"{p}=', p_size, '.7",
}
MORE_URL = "element_at(array(%s), CAST(p_partkey %% %d + 1 AS INT))" % (", ".join(f"concat('&{MORE_VALUES[kind](p)}')" for p, kind in MORE.items()), len(MORE))
OTHER_URL = "element_at(array(%s), CAST(p_partkey %% %d + 1 AS INT))" % (", ".join(f"'&{p}=z'" for p in (*E.UNTRANSLATED, *E.SCREEN_ONLY)), len(E.UNTRANSLATED) + len(E.SCREEN_ONLY))


def urls(s, d):
    """Every part as a search address; each parameter that there is occurs in some.

    A part is some bytes and its address over a score of parameters, so parts, which may be one split of a file, are dealt out first: by the key that searches are grouped by.
    """
    return table(s, d, "part").repartition("p_partkey").selectExpr(
        "p_partkey AS search_id",
        "concat(CASE WHEN p_partkey % 7 = 0 THEN '\"' ELSE '' END, 'https://app.example/#/', element_at(array('companies', 'people', 'accounts'), CAST(p_partkey % 3 + 1 AS INT)), '?page=1&organizationLocations[]=', replace(p_name, ' ', '%2520'),"
        " '&organizationLocations[]=Chile&organizationLocations[]=Chile&organizationNumEmployeesRanges[]=', p_size, '%2C99', '&revenueRange[min]=$', p_size, ',000.9&revenueRange[max]=', CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'many' END,"
        " '&totalFundingMin=', p_size * 10, '&latestFundingDateRange[min]=', p_size, '_days_ago', CASE WHEN p_partkey % 5 = 0 THEN '&accountLabelIds[]=l1' ELSE '&organizationNaicsCodes[]=4451' END,"
        " '&prospectedByCurrentTeam[]=', CASE WHEN p_partkey % 2 = 0 THEN 'no' ELSE 'yes' END, CASE WHEN p_partkey % 6 = 0 THEN '&qKeywords=a+b&totalFundingRange=5&oddOne=1' ELSE '' END, '&totalFundingMax=1%2C000&latestFundingAmountMin=$5&latestFundingAmountMax=inf', " + MORE_URL + ", " + OTHER_URL + ", CASE WHEN p_partkey % 7 = 0 THEN '\"' ELSE '' END) AS url",
        "p_brand", "p_type", "p_size", "p_retailprice",
    )


def _items(column):
    return F.array_join(column, "|")


def search_params(s, d):
    return E.search_params(urls(s, d)).select("search_id", "filter", _items("items").alias("items"), "low", "high", "scalar")


def search_mode(s, d):
    return E.search_mode(urls(s, d))


def unmapped_params(s, d):
    return E.unmapped_params(urls(s, d)).select("search_id", "param", "value", "reason")


def resolve_dates(s, d):
    out = E.resolve_dates(E.search_params(urls(s, d)), F.lit("2030-01-15b")).filter("filter IN ('latest_funding_date_range', 'organization_job_posted_at_range', 'latest_funding_detected_at_range')")
    return out.select("search_id", "filter", "low", "high")


def _searches(u, params):
    return E.search_mode(u, params).withColumn("source_url", F.when(F.col("search_id") % 11 == 0, "example: x").otherwise("u")).withColumn("mode", F.when(F.col("search_id") % 13 == 0, "odd").otherwise(F.col("mode")))


def search_errors(s, d):
    u = urls(s, d)
    params = staged(E.address_params(u), "search-params")  # used four times
    acks = u.filter("search_id % 2 = 1").select("search_id", F.lit("prospectedByCurrentTeam[]").alias("param"))
    return E.search_errors(_searches(u, params), E.search_params(params), E.unmapped_params(params), acks)


def _stored(s, d, rest):
    return table(s, d, "part").filter(f"p_partkey % 3 <> {rest}").selectExpr("p_partkey AS search_id", f"concat(p_type, {rest}) AS filters", "array(p_brand) AS acknowledged", "p_name AS pre_filter")


def merge_search(s, d):
    return E.merge_search(_stored(s, d, 0), _stored(s, d, 1)).select("search_id", "filters", _items("acknowledged").alias("acknowledged"), "pre_filter")


def acknowledge(s, d):
    acks = table(s, d, "part").filter("p_partkey % 2 = 0").selectExpr("p_partkey AS search_id", "explode(array('new', p_brand)) AS param")
    return E.acknowledge(_stored(s, d, 2), acks).select("search_id", _items("acknowledged").alias("acknowledged"))


def exclusion_params(s, d):
    return E.exclusion_params(E.search_params(urls(s, d)), ["Wholesale"]).select("search_id", "filter", _items("items").alias("items"), "low", "high")


def company_filter(s, d):
    spec = {"p_brand": ["Brand#2", "Brand#17"], "p_type": {"not": ["ECONOMY"]}, "p_size": {"ranges": [(1, 10), (20, 30)]}, "p_retailprice": {"min": 950, "max": None}}
    return E.company_filter(table(s, d, "part"), spec).select("p_partkey")


def retryable(s, d):
    return V.queue(s, d).select("order_key", N.retryable(2).alias("retryable"))


def _work(s, d):
    return N.work_list(V.queue(s, d), "1997-06-01", 2)


def work_list(s, d):
    return _work(s, d).select("batch", "order_key", "domain", "position", "backlog")


def pull_quota(s, d):
    return N.pull_quota(_work(s, d), 1000)


MESSAGES = [
    "Error: Claude usage limit reached|1893456000", "the page says usage limit reached", "You've hit your limit", "5-hour limit reached, resets at 3pm", "API Error: 529 overloaded", "read ECONNRESET", "no such tool", "all done",
]


def raw_outcomes(s, d):
    """events as outcomes of judging calls, the message chosen by the event's number."""
    return table(s, d, "events").selectExpr(
        "event_id AS order_key", "user_id AS run", "ts", "value", "event_type", "CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS rc", "event_id % 23 = 0 AS timed_out",
        "CASE WHEN event_id %% 4 = 0 THEN element_at(array(%s), CAST(event_id %% 8 + 1 AS INT)) END AS stdout" % ", ".join(f'"{m}"' for m in MESSAGES), "'' AS stderr",
        "CASE WHEN event_id %% 4 <> 0 THEN named_struct('result', element_at(array(%s), CAST(event_id DIV 4 %% 8 + 1 AS INT)), 'error', '', 'subtype', '', 'is_error', event_id %% 5 = 0, 'num_turns', 1, 'total_cost_usd', 0.1D, 'api_error_status', CASE WHEN event_id %% 31 = 0 THEN '429' WHEN event_id %% 37 = 0 THEN '503' END) END AS json" % ", ".join(f'"{m}"' for m in MESSAGES),
    )


def classify_outcomes(s, d):
    return raw_outcomes(s, d).select("order_key", N.classify_outcome().alias("kind"))


def outcomes(s, d):
    """events as classified outcomes: runs are users in blocks of time."""
    return table(s, d, "events").selectExpr(
        "concat(user_id, '-', month(ts)) AS run", "event_id AS order_key", "value AS duration", "event_id % 17 = 0 AS crm_only", "event_type",
        "CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'transient' ELSE CASE WHEN event_id % 10 = 0 THEN 'usage_limit' ELSE 'ok' END END AS kind",
    ).withColumn("good", F.expr("kind = 'ok'"))


def stop_point(s, d):
    return N.stop_point(outcomes(s, d), LIMITS).select("run", "order_key", "state", "stop_reason")


def _applied(s, d):
    out = V.queue(s, d).filter("status = 'pending' OR status = 'error'").selectExpr(
        "batch", "domain", "order_key", "CASE WHEN order_key % 6 = 5 THEN 'after' ELSE 'done' END AS state", "'ok' AS kind", "CASE WHEN order_key % 4 <> 3 THEN element_at(array('QUALIFIED', 'NOT_QUALIFIED', 'QUALIFIED'), CAST(order_key % 3 + 1 AS INT)) END AS verdict",
        "concat('message ', order_key) AS message", "element_at(array('created', 'error', 'conflict', 'held'), CAST(order_key % 8 DIV 2 + 1 AS INT)) AS crm",
    )
    return out.groupBy("batch", "domain").agg(*[F.min_by(c, "order_key").alias(c) for c in ("state", "kind", "verdict", "message", "crm")])


def apply_outcomes(s, d):
    return N.apply_outcomes(V.queue(s, d).drop("error"), _applied(s, d)).select("batch", "order_key", "status", "attempts", "hubspot_attempts", "verdict", "error")


def crm_retries(s, d):
    verdicts = table(s, d, "customer").filter("c_custkey % 3 = 0").selectExpr("concat('c', c_custkey, '.example') AS domain")
    return N.crm_retries(V.queue(s, d), verdicts).select("batch", "order_key", "domain")


def left_counts(s, d):
    return N.left_counts(V.queue(s, d), "1997-06-01", 2)


def resume_decision(s, d):
    runs = table(s, d, "events").selectExpr(
        "user_id AS chain", "event_id AS order_key", "CAST(value AS INT) % 3 AS processed", "date_trunc('second', ts) AS at",
        "element_at(array(NULL, 'api_errors', 'api_errors', 'usage_limit', 'deadline', 'odd'), CAST(event_id % 6 + 1 AS INT)) AS stopped_reason",
        "element_at(array('limit|1893456000', 'resets at 3pm', 'resets 12:30 am', 'no time'), CAST(event_id DIV 6 % 4 + 1 AS INT)) AS message",
    ).withColumn("stopped_reason", F.expr("CASE WHEN order_key % 100 < 50 AND order_key % 6 <> 3 THEN 'api_errors' ELSE stopped_reason END"))
    return N.resume_decision(runs).select("chain", "order_key", "decision", "wait_seconds")


def verdict_texts(s, d):
    """documents as prose with a verdict line whose tokens, breaks and fences follow from the document's number."""
    fields = ", ".join([
        "'domain', CASE WHEN doc_id % 41 = 0 THEN ' ' ELSE concat('C', doc_id, '.example') END", "'name', concat('Co ', doc_id)", "'status', CASE WHEN doc_id % 19 = 0 THEN 'error' WHEN doc_id % 23 = 0 THEN 'odd' ELSE 'ok' END",
        "'qualification', element_at(array('QUALIFIED', 'MAYBE', 'NOT_QUALIFIED', 'QUALIFIED', 'GOOD'), CAST(doc_id % 5 + 1 AS INT))", "'buyer_or_vendor', element_at(array('BUYER', 'BUYER', 'VENDOR', 'OTHER'), CAST(doc_id DIV 5 % 4 + 1 AS INT))",
        "'buyer_vendor_reason', 'r'", "'evidence_links', array('http://a', ' ')", "'account_tier', element_at(array('TIER_A', 'TIER_B', 'TIER_C'), CAST(doc_id DIV 3 % 3 + 1 AS INT))", "'need_strength', 'STRONG'", "'current_approach', 'MANUAL'",
        "'timing', CASE WHEN doc_id % 29 = 0 THEN 'SOON' ELSE 'UNKNOWN' END", "'evidence_confidence', 'HIGH'", "'qualification_reason', concat('because ', doc_id)", "'strongest_signal', ' '", "'main_uncertainty', 'none'", "'roles_to_contact', 'CEO'",
    ])
    return table(s, d, "documents").selectExpr("doc_id", "lang", "text AS prose", f"to_json(named_struct({fields})) AS line").selectExpr(
        "doc_id", "lang", "CASE WHEN doc_id % 7 = 0 THEN replace(line, '\"name\":', '\"title\":') WHEN doc_id % 11 = 0 THEN replace(line, '\"HIGH\"', '3') WHEN doc_id % 13 = 0 THEN substr(line, 1, 60) WHEN doc_id % 17 = 0 THEN regexp_replace(line, '\\\\[.*\\\\]', '\"x\"') ELSE line END AS line", "prose",
    ).selectExpr("doc_id", "lang", "line", "prose", "concat(prose, '\\n{not json}\\n', CASE WHEN doc_id % 2 = 0 THEN concat('`', line, '`  ') ELSE line END) AS text")


def last_json(s, d):
    return verdict_texts(s, d).select("doc_id", G.last_json("text").alias("verdict_json"))


def validate_verdicts(s, d):
    return G.validate_verdicts(verdict_texts(s, d)).select("doc_id", "problem")


def choose_verdict(s, d):
    df = verdict_texts(s, d).select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("line")).alias("structured"), F.col("text").alias("result"), F.regexp_replace("line", "because", "saved").alias("saved"),
        F.expr("timestamp'2030-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, doc_id % 5)").alias("saved_at"), F.expr("timestamp'2030-01-01 00:00:03'").alias("started_at"),
    )
    return G.choose_verdict(df).select("doc_id", "origin", G.field("verdict_json", "qualification_reason").alias("reason"))


def verdict_errors(s, d):
    df = verdict_texts(s, d).withColumn("v", G.last_json("text")).withColumn("kind", F.when(F.col("doc_id") % 31 == 0, "timeout").otherwise("ok"))
    domain = F.concat(F.lit("c"), F.when(F.col("doc_id") % 37 == 0, 0).otherwise(F.col("doc_id")), F.lit(".example"))
    return df.select("doc_id", G.verdict_error("kind", F.lit(" took too long "), "text", F.lit(None).cast("string"), F.lit(3), "v", domain).alias("error"))


def _verdicts(s, d):
    df = G.validate_verdicts(verdict_texts(s, d)).filter("problem IS NULL")
    return G.fields(df.select("doc_id", "verdict_json"))


def backstop(s, d):
    return G.apply_backstop(_verdicts(s, d)).select("doc_id", "qualification", "account_tier", "backstop")


def hold_tiers(s, d):
    return G.hold_tiers(G.apply_backstop(_verdicts(s, d)), ["TIER_A"]).select("doc_id", "held")


def strip_verdict(s, d):
    return verdict_texts(s, d).select("doc_id", F.md5(C.strip_verdict("text")).alias("prose_md5"))


QUERIES = {f.__name__: f for f in (
    search_params, search_mode, unmapped_params, resolve_dates, search_errors, merge_search, acknowledge, exclusion_params, company_filter, retryable, work_list, pull_quota, classify_outcomes, stop_point, apply_outcomes, crm_retries, left_counts,
    resume_decision, last_json, validate_verdicts, choose_verdict, verdict_errors, backstop, hold_tiers, strip_verdict,
)}

PART = "p AS (SELECT p_partkey AS id, p_name, p_brand, p_type, p_size, p_retailprice, p_partkey % 5 = 0 AS listed, ['companies', 'people', 'accounts'][(p_partkey % 3 + 1)::INT] AS tab FROM part)"
MORE_SQL = ", ".join("[%s][(id %% %d + 1)::INT] AS %s" % (", ".join(f"'{x}'" for x in xs), len(MORE), name) for name, xs in (("more", MORE), ("kind", MORE.values())))
OTHER_SQL = "SELECT * FROM (VALUES %s) o(k, param, reason)" % ", ".join(f"({k}, '{p}', '{why}')" for k, (p, (why, _)) in enumerate(E.UNTRANSLATED.items()))
PARAMS = PART + f""", f AS (
    SELECT id AS search_id, 'organization_locations' AS filter, CASE WHEN p_name = 'Chile' THEN 'Chile' ELSE p_name || '|Chile' END AS items, NULL AS low, NULL AS high, NULL AS scalar FROM p
    UNION ALL SELECT id, 'organization_num_employees_ranges', p_size || ',99', NULL, NULL, NULL FROM p
    UNION ALL SELECT id, 'revenue_range', '', p_size || '000', CASE WHEN id % 4 <> 0 THEN 'many' END, NULL FROM p
    UNION ALL SELECT id, 'total_funding_range', '', (p_size * 10)::VARCHAR, '1000', NULL FROM p
    UNION ALL SELECT id, 'latest_funding_amount_range', '', '5', 'inf', NULL FROM p
    UNION ALL SELECT id, lower(regexp_replace(more, '([A-Z])', '_\\1', 'g')), CASE WHEN kind = 'list' THEN 'v ' || p_size || '|w/x' ELSE '' END,
        CASE kind WHEN 'number' THEN '1' || p_size || '000' WHEN 'date' THEN 'today' WHEN 'text' THEN 'x' END, CASE kind WHEN 'number' THEN '1e30' WHEN 'date' THEN '99999999_years_ago' WHEN 'text' THEN '2,000' END,
        CASE kind WHEN 'one' THEN 'last' || p_size WHEN 'whole' THEN p_size::VARCHAR END FROM (SELECT *, {MORE_SQL} FROM p)
    UNION ALL SELECT id, 'latest_funding_date_range', '', p_size || '_days_ago', NULL, NULL FROM p
    UNION ALL SELECT id, CASE WHEN listed THEN 'account_label_ids' ELSE 'organization_naics_codes' END, CASE WHEN listed THEN 'l1' ELSE '4451' END, NULL, NULL, NULL FROM p)"""
UNMAPPED = """u AS (SELECT id AS search_id, 'prospectedByCurrentTeam[]' AS param, 'yes' AS value, 'saved accounts only is not net new' AS reason FROM p WHERE id % 2 = 1
    UNION ALL SELECT id, 'qKeywords', 'a b', 'free text is not a filter' FROM p WHERE id % 6 = 0 UNION ALL SELECT id, 'totalFundingRange', '5', 'range without [min] or [max]' FROM p WHERE id % 6 = 0
    UNION ALL SELECT id, 'oddOne', '1', 'unknown parameter' FROM p WHERE id % 6 = 0 UNION ALL SELECT id, param, 'z', reason FROM p JOIN (""" + OTHER_SQL + f""") ON id % {len(E.UNTRANSLATED) + len(E.SCREEN_ONLY)} = k
    UNION ALL SELECT id, '#/' || tab, '', 'not an address of the companies tab' FROM p WHERE tab = 'people')"""
RETRY = "(status = 'pending' OR status = 'error' AND attempts < 2 OR status = 'hubspot_error' AND hubspot_attempts < 2)"
WORK = QUEUE + f", w AS (SELECT *, row_number() OVER (ORDER BY batch, order_key) AS position, batch < '1997-06-01' AS backlog FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY batch, order_key) AS n FROM v_queue WHERE batch <= '1997-06-01' AND {RETRY}) WHERE n = 1)"
OUT = """o AS (SELECT user_id || '-' || month(ts) AS run, event_id AS k, value AS dur, event_id % 17 = 0 AS crm, CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'transient' ELSE CASE WHEN event_id % 10 = 0 THEN 'usage_limit' ELSE 'ok' END END AS kind FROM events),
    a AS (SELECT *, NOT crm AND kind = 'ok' AS good, NOT crm AND kind = 'transient' AS tr, NOT crm AND kind IN ('error', 'transient') AS er, count(*) OVER b AS before, coalesce(sum(dur) OVER b, 0) AS spent FROM o WINDOW b AS (PARTITION BY run ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    i AS (SELECT *, sum(good::INT) OVER (PARTITION BY run ORDER BY k) AS ei, sum((NOT tr AND NOT crm)::INT) OVER (PARTITION BY run ORDER BY k) AS ti FROM a),
    t AS (SELECT *, sum(er::INT) OVER (PARTITION BY run, ei ORDER BY k) AS es, sum(tr::INT) OVER (PARTITION BY run, ti ORDER BY k) AS ts FROM i),
    y AS (SELECT *, CASE WHEN before >= 60 THEN 'cap_reached' WHEN 5000 - spent < 120 THEN 'deadline' WHEN NOT crm AND kind = 'usage_limit' THEN 'usage_limit' WHEN tr AND ts >= 2 THEN 'api_errors' WHEN er AND es >= 3 THEN 'consecutive_errors' END AS why FROM t),
    z AS (SELECT *, min(k) FILTER (why IS NOT NULL) OVER (PARTITION BY run) AS sk, arg_min(why, k) FILTER (why IS NOT NULL) OVER (PARTITION BY run) AS reason FROM y),
    st AS (SELECT run, k AS order_key, CASE WHEN sk IS NULL OR k < sk OR k = sk AND reason IN ('api_errors', 'consecutive_errors') THEN 'done' WHEN k = sk THEN 'left' ELSE 'after' END AS state, reason AS stop_reason, kind, dur FROM z)"""
Q5 = "['QUALIFIED', 'MAYBE', 'NOT_QUALIFIED', 'QUALIFIED', 'GOOD'][(doc_id % 5 + 1)::INT]"
DOCS = f"""v AS (SELECT doc_id, {Q5} AS q, ['BUYER', 'BUYER', 'VENDOR', 'OTHER'][(doc_id // 5 % 4 + 1)::INT] AS b, ['TIER_A', 'TIER_B', 'TIER_C'][(doc_id // 3 % 3 + 1)::INT] AS t,
    doc_id % 7 = 0 AS no_name, doc_id % 7 <> 0 AND doc_id % 11 = 0 AS num, doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 = 0 AS cut, doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND doc_id % 17 = 0 AS no_list FROM documents),
    c AS (SELECT *, CASE WHEN cut THEN 'no JSON object line in result' WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN 'verdict status odd' WHEN no_name THEN 'missing keys: name' WHEN num THEN 'non-string values for: evidence_confidence' WHEN doc_id % 41 = 0 THEN 'empty domain'
        WHEN q = 'GOOD' THEN 'bad qualification GOOD' WHEN b = 'OTHER' THEN 'bad buyer_or_vendor OTHER' WHEN doc_id % 29 = 0 THEN 'bad timing SOON' WHEN no_list THEN 'evidence_links must be a list' END AS problem FROM v)"""
BACK = DOCS + """, k AS (SELECT *, doc_id % 19 <> 0 AS ok FROM c WHERE problem IS NULL), e AS (SELECT *, ok AND q = 'MAYBE' AS maybe, ok AND q = 'QUALIFIED' AND b IS DISTINCT FROM 'BUYER' AS nb FROM k),
    g AS (SELECT *, CASE WHEN maybe OR nb THEN 'NOT_QUALIFIED' ELSE q END AS fq FROM e), bs AS (SELECT doc_id, fq AS qualification, CASE WHEN ok AND fq = 'NOT_QUALIFIED' THEN 'TIER_C' ELSE t END AS account_tier,
    nullif(concat_ws('; ', CASE WHEN maybe THEN 'MAYBE->NOT_QUALIFIED (verdicts are binary)' WHEN nb THEN 'downgraded QUALIFIED->NOT_QUALIFIED (buyer_or_vendor=' || b || ')' END,
        CASE WHEN ok AND fq = 'NOT_QUALIFIED' AND t <> 'TIER_C' THEN 'tier ' || t || '->TIER_C (not qualified)' WHEN ok AND fq = 'QUALIFIED' AND t = 'TIER_C' THEN 'QUALIFIED with TIER_C: the verdict contradicts its tier, kept as returned' END), '') AS backstop FROM g)"""

SQL = {
    "search_params": f"WITH {PARAMS} SELECT * FROM f",
    "search_mode": f"WITH {PART} SELECT id AS search_id, CASE WHEN listed THEN 'list' ELSE 'net_new_search' END AS mode FROM p",
    "unmapped_params": f"WITH {PART}, {UNMAPPED} SELECT * FROM u",
    "resolve_dates": f"""WITH {PARAMS} SELECT search_id, filter, CASE filter WHEN 'latest_funding_date_range' THEN (DATE '2030-01-15' - p_size)::DATE::VARCHAR WHEN 'organization_job_posted_at_range' THEN '2030-01-15' ELSE low END AS low, high
        FROM f JOIN p ON search_id = id WHERE filter IN ('latest_funding_date_range', 'organization_job_posted_at_range', 'latest_funding_detected_at_range')""",
    "search_errors": f"""WITH {PARAMS}, {UNMAPPED}, s AS (SELECT id, CASE WHEN id % 13 = 0 THEN 'odd' WHEN listed THEN 'list' ELSE 'net_new_search' END AS mode, listed FROM p)
        SELECT id AS search_id, 'the source is an example' AS error FROM s WHERE id % 11 = 0
        UNION ALL SELECT search_id, 'unacknowledged unmapped filter ' || param || ': ' || reason FROM u WHERE NOT (search_id % 2 = 1 AND param = 'prospectedByCurrentTeam[]')
        UNION ALL SELECT id, 'required filter missing: organization_naics_codes|organization_sic_codes' FROM s WHERE mode = 'net_new_search' AND listed UNION ALL SELECT id, 'list mode without a label' FROM s WHERE mode = 'list' AND NOT listed
        UNION ALL SELECT id, 'unknown mode odd' FROM s WHERE mode = 'odd'""",
    "merge_search": """WITH o AS (SELECT * FROM part WHERE p_partkey % 3 <> 0), n AS (SELECT * FROM part WHERE p_partkey % 3 <> 1)
        SELECT coalesce(o.p_partkey, n.p_partkey) AS search_id, CASE WHEN n.p_partkey IS NOT NULL THEN n.p_type || '1' ELSE o.p_type || '0' END AS filters, CASE WHEN n.p_partkey IS NOT NULL THEN '' ELSE o.p_brand END AS acknowledged, o.p_name AS pre_filter FROM o FULL JOIN n ON o.p_partkey = n.p_partkey""",
    "acknowledge": "SELECT p_partkey AS search_id, CASE WHEN p_partkey % 2 = 0 THEN p_brand || '|new' ELSE p_brand END AS acknowledged FROM part WHERE p_partkey % 3 <> 2",
    "exclusion_params": f"WITH {PARAMS} SELECT search_id, filter, items, low, high FROM f WHERE filter NOT IN ('account_label_ids', 'q_organization_keyword_tags', 'q_organization_domains_list', 'organization_ids', 'latest_funding_detected_at_range', 'q_organization_name') UNION ALL SELECT id, 'q_organization_keyword_tags', 'Wholesale', NULL, NULL FROM p",
    "company_filter": "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#2', 'Brand#17') AND coalesce(p_type, '') <> 'ECONOMY' AND (p_size BETWEEN 1 AND 10 OR p_size BETWEEN 20 AND 30) AND p_retailprice >= 950",
    "retryable": f"WITH {QUEUE} SELECT order_key, {RETRY} AS retryable FROM v_queue",
    "work_list": f"WITH {WORK} SELECT batch, order_key, domain, position, backlog FROM w",
    "pull_quota": f"WITH {WORK} SELECT count(*) FILTER (backlog) AS backlog, greatest(0, 1000 - count(*) FILTER (backlog)) AS quota FROM w",
    "classify_outcomes": """WITH e AS (SELECT event_id AS k, event_id % 4 = 0 AS bare, CASE WHEN event_id % 4 = 0 THEN event_id % 8 ELSE event_id // 4 % 8 END AS m, event_id % 3 = 0 AS rc0, event_id % 4 <> 0 AND event_id % 5 = 0 AS is_err,
        CASE WHEN event_id % 4 <> 0 AND event_id % 31 = 0 THEN 429 WHEN event_id % 4 <> 0 AND event_id % 37 = 0 THEN 503 END AS code FROM events)
        SELECT k AS order_key, CASE WHEN k % 23 = 0 THEN 'timeout' WHEN rc0 AND NOT is_err AND NOT bare THEN 'ok' WHEN code = 429 OR m IN (0, 2, 3) THEN 'usage_limit' WHEN code = 503 OR m IN (4, 5) THEN 'transient' ELSE 'error' END AS kind FROM e""",
    "stop_point": f"WITH {OUT} SELECT run, order_key, state, stop_reason FROM st",
    "apply_outcomes": f"""WITH {QUEUE}, x AS (SELECT batch, domain, order_key, order_key % 6 <> 5 AS done, CASE WHEN order_key % 4 <> 3 THEN ['QUALIFIED', 'NOT_QUALIFIED', 'QUALIFIED'][(order_key % 3 + 1)::INT] END AS v, 'message ' || order_key AS m, ['created', 'error', 'conflict', 'held'][(order_key % 8 // 2 + 1)::INT] AS crm,
            row_number() OVER (PARTITION BY batch, domain ORDER BY order_key) AS n FROM v_queue WHERE status IN ('pending', 'error')),
        o AS (SELECT * FROM x WHERE n = 1 AND done),
        r AS (SELECT q.*, o.domain IS NOT NULL AS hit, o.v, o.m, o.crm, CASE WHEN o.domain IS NULL THEN status WHEN o.v IS NULL THEN 'error' WHEN o.crm = 'error' THEN 'hubspot_error' WHEN o.crm = 'conflict' THEN 'needs_review' ELSE 'done' END AS st FROM v_queue q LEFT JOIN o USING (batch, domain))
        SELECT batch, order_key, st AS status, attempts + hit::INT AS attempts, hubspot_attempts + (hit AND v IS NOT NULL AND crm = 'error')::INT AS hubspot_attempts, coalesce(v, verdict) AS verdict, CASE WHEN hit AND st IN ('error', 'hubspot_error', 'needs_review') THEN m END AS error FROM r""",
    "crm_retries": f"WITH {QUEUE} SELECT batch, order_key, domain FROM v_queue WHERE status = 'hubspot_error' AND domain IN (SELECT 'c' || c_custkey || '.example' FROM customer WHERE c_custkey % 3 = 0)",
    "left_counts": f"WITH {QUEUE} SELECT count(*) FILTER (status = 'pending') AS pending_left, count(*) FILTER ({RETRY}) AS retryable_left FROM v_queue WHERE batch <= '1997-06-01'",
    "resume_decision": """WITH r AS (SELECT user_id AS chain, event_id AS k, trunc(value)::INT % 3 AS processed, date_trunc('second', ts) AS t0, event_id // 6 % 4 AS m,
            CASE WHEN event_id % 100 < 50 AND event_id % 6 <> 3 THEN 'api_errors' ELSE [NULL, 'api_errors', 'api_errors', 'usage_limit', 'deadline', 'odd'][(event_id % 6 + 1)::INT] END AS reason FROM events),
        i AS (SELECT *, sum((reason IS DISTINCT FROM 'api_errors')::INT) OVER (PARTITION BY chain ORDER BY k) AS isl FROM r), t AS (SELECT *, sum((reason IS NOT DISTINCT FROM 'api_errors')::INT) OVER (PARTITION BY chain, isl ORDER BY k) - 1 AS streak FROM i),
        d AS (SELECT *, CASE WHEN reason = 'usage_limit' THEN 'wait_reset' WHEN reason = 'api_errors' THEN CASE WHEN streak < 4 THEN 'wait_api' ELSE 'stop' END WHEN (reason IS NULL OR reason = 'deadline') AND processed > 0 THEN 'continue' ELSE 'stop' END AS decision,
            date_trunc('day', t0) + CASE m WHEN 1 THEN INTERVAL 15 HOUR WHEN 2 THEN INTERVAL 30 MINUTE END AS goal FROM t)
        SELECT chain, k AS order_key, decision, CASE WHEN decision = 'wait_reset' THEN CASE WHEN m = 0 THEN greatest(0, 1893456000 - epoch(t0)) WHEN m IN (1, 2) THEN epoch(goal) - epoch(t0) + CASE WHEN goal <= t0 THEN 86400 ELSE 0 END END END::DOUBLE AS wait_seconds FROM d""",
    "last_json": f"""WITH {DOCS}, l AS (SELECT *, '{{"domain":"' || CASE WHEN doc_id % 41 = 0 THEN ' ' ELSE 'C' || doc_id || '.example' END || '","name":"Co ' || doc_id || '","status":"' || CASE WHEN doc_id % 19 = 0 THEN 'error' WHEN doc_id % 23 = 0 THEN 'odd' ELSE 'ok' END || '","qualification":"' || q
        || '","buyer_or_vendor":"' || b || '","buyer_vendor_reason":"r","evidence_links":["http://a"," "],"account_tier":"' || t || '","need_strength":"STRONG","current_approach":"MANUAL","timing":"' || CASE WHEN doc_id % 29 = 0 THEN 'SOON' ELSE 'UNKNOWN' END
        || '","evidence_confidence":"HIGH","qualification_reason":"because ' || doc_id || '","strongest_signal":" ","main_uncertainty":"none","roles_to_contact":"CEO"}}' AS line FROM v)
        SELECT doc_id, CASE WHEN no_name THEN replace(line, '"name":', '"title":') WHEN num THEN replace(line, '"HIGH"', '3') WHEN cut THEN NULL WHEN no_list THEN regexp_replace(line, '\\[.*\\]', '"x"') ELSE line END AS verdict_json FROM l""",
    "validate_verdicts": f"WITH {DOCS} SELECT doc_id, problem FROM c",
    "choose_verdict": f"""WITH {DOCS}, x AS (SELECT *, doc_id % 3 = 0 AND NOT cut AS st, problem IS NULL AS good, doc_id % 5 >= 2 AND NOT cut AS sv FROM c)
        SELECT doc_id, CASE WHEN st THEN 'structured' WHEN good THEN 'result' WHEN doc_id % 5 >= 2 AND NOT cut THEN 'saved' END AS origin, CASE WHEN st OR good THEN 'because ' || doc_id WHEN sv THEN 'saved ' || doc_id END AS reason FROM x""",
    "strip_verdict": "SELECT doc_id, md5(coalesce(text, '') || chr(10) || '{not json}' || chr(10)) AS prose_md5 FROM documents",
    "verdict_errors": f"""WITH {DOCS} SELECT doc_id, CASE WHEN doc_id % 31 = 0 THEN 'timeout: took too long' WHEN problem IS NOT NULL THEN 'unparseable verdict: ' || problem WHEN doc_id % 19 = 0 THEN 'skill error: '
        WHEN doc_id % 41 = 0 OR doc_id % 37 = 0 AND doc_id <> 0 THEN 'verdict domain mismatch: C' || doc_id || '.example' END AS error FROM c""",
    "backstop": f"WITH {BACK} SELECT * FROM bs",
    "hold_tiers": f"WITH {BACK} SELECT doc_id, qualification = 'QUALIFIED' AND account_tier <> 'TIER_A' AS held FROM bs",
}
