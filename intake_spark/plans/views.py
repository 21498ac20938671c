"""Views that shape the given tables into intake tables, each as a DataFrame and as the same view in SQL.

They read whole tables; what the tables lack (ids, broken rows, missing fields) is derived from keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.selection import Scope

#: The scope that queries use.
SCOPE = Scope(name_pattern="tion ther|schaft|quele", industry_pattern="^es$", subsidiaries=True, countries=("United States", "Canada"), headcount_min=1000, headcount_max=9000)
CAP = 40
#: Filters of the search that the candidates come from.
FILTERS = {
    "currently_using_any_of_technology_uids": ["crm", "erp"], "q_organization_job_titles": [], "organization_job_posted_at_range": {"min": "30_days_ago"}, "total_funding_range": {"max": 5},
    "latest_funding_date_range": {"min": ""}, "organization_naics_codes": ["4451", "4452"], "organization_num_employees_ranges": ["11,50"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_rows(spark, d) -> DataFrame:
    """pages as search rows: batches of 100 pages a day, host, title, language and length as company fields."""
    return table(spark, d, "pages").selectExpr(
        "page_id AS order_key", "CAST(date_add(DATE'2030-01-01', CAST(page_id DIV 100 AS INT)) AS STRING) AS batch",
        "CASE WHEN page_id % 41 = 0 THEN 'no-id' ELSE substr(md5(CAST(page_id AS STRING)), 1, 24) END AS org_id",
        "CASE WHEN page_id % 43 = 0 THEN substr(md5(concat('a', page_id)), 1, 24) END AS account_id",
        "CASE WHEN page_id % 29 <> 0 THEN regexp_extract(html, '<title>([^<]*)', 1) END AS name",
        "CASE WHEN page_id % 31 = 0 THEN 'localhost' WHEN page_id % 37 <> 0 THEN url END AS domain",
        "regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS industry",
        "CASE WHEN page_id % 11 <> 0 THEN concat(length(html) DIV 1000, ',', lpad(CAST(length(html) % 1000 AS STRING), 3, '0')) END AS headcount",
        "element_at(array('US', 'usa', 'Canada', 'ca', 'Germany', 'U.K.', NULL), CAST(page_id % 7 + 1 AS INT)) AS country",
        "CASE WHEN page_id % 13 = 0 THEN 'Parent' END AS parent_company",
        "CASE WHEN page_id % 5 = 0 THEN 'crm, erp' WHEN page_id % 5 = 1 THEN 'Wholesale' END AS keywords",
        "CASE WHEN page_id % 3 = 0 THEN CAST(page_id * 1000 AS STRING) END AS funding_total",
    )


def listed_rows(spark, d) -> DataFrame:
    """source_rows with list columns: blanks and nulls among the entries, empty lists, and lists of nothing else."""
    return source_rows(spark, d).withColumns({
        "technologies": F.expr("CASE order_key % 5 WHEN 0 THEN array('erp', NULL, '', industry) WHEN 1 THEN array('', NULL) WHEN 2 THEN CAST(array() AS ARRAY<STRING>) WHEN 3 THEN array('crm') END"),
        "job_titles": F.expr("CASE WHEN order_key % 3 <> 0 THEN array(name, '', country) END"),
    })


def sql_domain(x: str) -> str:
    host = f"split_part(split_part(split_part(regexp_replace(lower(trim({x})), '^[a-z][a-z0-9+.-]*://', ''), '/', 1), '?', 1), '#', 1)"
    host = f"trim(split_part(split_part({host}, '@', -1), ':', 1), '.')"
    host = f"regexp_replace({host}, '^www\\.', '')"
    return f"CASE WHEN contains({host}, '.') THEN {host} END"


ROWS = """v_rows AS (SELECT page_id AS order_key, (DATE '2030-01-01' + (page_id // 100)::INT)::VARCHAR AS batch,
    CASE WHEN page_id % 41 = 0 THEN 'no-id' ELSE substr(md5(page_id::VARCHAR), 1, 24) END AS org_id,
    CASE WHEN page_id % 43 = 0 THEN substr(md5('a' || page_id), 1, 24) END AS account_id,
    CASE WHEN page_id % 29 <> 0 THEN regexp_extract(html, '<title>([^<]*)', 1) END AS name,
    CASE WHEN page_id % 31 = 0 THEN 'localhost' WHEN page_id % 37 <> 0 THEN url END AS domain,
    regexp_extract(html, 'lang="([a-z]+)"', 1) AS industry,
    CASE WHEN page_id % 11 <> 0 THEN (length(html) // 1000) || ',' || lpad((length(html) % 1000)::VARCHAR, 3, '0') END AS headcount,
    ['US', 'usa', 'Canada', 'ca', 'Germany', 'U.K.', NULL][(page_id % 7 + 1)::INT] AS country,
    CASE WHEN page_id % 13 = 0 THEN 'Parent' END AS parent_company,
    CASE WHEN page_id % 5 = 0 THEN 'crm, erp' WHEN page_id % 5 = 1 THEN 'Wholesale' END AS keywords,
    CASE WHEN page_id % 3 = 0 THEN (page_id * 1000)::VARCHAR END AS funding_total FROM pages)"""

CLEAN = ROWS + """, v_clean AS (SELECT batch, order_key, %s AS domain, nullif(trim(name), '') AS name, org_id, account_id, industry, trunc(replace(headcount, ',', '')::DOUBLE)::BIGINT AS headcount, country, parent_company,
    trunc(funding_total::DOUBLE)::BIGINT AS funding_total,
    CASE WHEN NOT regexp_matches(org_id, '^[a-f0-9]{24}$') THEN 'bad org_id' WHEN account_id IS NOT NULL AND NOT regexp_matches(account_id, '^[a-f0-9]{24}$') THEN 'bad account_id'
         WHEN domain IS NOT NULL AND %s IS NULL THEN 'bad domain' WHEN coalesce(nullif(name, ''), domain) IS NULL THEN 'no name or domain' END AS problem FROM v_rows)""" % (sql_domain("domain"), sql_domain("domain"))


def seen(spark, d) -> DataFrame:
    """Hosts of every seventh page, as an earlier batch."""
    return table(spark, d, "pages").filter("page_id % 7 = 3").selectExpr("'2029-12-31' AS batch", "url AS domain")


SEEN = "v_seen AS (SELECT DISTINCT %s AS domain FROM pages WHERE page_id %% 7 = 3)" % sql_domain("url")


def excluded(spark, d) -> DataFrame:
    return table(spark, d, "pages").filter("page_id % 19 = 0").selectExpr("CASE WHEN page_id % 2 = 0 THEN substr(md5(CAST(page_id AS STRING)), 1, 24) END AS org_id", "CASE WHEN page_id % 2 = 1 THEN url END AS url").select("org_id", _domain("url"))


def _domain(c):
    from ..functions.columns import normalize_domain

    return normalize_domain(c).alias("domain")


EXCLUDED = "v_excluded AS (SELECT CASE WHEN page_id %% 2 = 0 THEN substr(md5(page_id::VARCHAR), 1, 24) END AS org_id, CASE WHEN page_id %% 2 = 1 THEN %s END AS domain FROM pages WHERE page_id %% 19 = 0)" % sql_domain("url")


def registered(spark, d) -> DataFrame:
    """Every third page as an account: by org id, by domain, or by name alone."""
    return table(spark, d, "pages").filter("page_id % 3 = 0").selectExpr(
        "page_id AS reg_order", "CASE WHEN page_id % 12 = 0 THEN substr(md5(CAST(page_id AS STRING)), 1, 24) END AS organization_id", "CASE WHEN page_id % 12 = 3 THEN url WHEN page_id % 12 = 9 THEN concat('other', page_id, '.example') END AS domain",
        "regexp_extract(html, '<title>([^<]*)', 1) AS name", "CASE WHEN page_id % 15 <> 0 THEN concat('acc', page_id) END AS account_id",
    )


REGISTERED = """v_reg AS (SELECT page_id AS reg_order, CASE WHEN page_id %% 12 = 0 THEN substr(md5(page_id::VARCHAR), 1, 24) END AS organization_id,
    CASE WHEN page_id %% 12 = 3 THEN %s WHEN page_id %% 12 = 9 THEN 'other' || page_id || '.example' END AS domain, lower(trim(regexp_extract(html, '<title>([^<]*)', 1))) AS name,
    CASE WHEN page_id %% 15 <> 0 THEN 'acc' || page_id END AS account_id FROM pages WHERE page_id %% 3 = 0)""" % sql_domain("url")


def queue(spark, d) -> DataFrame:
    """orders as queue rows: a batch a month, a company a customer."""
    return table(spark, d, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM-01') AS batch", "o_orderkey AS order_key", "concat('c', o_custkey, '.example') AS domain",
        "CASE WHEN o_orderkey % 9 <> 0 THEN concat('acc', o_custkey) END AS account_id",
        "CASE WHEN o_orderkey % 10 = 0 THEN 'skipped_prefilter' WHEN o_orderkey % 10 = 1 THEN 'hubspot_error' WHEN o_orderstatus = 'O' THEN 'error' WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'done' END AS status",
        "CAST(o_orderkey % 3 AS INT) AS attempts", "CAST(o_orderkey % 4 AS INT) AS hubspot_attempts",
        "element_at(array('QUALIFIED', 'MAYBE', 'NOT_QUALIFIED', NULL), CAST(o_orderkey % 4 + 1 AS INT)) AS verdict",
        "CASE WHEN o_orderkey % 5 = 0 THEN element_at(array('created', 'updated', 'exists', 'unchanged', 'held'), CAST(o_orderkey % 25 DIV 5 + 1 AS INT)) END AS action",
        "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS STRING) END AS crm_id",
    )


QUEUE = """v_queue AS (SELECT strftime(o_orderdate, '%Y-%m-01') AS batch, o_orderkey AS order_key, 'c' || o_custkey || '.example' AS domain, CASE WHEN o_orderkey % 9 <> 0 THEN 'acc' || o_custkey END AS account_id,
    CASE WHEN o_orderkey % 10 = 0 THEN 'skipped_prefilter' WHEN o_orderkey % 10 = 1 THEN 'hubspot_error' WHEN o_orderstatus = 'O' THEN 'error' WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'done' END AS status,
    (o_orderkey % 3)::INT AS attempts, (o_orderkey % 4)::INT AS hubspot_attempts, ['QUALIFIED', 'MAYBE', 'NOT_QUALIFIED', NULL][(o_orderkey % 4 + 1)::INT] AS verdict,
    CASE WHEN o_orderkey % 5 = 0 THEN ['created', 'updated', 'exists', 'unchanged', 'held'][(o_orderkey % 25 // 5 + 1)::INT] END AS action, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey::VARCHAR END AS crm_id FROM orders)"""
