"""Queries for stored pages, job feeds and streams."""

from __future__ import annotations

import html
import html.entities

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import pages as P
from ..operators.selection import Scope
from ..streaming import streams
from . import records as K
from . import views as V
from .intake import FIRST, scratch
from .views import table

SIGNALS = P.Signals(
    topic_terms=("the", "que", "und", "de"), role_terms=("role", "de"), path_tokens=("en", "fr", "25"), priority_paths=("fr", "es"), secondary_paths=("en",), seed_subdomains=("m",), seed_paths=("en", "about"), skip=("/13",),
)
LINKS = P.Signals(path_tokens=("the", "to", "de", "und"))
AGENT = "own/1"


def pages(s, d):
    return table(s, d, "pages").withColumn("site", C.normalize_domain("url")).withColumn("host", F.try_parse_url("url", F.lit("HOST")))


def page_text(s, d):
    return P.page_text(table(s, d, "pages")).select("page_id", "title", "markdown")


def page_names(s, d):
    """Names of pages at their addresses and at deeper ones, up to far beyond the longest name."""
    deep = F.expr("concat(url, repeat('/section', CAST(page_id % 15 AS INT)))")
    return table(s, d, "pages").select("page_id", C.page_name(deep).alias("name"))


def answers(s, d):
    return pages(s, d).select("site", F.col("page_id").alias("n"), F.expr("page_id % 4 <> 0").alias("live"), F.expr("page_id % 3 <> 0").alias("allowed"), F.expr("element_at(array(200, 401, 200, 503, 404, NULL), CAST(page_id % 6 + 1 AS INT))").alias("status"), F.expr("CASE WHEN page_id % 10 = 0 THEN concat('<i>cf-chl', html) ELSE html END").alias("body"))


def refusal(s, d):
    return answers(s, d).select("n", P.refusal("status", "body").alias("reason"))


def site_status(s, d):
    return P.site_status(answers(s, d).filter("site IS NOT NULL"))


def robots(s, d):
    body = "User-agent: *\nDisallow: /\n\nUser-agent: Own # ours\nUser-agent: other\nDisallow: /en/2\nAllow: /en/25\nDisallow: /*5$\nDisallow:\n"
    return pages(s, d).filter("length(host) % 7 <> 6").select("host", F.expr("element_at(array(200, 404, 403, 200, 503), CAST(length(host) % 5 + 1 AS INT))").alias("status"), F.lit(body).alias("body")).distinct()


def robots_allowed(s, d):
    return P.robots_allowed(table(s, d, "pages").select("page_id", "url"), robots(s, d), AGENT).select("page_id", "allowed")


def sitemaps(s, d):
    loc = F.concat(F.lit("<url><loc>\n "), "url", F.lit(" </loc></url>"))
    return pages(s, d).withColumn("part", F.floor(F.col("page_id") / 100)).groupBy("site", "part").agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(loc), ""), F.lit("</urlset>")).alias("body"))


def sitemap_locs(s, d):
    return P.sitemap_locs(sitemaps(s, d)).select("site", "url")


def pick_urls(s, d):
    return P.pick_urls(pages(s, d), SIGNALS).select("page_id", "url")


def top_seeds(s, d):
    return P.top_seeds(pages(s, d), SIGNALS, 3)


def seed_urls(s, d):
    sites = pages(s, d).select("site").distinct()
    return P.seed_urls(sites, pages(s, d).select("host").distinct(), P.pick_urls(pages(s, d).select("site", "url"), SIGNALS), SIGNALS, 3)


def follow_links(s, d):
    return P.follow_links(table(s, d, "pages"), LINKS)


def documents(s, d):
    """documents as pages: a site per source, the first words as title; of every third document, about three of a site share an address."""
    address = "concat('https://', source, '.example:443/', CASE WHEN doc_id % 3 = 0 THEN concat('p', doc_id DIV 180) ELSE CAST(doc_id AS STRING) END) AS url"
    return table(s, d, "documents").selectExpr("source AS site", "doc_id AS order_key", address, "substring_index(text, '.', 1) AS title", "text AS markdown", "concat('f', doc_id % 700) AS file")


def usable_pages(s, d):
    return P.usable_pages(documents(s, d)).select("site", "order_key", "url", "words")


def page_index(s, d):
    return P.page_index(P.usable_pages(documents(s, d)), SIGNALS).select("site", "order_key", "terms", "words", "place")


def dropped_files(s, d):
    return P.dropped_files(documents(s, d), P.usable_pages(documents(s, d)))


def edges(s, d):
    """Each page links to the next and to the one with twice its number, in its language's site."""
    p = table(s, d, "pages").selectExpr("regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS site", "page_id")
    return p.select("site", F.concat(F.lit("p"), "page_id").alias("url"), F.explode(F.expr("array(concat('p', page_id + 1), concat('p', page_id * 2))")).alias("link"))


def reachable(s, d):
    seeds = edges(s, d).filter("url LIKE '%7'").select("site", "url")
    return P.reachable(seeds, edges(s, d), 2, 50)


def texts(s, d):
    return table(s, d, "documents").selectExpr("source AS site", "doc_id AS order_key", "CASE WHEN doc_id % 3 = 0 THEN concat(text, ' https://jobs.lever.co/Slug', doc_id % 7, ' and https://jobs.lever.co/jobs') WHEN doc_id % 3 = 1 THEN concat('boards.greenhouse.io/embed/job_board?for=G', doc_id % 5, ' ', text) WHEN length(source) = 4 THEN 'x.icims.com' ELSE text END AS text")


def find_boards(s, d):
    return P.find_boards(texts(s, d)).select("site", "kind", "slug", "place")


def feed_urls(s, d):
    sites = table(s, d, "documents").selectExpr("concat(source, '-x.example') AS site")
    return P.feed_urls(sites, P.find_boards(texts(s, d).withColumn("site", F.concat("site", F.lit("-x.example")))))


def feeds(s, d):
    """documents as job feeds of 50 postings: a bare list, or under jobs; the location a text or a struct."""
    job = "named_struct('doc_id', doc_id, 'title', concat(CASE WHEN doc_id % 4 = 0 THEN 'Role ' ELSE 'Job ' END, doc_id), 'content', concat('<p>Work &amp;amp; play</p> at ', CASE WHEN doc_id % 5 = 0 THEN source ELSE 'us' END, CASE WHEN doc_id % 6 = 0 THEN ' the que' ELSE '' END), 'absolute_url', concat('http://j/', doc_id), 'departments', array(named_struct('name', lang), named_struct('name', 'all')))"
    rows = table(s, d, "documents").selectExpr("source AS name", "doc_id DIV 1000 AS place", f"{job} AS job", "doc_id")
    body = rows.groupBy("name", "place").agg(F.array_sort(F.collect_list("job")).alias("jobs"))
    as_list = F.to_json(F.transform("jobs", lambda x: x.withField("location", F.struct(F.lit("Lyon").alias("name")))))
    as_struct = F.to_json(F.struct(F.transform("jobs", lambda x: x.withField("location", F.lit("Oslo"))).alias("jobs")))
    return body.select(F.concat("name", F.lit(".example")).alias("site"), "place", F.lit("site_link").alias("origin"), F.concat(F.lit("u"), "place").alias("url"), F.when(F.col("place") % 2 == 0, as_list).otherwise(as_struct).alias("body"))


def job_rows(s, d):
    return P.job_rows(feeds(s, d)).select("site", "title", "location", "team", "url", "text")


def job_listing(s, d):
    return P.job_listing(P.job_rows(feeds(s, d)), SIGNALS, 30).select("site", "title", "role", "terms", "place", "more")


def job_mentions(s, d):
    return P.job_mentions(P.job_rows(feeds(s, d)))


def pick_feed(s, d):
    none = F.when(F.col("place") == 0, F.lit('{"jobs": []}')).otherwise(F.col("body"))
    both = feeds(s, d).withColumn("body", F.when(F.length("site") == 12, none).otherwise(F.col("body"))).unionByName(feeds(s, d).withColumn("place", F.col("place") + 1000))
    return P.pick_feed(both).select("site", "place", "jobs")


def site_summary(s, d):
    index = P.page_index(P.usable_pages(documents(s, d)), SIGNALS)
    return P.site_summary(index, documents(s, d).filter("order_key % 9 = 0").select("site", "url"))


#: Pending rows of a batch; the first arrival brings 50 rows of it at most, so the second one reaches it.
STREAM_CAP = 60


def stream_intake(s, d):
    """pages in two arrivals: what the first registers does not come again in the second, and a batch's cap and ranks go on."""
    rows, at = V.source_rows(s, d), scratch(s)
    none = s.createDataFrame([], "org_id string, domain string")
    for test in ("order_key % 2 = 0", "order_key % 2 = 1"):
        rows.filter(test).write.mode("append").parquet(f"{at}/in")
        source = s.readStream.schema(rows.schema).parquet(f"{at}/in")
        streams.stream_intake(source, f"{at}/out", f"{at}/check", none, Scope(), STREAM_CAP).awaitTermination()
    found = s.read.parquet(f"{at}/out/candidates")
    return found.select(F.col("epoch").cast("long").alias("epoch"), "batch", "order_key", "domain", "status", "source_rank")


def stream_attempts(s, d):
    at = scratch(s)
    rows = table(s, d, "events").selectExpr("CAST(user_id AS STRING) AS key", "event_id AS order_key", "event_type = 'view' AS ok")
    half = rows.agg(F.percentile_approx("order_key", 0.5)).first()[0] or 0
    for test in (f"order_key <= {half}", f"order_key > {half}"):
        rows.filter(test).write.mode("append").parquet(f"{at}/in")
        state = streams.stream_attempts(s.readStream.schema(rows.schema).parquet(f"{at}/in"), 2)
        write = lambda df, epoch: df.write.mode("overwrite").parquet(f"{at}/out/epoch={epoch}")
        state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(f"{at}/out").groupBy("key").agg(F.max_by(F.struct("attempts", "state"), "epoch").alias("x")).select("key", "x.*")


def stream_upsert(s, d):
    """Properties of every second domain, then of all: those that have come before find the records that they have made, and change nothing."""
    at = scratch(s)
    streams.create_snapshot(K.crm(s, d), f"{at}/crm", buckets=16)
    props = K._props(s, d).select("key", "reason", "props")
    for test in ("crc32(key) % 2 = 0", "true"):
        props.filter(test).write.mode("append").parquet(f"{at}/in")
        streams.stream_upsert(s.readStream.schema(props.schema).parquet(f"{at}/in"), f"{at}/crm", f"{at}/check").awaitTermination()
    return streams.latest_snapshot(s, f"{at}/crm").select("domain", "sourcing_qualification_status", "sourcing_account_stage", "sourcing_sourced_from", "numberofemployees")


QUERIES = {f.__name__: f for f in (
    page_text, page_names, refusal, site_status, robots_allowed, sitemap_locs, pick_urls, top_seeds, seed_urls, follow_links, usable_pages, page_index, dropped_files, reachable, find_boards, feed_urls, job_rows, job_listing, job_mentions, pick_feed,
    site_summary, stream_intake, stream_attempts, stream_upsert,
)}

HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)"
PAGES = f"v_pages AS (SELECT *, {V.sql_domain('url')} AS site, {HOST} AS host, {PATH} AS path, {PATH} || coalesce(nullif('?' || regexp_extract(url, '\\?([^#]*)', 1), '?'), '') AS place FROM pages)"
WORD = lambda words: f"(?i)(?:^|[-_/])(?:{words})(?:[-_/]|$)"
DENY = "|".join([*P.DENY, "/13"])
PICKED = PAGES + f", v_pick AS (SELECT * FROM v_pages WHERE regexp_matches(path, '{WORD('en|fr|25')}') AND NOT regexp_matches(url, '{DENY}'))"
SEEDS = lambda rows: f"SELECT site, url, row_number() OVER (PARTITION BY site ORDER BY CASE WHEN regexp_matches(path, '{WORD('fr|es')}') THEN 0 WHEN regexp_matches(path, '{WORD('en')}') THEN 1 ELSE 2 END, length(path), url) AS rank FROM (SELECT DISTINCT site, url, path FROM {rows})"
USABLE = """v_docs AS (SELECT source AS site, doc_id AS order_key, 'https://' || source || '.example/' || CASE WHEN doc_id % 3 = 0 THEN 'p' || doc_id // 180 ELSE doc_id::VARCHAR END AS url, left(replace(trim(split_part(text, '.', 1), chr(10) || ' '), '|', '/'), 90) AS title, coalesce(text, '') AS text, sha1(trim(coalesce(text, ''), chr(10) || ' ')) AS hash,
    len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS words, 'f' || doc_id % 700 AS file FROM documents),
    v_good AS (SELECT * FROM v_docs WHERE NOT regexp_matches(title, '(?i)page not found|404|not found') AND NOT regexp_matches(left(text, 600), '""" + P.SOFT_404.replace("'", "''") + """') AND words >= 60),
    v_ord AS (SELECT site, order_key, 'u' || url AS u, 'h' || hash AS h, row_number() OVER (PARTITION BY site ORDER BY order_key) AS n FROM v_good),
    v_walk AS (  -- page by page, with the keys of those that stay
        SELECT site, 0::BIGINT AS n, NULL::BIGINT AS order_key, []::VARCHAR[] AS keys, false AS stays FROM (SELECT DISTINCT site FROM v_good)
        UNION ALL SELECT site, n, order_key, CASE WHEN fits THEN keys || [u, h] ELSE keys END, fits FROM (
            SELECT o.site, o.n, o.order_key, u, h, keys, NOT list_contains(keys, u) AND NOT list_contains(keys, h) AS fits FROM v_walk w JOIN v_ord o ON o.site = w.site AND o.n = w.n + 1)),
    v_use AS (SELECT g.* FROM v_good g JOIN v_walk w USING (site, order_key) WHERE w.stays),
    v_index AS (SELECT site, order_key, words, CASE WHEN terms = '' THEN '-' ELSE terms END AS terms FROM (SELECT *, array_to_string(list_sort(list_intersect(string_split_regex(lower(text), '[^\\pL\\pN\\pM_]+'), ['the', 'que', 'und', 'de'])), ',') AS terms FROM v_use))"""
JOBS = """v_jobs AS (SELECT source || '.example' AS site, source, doc_id, doc_id // 1000 AS place, CASE WHEN doc_id % 4 = 0 THEN 'Role ' ELSE 'Job ' END || doc_id AS title, CASE WHEN doc_id // 1000 % 2 = 0 THEN 'Lyon' ELSE 'Oslo' END AS location, lang || ', all' AS team, 'http://j/' || doc_id AS url,
    'Work & play at ' || CASE WHEN doc_id % 5 = 0 THEN source ELSE 'us' END || CASE WHEN doc_id % 6 = 0 THEN ' the que' ELSE '' END AS text FROM documents)"""
BOARDS = """v_boards AS (SELECT source AS site, CASE doc_id % 3 WHEN 0 THEN 'lever' WHEN 1 THEN 'greenhouse' ELSE 'other' END AS kind, CASE doc_id % 3 WHEN 0 THEN 'slug' || doc_id % 7 WHEN 1 THEN 'g' || doc_id % 5 ELSE 'icims.com' END AS slug, min(doc_id) AS k FROM documents WHERE doc_id % 3 <> 2 OR length(source) = 4 GROUP BY 1, 2, 3),
    v_slugs AS (SELECT site, kind, slug, row_number() OVER (PARTITION BY site, kind ORDER BY k, slug) AS place FROM v_boards)"""

def _values(pairs: dict) -> str:
    return ", ".join("(%s, '%s')" % (repr(k) if isinstance(k, int) else f"'{k}'", v.replace("'", "''")) for k, v in pairs.items())


# What html.unescape replaces: names, the longest that a reference begins with; and numbers that stand for another character than their own, or for none.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
NUMBERS = {n: c for n in (*range(160), *range(0xFDD0, 0xFDF0), *(p << 16 | e for p in range(17) for e in (0xFFFE, 0xFFFF))) if (c := html.unescape(f"&#{n};")) != chr(n)}
UNESCAPED = f"""v_refs AS (SELECT DISTINCT unnest(regexp_extract_all(x, '{REFERENCE}')) AS ref FROM (SELECT title AS x FROM t UNION ALL SELECT body FROM t)),
        v_names(name, char) AS (VALUES {_values(html.entities.html5)}), v_odd(n, char) AS (VALUES {_values(NUMBERS)}),
        v_digits AS (SELECT ref, ref[3] IN ('x', 'X') AS hex, ltrim(rtrim(ref, ';'), '&#xX0') AS digits FROM v_refs WHERE ref[2] = '#'),
        v_numbers AS (SELECT ref, CASE WHEN digits = '' THEN 0 WHEN length(digits) > 8 THEN 1114112 WHEN hex THEN ('0x' || digits)::BIGINT ELSE digits::BIGINT END AS n FROM v_digits),
        v_chars AS (SELECT ref, CASE WHEN v_odd.n IS NOT NULL THEN v_odd.char WHEN v_numbers.n BETWEEN 55296 AND 57343 OR v_numbers.n > 1114111 THEN chr(65533) ELSE chr(v_numbers.n::INT) END AS char FROM v_numbers LEFT JOIN v_odd USING (n)
            UNION ALL SELECT ref, arg_max(char || substr(ref, length(name) + 2), length(name)) FROM v_refs JOIN v_names ON starts_with(substr(ref, 2), name) GROUP BY 1),
        v_map AS (SELECT map(list(ref), list(char)) AS chars FROM v_chars)"""
WHITE = r"[\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _folded(x: str) -> str:
    """SQL of x with its references replaced, each once, and its white space folded."""
    parts = f"list_transform(regexp_extract_all({x}, '{REFERENCE}|[^&]+|&'), lambda p: CASE WHEN p[1] = '&' THEN coalesce(chars[p], p) ELSE p END)"
    return f"CASE WHEN {x} IS NOT NULL THEN trim(regexp_replace(coalesce(array_to_string({parts}, ''), ''), '{WHITE}', ' ', 'g')) END"


SQL = {
    "page_text": rf"""WITH t AS (SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, regexp_replace(regexp_replace(html,
            '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>|<title\b.*?</title>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS body FROM pages), {UNESCAPED}
        SELECT page_id, {_folded("title")} AS title, {_folded("body")} AS markdown FROM t, v_map""",
    "page_names": """WITH u AS (SELECT page_id, url || repeat('/section', (page_id % 15)::INT) AS url FROM pages), n AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://([^?#]+)', 1), '^/+|/+$', '', 'g'), '[^A-Za-z0-9._-]+', '-', 'g'), '-') AS name FROM u)
        SELECT page_id, CASE WHEN length(name) > 90 THEN left(name, 80) || '-' || left(sha1(url), 8) ELSE name END AS name FROM n""",
    "refusal": "SELECT page_id AS n, CASE page_id % 6 WHEN 5 THEN 'no answer' WHEN 1 THEN 'http 401' WHEN 3 THEN 'http 503' ELSE CASE WHEN page_id % 10 = 0 THEN 'bot challenge' END END AS reason FROM pages",
    "site_status": f"""WITH {PAGES}, w AS (SELECT site, page_id AS n, page_id % 4 <> 0 AS live, page_id % 4 <> 0 AND page_id % 3 <> 0 AS tried, CASE page_id % 6 WHEN 5 THEN 'no answer' WHEN 1 THEN 'http 401' WHEN 3 THEN 'http 503' ELSE CASE WHEN page_id % 10 = 0 THEN 'bot challenge' END END AS why FROM v_pages WHERE site IS NOT NULL),
        g AS (SELECT site, bool_or(live) AS live, bool_or(tried) AS tried, coalesce(bool_or(tried AND why IS NULL), false) AS good, arg_max(coalesce(why, ''), n) FILTER (tried) AS why FROM w GROUP BY 1)
        SELECT site, CASE WHEN NOT live THEN 'no_host' WHEN NOT tried THEN 'disallowed' WHEN good THEN 'ok' WHEN why = 'no answer' THEN 'unreachable' ELSE 'blocked' END AS state, CASE WHEN NOT live THEN 'no host of the domain resolves' WHEN NOT tried THEN 'robots.txt does not allow the homepage' WHEN good THEN '' ELSE why END AS reason FROM g""",
    "robots_allowed": f"""WITH {PAGES} SELECT page_id, CASE WHEN length(host) % 7 = 6 THEN false WHEN length(host) % 5 = 1 THEN true WHEN length(host) % 5 IN (2, 4) THEN false WHEN starts_with(place, '/en/25') THEN true WHEN starts_with(place, '/en/2') OR ends_with(place, '5') THEN false ELSE true END AS allowed FROM v_pages""",
    "sitemap_locs": f"WITH {PAGES} SELECT site, url FROM v_pages",
    "pick_urls": f"WITH {PICKED} SELECT page_id, url FROM v_pick",
    "top_seeds": f"WITH {PAGES} SELECT * FROM ({SEEDS('v_pages')}) WHERE rank <= 3",
    "seed_urls": f"""WITH {PICKED}, s AS (SELECT DISTINCT site FROM v_pages), e AS (SELECT site, unnest(['https://' || site || '/', 'https://www.' || site || '/', 'https://m.' || site || '/', 'https://' || site || '/en', 'https://' || site || '/about']) AS url FROM s UNION SELECT site, url FROM ({SEEDS('v_pick')}) WHERE rank <= 3)
        SELECT site, url FROM e WHERE {HOST} IN (SELECT host FROM v_pages)""",
    "follow_links": f"""WITH h AS (SELECT DISTINCT url, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS base, regexp_replace(unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)), '#.*$', '') AS href FROM pages)
        SELECT DISTINCT url, base || href AS link FROM h WHERE starts_with(href, '/') AND regexp_matches(base || href, '/(?:[^/]*(?:^|[-_]))?(?:the|to|de|und)(?:(?:[-_])[^/]*)?(?:/|$)') AND NOT regexp_matches(base || href, '{"|".join(P.DENY)}')""",
    "usable_pages": f"WITH RECURSIVE {USABLE} SELECT site, order_key, url, words::INT AS words FROM v_use",
    "page_index": f"WITH RECURSIVE {USABLE} SELECT site, order_key, terms, words::INT AS words, row_number() OVER (PARTITION BY site ORDER BY (terms = '-')::INT, words DESC, order_key) AS place FROM v_index",
    "dropped_files": f"WITH RECURSIVE {USABLE} SELECT DISTINCT site, file FROM v_docs WHERE (site, file) NOT IN (SELECT (site, file) FROM v_use)",
    "reachable": """WITH p AS (SELECT regexp_extract(html, 'lang="([a-z]+)"', 1) AS site, page_id FROM pages), e AS (SELECT site, 'p' || page_id AS url, 'p' || unnest([page_id + 1, page_id * 2]) AS link FROM p),
        a AS (SELECT DISTINCT site, url FROM e WHERE url LIKE '%7'), b AS (SELECT DISTINCT site, link AS url FROM e JOIN a USING (site, url) EXCEPT SELECT * FROM a), c AS (SELECT DISTINCT site, link AS url FROM e JOIN b USING (site, url) EXCEPT SELECT * FROM a EXCEPT SELECT * FROM b),
        f AS (SELECT *, 0 AS depth FROM a UNION ALL SELECT *, 1 FROM b UNION ALL SELECT *, 2 FROM c) SELECT site, url, depth FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY depth, url) AS n FROM f) WHERE n <= 50""",
    "find_boards": f"WITH {BOARDS} SELECT site, kind, slug, place FROM v_slugs",
    "feed_urls": f"""WITH {BOARDS}, l AS (SELECT site || '-x.example' AS site, 'site_link' AS origin, CASE kind WHEN 'greenhouse' THEN 'https://boards-api.greenhouse.io/v1/boards/' || slug || '/jobs?content=true' ELSE 'https://api.lever.co/v0/postings/' || slug || '?mode=json' END AS url, CASE kind WHEN 'greenhouse' THEN 1 ELSE 2 END AS b, place AS c, 0 AS a FROM v_slugs WHERE kind <> 'other'),
        s AS (SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT site FROM v_slugs WHERE kind = 'other')), g AS (SELECT source || '-x.example' AS site, unnest([source || '-x', source || 'x']) AS slug, unnest([0, 1]) AS i FROM s),
        w AS (SELECT site, 'guessed' AS origin, unnest(['https://api.lever.co/v0/postings/' || slug || '?mode=json', 'https://boards-api.greenhouse.io/v1/boards/' || slug || '/jobs?content=true', 'https://api.ashbyhq.com/posting-api/job-board/' || slug]) AS url, i AS b, unnest([0, 1, 2]) AS c, 1 AS a FROM g)
        SELECT site, origin, url, row_number() OVER (PARTITION BY site ORDER BY a, b, c, url) AS place FROM (SELECT * FROM l UNION ALL BY NAME SELECT * FROM w)""",
    "job_rows": f"WITH {JOBS} SELECT site, title, location, team, url, text FROM v_jobs",
    "job_listing": f"""WITH {JOBS}, t AS (SELECT site, title, starts_with(title, 'Role') AS role, CASE WHEN doc_id % 6 = 0 THEN 'que,the' ELSE '-' END AS terms, doc_id FROM v_jobs), r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY (NOT role)::INT, (terms = '-')::INT, title) AS place, greatest(0, count(*) OVER (PARTITION BY site) - 30) AS more FROM t)
        SELECT site, title, role, terms, place, more FROM r WHERE place <= 30""",
    "job_mentions": f"WITH {JOBS} SELECT site, count(*) AS postings, count(*) FILTER (doc_id % 5 = 0) AS mentions FROM v_jobs GROUP BY 1",
    "pick_feed": f"WITH {JOBS}, n AS (SELECT site, place, count(*) AS jobs FROM v_jobs GROUP BY 1, 2), b AS (SELECT * FROM n WHERE NOT (length(site) = 12 AND place = 0) UNION ALL SELECT site, place + 1000, jobs FROM n) SELECT site, min(place) AS place, arg_min(jobs, place)::INT AS jobs FROM b GROUP BY 1",
    "site_summary": f"WITH RECURSIVE {USABLE}, i AS (SELECT site, count(*) AS pages, count(*) FILTER (terms <> '-') AS with_terms FROM v_index GROUP BY 1), f AS (SELECT source AS site, count(*) AS refused FROM documents WHERE doc_id % 9 = 0 GROUP BY 1) SELECT site, pages, with_terms, coalesce(refused, 0) AS refused FROM i LEFT JOIN f USING (site)",
    "stream_intake": f"""WITH {FIRST}, h AS (SELECT * FROM (SELECT *, order_key % 2 AS epoch, row_number() OVER (PARTITION BY batch, key, order_key % 2 ORDER BY order_key) AS m FROM v_key) WHERE m = 1 AND key <> 'name:'),
        a AS (SELECT * FROM (SELECT *, count(domain) OVER (PARTITION BY batch ORDER BY order_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, row_number() OVER (PARTITION BY batch ORDER BY order_key) AS source_rank FROM h WHERE epoch = 0)
            WHERE before < {STREAM_CAP}),
        c AS (SELECT batch, count(domain) AS pending, count(*) AS ranked FROM a GROUP BY 1),
        n AS (SELECT * FROM h WHERE epoch = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.domain = h.domain OR a.domain IS NULL AND h.domain IS NULL AND a.batch = h.batch AND a.key = h.key)),
        b AS (SELECT * FROM (SELECT n.*, coalesce(pending, 0) + count(domain) OVER (PARTITION BY batch ORDER BY order_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
            coalesce(ranked, 0) + row_number() OVER (PARTITION BY batch ORDER BY order_key) AS source_rank FROM n LEFT JOIN c USING (batch)) WHERE before < {STREAM_CAP})
        SELECT epoch, batch, order_key, domain, CASE WHEN domain IS NULL THEN 'skipped_prefilter' ELSE 'pending' END AS status, source_rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""",
    "stream_attempts": """WITH e AS (SELECT user_id::VARCHAR AS key, event_type = 'view' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events), f AS (SELECT key, min(n) FILTER (ok) AS hit, count(*) AS c FROM e GROUP BY 1)
        SELECT key, CASE WHEN hit <= 2 THEN hit ELSE least(c, 2) END AS attempts, CASE WHEN hit <= 2 THEN 'done' WHEN c >= 2 THEN 'given_up' ELSE 'error' END AS state FROM f""",
    "stream_upsert": K.SQL["merge_crm"],
}
