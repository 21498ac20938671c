"""Stored pages of company sites: text, refusals, robots rules, addresses to visit, usable pages, topic index and job feeds."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..sources.tables import staged
from .components import contracted

#: Answers and page marks that mean a refusal.
BLOCK_STATUSES = (401, 403, 407, 429, 503)
BLOCK_MARKERS = ("cf-chl", "challenge-platform", "Just a moment...", "Attention Required! | Cloudflare", "cf-browser-verification", "_Incapsula_Resource", "px-captcha")
#: Addresses that are never content.
DENY = (r"\?", "/tag/", "/tags/", "/category/", r"/page/\d+", "/author/", r"\.(pdf|jpg|jpeg|png|gif|svg|zip|mp4|css|js)$", "/login", "/signin", "/signup", "/cart", "/checkout", "/wp-json/", "/feed/?$", "/rss", "/search")
#: Titles and openings of pages that are not there.
NOT_FOUND = "(?i)page not found|404|not found"
SOFT_404 = r"(?i)page (?:isn't|is not|doesn't|does not|can't be|cannot be) (?:around|exist|found)|page not found|we can't find (?:that|this|the) page|nothing (?:was )?found here|error 404"
#: Links to job boards, other application systems, and path parts that are no company.
BOARDS = {
    "greenhouse": r"(?i)(?:boards|job-boards)(?:\.eu)?\.greenhouse\.io/(?:embed/job_board(?:/js)?\?for=)?([A-Za-z0-9_-]+)", "lever": r"(?i)jobs\.(?:eu\.)?lever\.co/([A-Za-z0-9_-]+)", "ashby": r"(?i)jobs\.ashbyhq\.com/([A-Za-z0-9_.%-]+)",
}
OTHER_SYSTEMS = (
    r"(?i)myworkdayjobs\.com|icims\.com|smartrecruiters\.com|workable\.com|bamboohr\.com|jobvite\.com|successfactors|taleo\.net|recruitee\.com|breezy\.hr|rippling-ats|teamtailor\.com|dayforcehcm\.com|ultipro\.com|paylocity\.com"
)
NOT_SLUGS = ("embed", "job_board", "js", "v1", "boards", "api", "jobs")
FEEDS = {"greenhouse": "https://boards-api.greenhouse.io/v1/boards/{}/jobs?content=true", "lever": "https://api.lever.co/v0/postings/{}?mode=json", "ashby": "https://api.ashbyhq.com/posting-api/job-board/{}"}
MIN_WORDS, MAX_JOBS, MAX_BODY = 60, 150, 20_000


@dataclass(frozen=True)
class Signals:
    """What to look for: terms are pattern fragments, tokens and paths plain words."""

    topic_terms: Sequence[str] = ()
    role_terms: Sequence[str] = ()
    path_tokens: Sequence[str] = ()
    priority_paths: Sequence[str] = ()
    secondary_paths: Sequence[str] = ()
    seed_subdomains: Sequence[str] = ()
    seed_paths: Sequence[str] = ()
    skip: Sequence[str] = ()
    extra_allow: Sequence[str] = ()
    extra_pick: Sequence[str] = ()
    deny: Sequence[str] = field(default=DENY)

    @staticmethod
    def words(tokens: Sequence[str]) -> str:
        return "|".join(rf"\Q{t}\E" for t in tokens)

    # How a word stands in a path.
    def in_path(self, tokens: Sequence[str], more: Sequence[str] = ()) -> str:
        return "(?iU)" + "|".join([f"(?:^|[-_/])(?:{self.words(tokens)})(?:[-_/]|$)", *more])

    @property
    def allow(self) -> str:
        return "|".join([f"/(?:[^/]*(?:^|[-_]))?(?:{self.words(self.path_tokens)})(?:(?:[-_])[^/]*)?(?:/|$)", *self.extra_allow])

    @property
    def denied(self) -> str:
        return "|".join([*self.deny, *self.skip])

    def any_of(self, terms: Sequence[str]) -> str:
        return rf"(?iU)\b(?:{'|'.join(terms)})\b"


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    """Character references replaced."""
    return text.map(html.unescape, na_action="ignore")


def page_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """pages with title and markdown: the text without comments, scripts, styles, navigation and tags, white space folded."""
    body = F.regexp_replace(column, r"(?is)<!--.*?-->|<(script|style|nav|title)\b.*?</\1>", " ")
    body = F.regexp_replace(body, "<[^>]+>", " ")
    title = F.regexp_extract(column, r"(?is)<title[^>]*>(.*?)</title>", 1)
    fold = lambda c: C.strip(F.regexp_replace(c, r"(?U)\s+", " "))
    return pages.withColumn("title", fold(unescape(title))).withColumn("markdown", fold(unescape(body)))


def refusal(status: Column | str, body: Column | str) -> Column:
    """Why an answer counts as a refusal, or null."""
    status, body = C.as_col(status), F.left(F.coalesce(C.as_col(body).cast("string"), F.lit("")), F.lit(MAX_BODY))
    marked = F.exists(F.array(*[F.lit(m) for m in BLOCK_MARKERS]), lambda m: F.contains(body, m))
    return F.when(status.isNull(), "no answer").when(status.isin(*BLOCK_STATUSES), F.concat(F.lit("http "), status.cast("string"))).when(marked, "bot challenge")


def site_status(probes: DataFrame) -> DataFrame:
    """probes (site, n, live, allowed, status, body), one per home address in order, to site, state and reason: the first good answer decides, else the last try."""
    tried = F.col("live") & F.col("allowed")
    p = probes.withColumn("refused", F.when(tried, refusal("status", "body"))).withColumn("tried", tried)
    s = p.groupBy("site").agg(
        F.bool_or("live").alias("live"), F.bool_or("tried").alias("tried"), F.bool_or(tried & F.col("refused").isNull()).alias("good"),
        F.max_by(F.struct("refused"), F.when(tried, F.col("n"))).alias("last"),
    )
    why = F.col("last.refused")
    state = F.when(~F.col("live"), "no_host").when(~F.col("tried"), "disallowed").when(F.col("good"), "ok").when(why == "no answer", "unreachable").otherwise("blocked")
    reason = F.when(~F.col("live"), "no host of the domain resolves").when(~F.col("tried"), "robots.txt does not allow the homepage").when(F.col("good"), "").otherwise(why)
    return s.select("site", state.alias("state"), reason.alias("reason"))


def robots_rules(robots: DataFrame, agent: str) -> DataFrame:
    """robots (host, status, body) to rules for the agent: host, allow, pattern, length. Lines of an agent's own groups win over those of *."""
    token = re.match("[a-z_-]*", agent.lower()).group()
    deny_all = F.col("status").isNull() | F.col("status").isin(401, 403) | (F.col("status") >= 500)
    text = F.when(deny_all, F.lit("User-agent: *\nDisallow: /")).when(F.col("status") == 200, F.coalesce(F.col("body").cast("string"), F.lit(""))).otherwise("")
    lines = robots.select("host", F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("n", "line")).withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    lines = lines.select("host", "n", F.lower(F.trim(F.substring_index("line", ":", 1))).alias("key"), F.trim(F.regexp_replace("line", "^[^:]*:?", "")).alias("value")).filter("key IN ('user-agent', 'allow', 'disallow')")
    order = Window.partitionBy("host").orderBy("n")
    starts = (F.col("key") == "user-agent") & (F.coalesce(F.lag("key").over(order), F.lit("")) != "user-agent")
    lines = lines.withColumn("_starts", starts.cast("int")).withColumn("group", F.sum("_starts").over(order))
    agents = lines.filter("key = 'user-agent'").select("host", "group", F.regexp_extract(F.lower("value"), r"^(\*|[a-z_-]*)", 1).alias("who")).filter(F.col("who").isin(token, "*")).withColumn("own", (F.col("who") == token).cast("int"))
    best = agents.groupBy("host").agg(F.max("own").alias("own"))
    groups = agents.join(best, ["host", "own"], "left_semi").select("host", "group").distinct()
    rules = lines.filter("key <> 'user-agent' AND value <> ''").join(groups, ["host", "group"])
    quoted = F.concat(F.lit(r"^\Q"), F.replace(F.regexp_replace("value", r"\$$", ""), F.lit("*"), F.lit(r"\E.*\Q")), F.lit(r"\E"), F.when(F.endswith("value", F.lit("$")), "$").otherwise(""))
    prefix = F.substring_index(F.regexp_replace("value", r"\$$", ""), "*", 1)
    plain = ~F.contains("value", F.lit("*")) & ~F.endswith("value", F.lit("$"))
    return rules.select("host", (F.col("key") == "allow").alias("allow"), quoted.alias("pattern"), F.length("value").alias("length"), prefix.alias("prefix"), plain.alias("plain"))


def longest_rules(asked: DataFrame, rules: DataFrame) -> DataFrame:
    """asked (host, _place), distinct, to (host, _place, _best) with length and allow of the longest rule that matches; places without one are left out.

    A place is looked up by its own beginnings, of the lengths that the host's rules begin with: a level of a trie each, as a hash join. So its work does not
    grow with the host's rules, but for those with a wildcard or an end mark behind a beginning that it has. Spark splits a host with very many places.
    """
    first = rules.groupBy("host", "prefix", "plain", F.when(~F.col("plain"), F.col("pattern")).alias("pattern")).agg(F.max(F.struct("length", "allow")).alias("rule"))
    levels = rules.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("_levels"))
    deep = F.filter("_levels", lambda n: n <= F.length("_place"))
    begun = asked.join(levels, "host").select("host", "_place", F.explode(deep).alias("_n")).withColumn("prefix", F.expr("substring(_place, 1, _n)")).drop("_n")
    hits = begun.join(first, ["host", "prefix"]).filter(F.expr("plain OR _place RLIKE pattern"))
    return hits.groupBy("host", "_place").agg(F.max("rule").alias("_best"))


def robots_allowed(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """urls (url) with allowed, by the longest rule that matches path and query (allow on a tie); a host without an answer allows nothing."""
    u = urls.withColumn("host", F.try_parse_url("url", F.lit("HOST")))
    path, query = C.blank_to_null(F.try_parse_url("url", F.lit("PATH"))), F.try_parse_url("url", F.lit("QUERY"))
    u = u.withColumn("_place", F.concat(F.coalesce(path, F.lit("/")), F.coalesce(F.concat(F.lit("?"), query), F.lit(""))))
    asked = u.select("host", "_place").filter("host IS NOT NULL").distinct()
    verdict = longest_rules(asked, robots_rules(robots, agent))
    known = robots.select("host").distinct().withColumn("_known", F.lit(True))
    out = u.join(verdict, ["host", "_place"], "left").join(known, "host", "left")
    allowed = F.when(F.col("_known").isNull(), False).when(F.col("_place") == "/robots.txt", True).otherwise(F.coalesce(F.col("_best.allow"), F.lit(True)))
    return out.withColumn("allowed", allowed).drop("_place", "_best", "_known", "host")


def sitemap_locs(sitemaps: DataFrame, column: str = "body") -> DataFrame:
    """sitemaps with one row per address, as url."""
    found = F.regexp_extract_all(F.col(column).cast("string"), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    return sitemaps.select(*[c for c in sitemaps.columns if c != column], F.explode(found).alias("url"))


def _path(url: str = "url") -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def pick_urls(df: DataFrame, sig: Signals) -> DataFrame:
    """Addresses whose path has a token as a word, and that no deny pattern (in the case given) matches."""
    return df.filter(_path().rlike(sig.in_path(sig.path_tokens, sig.extra_pick)) & ~F.col("url").rlike(sig.denied))


def top_seeds(df: DataFrame, sig: Signals, k: int) -> DataFrame:
    """df (site, url) with rank: the first k of each site by kind of path, then length, then address."""
    kind = F.when(_path().rlike(sig.in_path(sig.priority_paths)), 0).when(_path().rlike(sig.in_path(sig.secondary_paths)), 1).otherwise(2)
    place = Window.partitionBy("site").orderBy(kind, F.length(_path()), "url")
    return df.select("site", "url").distinct().withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def seed_urls(sites: DataFrame, hosts: DataFrame, sitemap: DataFrame, sig: Signals, k: int, robots: DataFrame | None = None, agent: str = "*") -> DataFrame:
    """(site, url): home, www, live subdomains, fixed paths and the k best of the sitemap, on live hosts (host) and allowed."""
    fixed = [F.concat(F.lit("https://"), "site", F.lit("/")), F.concat(F.lit("https://www."), "site", F.lit("/"))]
    fixed += [F.concat(F.lit(f"https://{s}."), "site", F.lit("/")) for s in sig.seed_subdomains] + [F.concat(F.lit("https://"), "site", F.lit(f"/{p}")) for p in sig.seed_paths]
    every = sites.select("site", F.explode(F.array(*fixed)).alias("url")).unionByName(top_seeds(sitemap, sig, k).select("site", "url")).distinct()
    live = every.withColumn("_h", F.try_parse_url("url", F.lit("HOST"))).join(hosts.select(F.col("host").alias("_h")).distinct(), "_h", "left_semi").drop("_h")
    return live if robots is None else robots_allowed(live, robots, agent).filter("allowed").drop("allowed")


def follow_links(pages: DataFrame, sig: Signals, hosts: DataFrame | None = None, column: str = "html") -> DataFrame:
    """(url, link): absolute addresses of a page's links that an allow pattern and no deny pattern matches, on live hosts."""
    href = F.explode(F.array_distinct(F.regexp_extract_all(column, F.lit(r"""(?i)<a\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""), F.lit(1)))).alias("href")
    links = pages.select("url", href).withColumn("href", F.regexp_replace("href", "#.*$", "")).filter("href <> ''")
    base = F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1)
    folder = F.regexp_extract("url", r"^([a-z]+://[^/?#]+(?:/[^?#]*/)?)", 1)
    absolute = (
        F.when(F.col("href").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("href")).when(F.startswith("href", F.lit("//")), F.concat(F.lit("https:"), "href"))
        .when(F.startswith("href", F.lit("/")), F.concat(base, "href")).otherwise(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), "href"))
    )
    out = links.select("url", absolute.alias("link")).filter(F.col("link").rlike("^https?://") & F.col("link").rlike(sig.allow) & ~F.col("link").rlike(sig.denied)).distinct()
    return out if hosts is None else out.withColumn("_h", F.try_parse_url("link", F.lit("HOST"))).join(hosts.select(F.col("host").alias("_h")).distinct(), "_h", "left_semi").drop("_h")


def word_count(c: Column | str) -> Column:
    return F.regexp_count(C.as_col(c), F.lit(r"(?U)\S+"))


def prepared(pages: DataFrame) -> DataFrame:
    """pages (site, order_key, url, title, markdown) with folded address and title, hash and words, and whether the page counts at all."""
    out = pages.withColumns({
        "url": F.replace("url", F.lit(":443/"), F.lit("/")), "title": F.left(F.replace(C.strip(F.coalesce("title", F.lit(""))), F.lit("|"), F.lit("/")), F.lit(90)),
        "_text": F.coalesce("markdown", F.lit("")),
    })
    out = out.withColumns({"hash": F.sha1(C.strip("_text")), "words": word_count("_text")})
    return out.withColumn("good", ~F.col("title").rlike(NOT_FOUND) & ~F.left("_text", F.lit(600)).rlike(SOFT_404) & (F.col("words") >= MIN_WORDS)).drop("_text")


#: Rounds of grouped minima before what is left is walked through.
MINIMA = 2


def first_of_both(rows: DataFrame) -> DataFrame:
    """Of rows (site, order_key, url, hash) in order: those with neither address nor hash of an earlier row that stays.

    In a round of grouped minima, rows that come first under both keys stay, and later rows that share a key with one that stays go. That settles
    nearly all rows in two rounds. What is left, long chains of shared keys, is cut into connected components, and each is walked through in order.
    """
    kept, open_ = None, rows.select("site", "order_key", "url", "hash")
    for _ in range(MINIMA):
        first = lambda key: open_.groupBy("site", key).agg(F.min("order_key").alias(f"_{key}"))  # noqa: B023, E731
        marked = open_.join(first("url"), ["site", "url"]).join(first("hash"), ["site", "hash"])
        marked = staged(marked.withColumn("stays", (F.col("order_key") == F.col("_url")) & (F.col("order_key") == F.col("_hash"))), "pages")
        now = marked.filter("stays").select("site", "order_key", "url", "hash")
        kept = now if kept is None else kept.unionByName(now)
        gone = lambda key: now.select("site", key).distinct()  # noqa: B023, E731
        open_ = staged(marked.filter("NOT stays").select("site", "order_key", "url", "hash").join(gone("url"), ["site", "url"], "left_anti").join(gone("hash"), ["site", "hash"], "left_anti"), "pages")
        if open_.isEmpty():
            return kept.select("site", "order_key")
    return kept.select("site", "order_key").unionByName(walked_through(open_))


def walked_through(rows: DataFrame) -> DataFrame:
    """(site, order_key) of the rows (site, order_key, url, hash) that stay, by a walk in order through each connected component of rows that share keys.

    Components that the contraction does not finish are walked through together, site by site. A task streams through its rows and
    holds the keys that stay of one component.
    """
    own = staged(rows.withColumn("node", F.monotonically_increasing_id()), "rows")
    star = lambda key: own.join(own.groupBy("site", key).agg(F.min("node").alias("b")), ["site", key]).select(F.col("node").alias("a"), "b")
    labels = contracted(star("url").unionByName(star("hash")))
    # A row that shares no key with another has no edge, and is a component by itself.
    grouped = own.join(labels, "node", "left").withColumn("_group", F.when(F.col("label").isNull(), F.col("node")).when(F.col("whole"), F.col("label")).otherwise(-1))
    order = ["site", "_group", "order_key"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_, urls, hashes = None, set(), set()
        for batch in batches:
            stays = []
            for site, group, url, hash_ in zip(*[batch.column(c).to_pylist() for c in ("site", "_group", "url", "hash")], strict=True):
                if own_ != (site, group):
                    own_, urls, hashes = (site, group), set(), set()
                stays.append(url not in urls and hash_ not in hashes)
                if stays[-1]:
                    urls.add(url)
                    hashes.add(hash_)
            yield batch.select(["site", "order_key"]).filter(pa.array(stays, pa.bool_()))

    sorted_ = grouped.select(*order, "url", "hash").repartition("site", "_group").sortWithinPartitions(*order)
    return sorted_.mapInArrow(walk, rows.select("site", "order_key").schema)


def usable_pages(pages: DataFrame) -> DataFrame:
    """The pages that stay, prepared. Texts are hashed, counted and matched once; what that gives is stored without them."""
    made = ["url", "title", "hash", "words", "good"]
    good = staged(prepared(pages).filter("good").select("site", "order_key", *made), "good-pages")
    stays = good.join(first_of_both(good), ["site", "order_key"], "left_semi")
    return pages.drop(*made).join(stays, ["site", "order_key"])


def terms(c: Column | str, pattern: str) -> Column:
    """Distinct terms of a text, lower case, in order, joined by commas; - if there are none."""
    found = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(C.as_col(c), F.lit(pattern), F.lit(0)), F.lower)))
    return C.let(F.array_join(found, ","), lambda x: F.when(x == "", "-").otherwise(x))


def page_index(usable: DataFrame, sig: Signals) -> DataFrame:
    """usable with terms and place in the site's index: pages with terms first, then longer ones.

    A place is the pages of the groups (with or without terms, number of words) before, and then the place in the group, so that no site is one task's.
    """
    found = usable.select("site", "order_key", "words", terms("markdown", sig.any_of(sig.topic_terms)).alias("terms"))
    found = staged(found.withColumn("_none", (F.col("terms") == "-").cast("int")), "page-terms")
    group = ["site", "_none", "words"]
    before = Window.partitionBy("site").orderBy("_none", F.desc("words")).rowsBetween(Window.unboundedPreceding, -1)
    bases = found.groupBy(*group).agg(F.count("*").alias("_pages")).select(*group, F.coalesce(F.sum("_pages").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(*group).orderBy("order_key"))
    placed = found.withColumn("_inside", inside).join(bases, group).select("site", "order_key", "terms", (F.col("_base") + F.col("_inside")).cast("int").alias("place"))
    return usable.join(placed, ["site", "order_key"])


def dropped_files(pages: DataFrame, usable: DataFrame) -> DataFrame:
    """(site, file) of pages that do not stay, unless a page that stays has the file."""
    return pages.select("site", "file").filter("file IS NOT NULL").distinct().join(usable.select("site", "file").distinct(), ["site", "file"], "left_anti")


def reachable(seeds: DataFrame, links: DataFrame, depth: int = 2, cap: int = 50) -> DataFrame:
    """(site, url, depth) within `depth` links of the seeds over links (site, url, link), the first cap of each site by depth and address."""
    found = seeds.select("site", "url").distinct().withColumn("depth", F.lit(0))
    edge = found
    for step in range(1, depth + 1):
        edge = edge.join(links, ["site", "url"]).select("site", F.col("link").alias("url")).distinct().join(found.select("site", "url"), ["site", "url"], "left_anti").withColumn("depth", F.lit(step))
        found = found.unionByName(edge)
    place = Window.partitionBy("site").orderBy("depth", "url")
    return found.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= cap).drop("_n")


def find_boards(texts: DataFrame) -> DataFrame:
    """texts (site, order_key, text) to site, kind, slug and place in order of first sight; kind other holds other systems."""
    parts = []
    for kind, pattern in BOARDS.items():
        parts.append(texts.select("site", "order_key", F.lit(kind).alias("kind"), F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("pos", "slug")))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("slug", F.lower(C.strip("slug"))).filter((F.col("slug") != "") & ~F.col("slug").isin(*NOT_SLUGS))
    other = texts.select("site", "order_key", F.lit("other").alias("kind"), F.posexplode(F.regexp_extract_all("text", F.lit(OTHER_SYSTEMS), F.lit(0))).alias("pos", "slug")).withColumn("slug", F.lower("slug"))
    first = every.unionByName(other).groupBy("site", "kind", "slug").agg(F.min(F.struct("order_key", "pos")).alias("_at"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy("site", "kind").orderBy("_at", "slug"))).drop("_at")


def feed_urls(sites: DataFrame, boards: DataFrame) -> DataFrame:
    """(site, origin, url, place): feeds of the boards that a site links to, then, if it shows no other system, feeds guessed from its name."""
    kinds = list(FEEDS)
    address = lambda kind, slug: F.concat(F.lit(FEEDS[kind].split("{}")[0]), slug, F.lit(FEEDS[kind].split("{}")[1]))
    linked = boards.filter("kind <> 'other'")
    url = F.when(F.col("kind") == kinds[0], address(kinds[0], F.col("slug"))).when(F.col("kind") == kinds[1], address(kinds[1], F.col("slug"))).otherwise(address(kinds[2], F.col("slug")))
    kind_no = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    linked = linked.select("site", F.lit("site_link").alias("origin"), url.alias("url"), F.struct(F.lit(0).alias("a"), kind_no.cast("int").alias("b"), F.col("place").alias("c")).alias("at"))
    base = F.substring_index("site", ".", 1)
    names = F.when(F.contains(base, F.lit("-")), F.array(base, F.replace(base, F.lit("-"), F.lit("")))).otherwise(F.array(base))
    guess = sites.select("site").distinct().join(boards.filter("kind = 'other'").select("site").distinct(), "site", "left_anti").select("site", F.posexplode(names).alias("i", "slug"))
    three = F.array(*[address(k, F.col("slug")) for k in ("lever", "greenhouse", "ashby")])
    guess = guess.select("site", F.col("i"), F.posexplode(three).alias("j", "url")).select("site", F.lit("guessed").alias("origin"), "url", F.struct(F.lit(1).alias("a"), F.col("i").alias("b"), F.col("j").alias("c")).alias("at"))
    first = linked.unionByName(guess).groupBy("site", "url").agg(F.min(F.struct("at", "origin")).alias("f"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy("site").orderBy("f.at", "url"))).select("site", F.col("f.origin").alias("origin"), "url", "place")


def pick_feed(feeds: DataFrame) -> DataFrame:
    """feeds (site, place, url, origin, body) to the first of each site that has jobs."""
    full = feeds.withColumn("jobs", _count_jobs()).filter("jobs > 0")
    return full.groupBy("site").agg(F.min_by(F.struct("place", "url", "origin", "body", "jobs"), "place").alias("f")).select("site", "f.*")


def _jobs() -> Column:
    """The jobs of a feed body as an array of variants: a list, or the list under jobs."""
    parsed = F.try_parse_json(F.col("body"))
    return F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.try_variant_get(parsed, "$.jobs", "array<variant>"))


def _count_jobs() -> Column:
    return F.coalesce(F.size(_jobs()), F.lit(0))


def _plain(c: Column) -> Column:
    return C.strip(F.regexp_replace(unescape(F.regexp_replace(unescape(F.coalesce(c, F.lit(""))), "<[^>]+>", " ")), r"(?U)\s+", " "))


def job_rows(feeds: DataFrame) -> DataFrame:
    """One row per job: site, n, title, location, team, url and text; what is no object is dropped."""
    j = F.col("j")
    at = lambda *paths: F.coalesce(*[C.blank_to_null(F.try_variant_get(j, f"$.{p}", "string")) for p in paths], F.lit(""))
    rows = feeds.select("site", F.posexplode(_jobs()).alias("n", "j")).filter(F.startswith(F.schema_of_variant(j), F.lit("OBJECT")))
    place = F.when(F.startswith(F.schema_of_variant(F.try_variant_get(j, "$.location", "variant")), F.lit("OBJECT")), at("location.name")).otherwise(at("location", "categories.location"))
    many = F.array_join(F.transform(F.try_variant_get(j, "$.departments", "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, "$.name", "string"), F.lit(""))), ", ")
    return rows.select(
        "site", "n", _plain(at("title", "text")).alias("title"), _plain(place).alias("location"), _plain(F.coalesce(C.blank_to_null(at("categories.team", "department", "team")), many)).alias("team"),
        at("absolute_url", "hostedUrl", "jobUrl", "applyUrl").alias("url"), _plain(at("content", "descriptionPlain", "description", "descriptionHtml")).alias("text"),
    )


def job_listing(jobs: DataFrame, sig: Signals, cap: int = MAX_JOBS) -> DataFrame:
    """jobs with role, terms and place: roles first, then postings with terms, then by title; the first cap of each site, and how many more there are."""
    df = jobs.withColumns({"role": F.col("title").rlike(sig.any_of(sig.role_terms)), "terms": terms(F.concat_ws(" ", "title", "text"), sig.any_of(sig.topic_terms))})
    order = Window.partitionBy("site").orderBy((~F.col("role")).cast("int"), (F.col("terms") == "-").cast("int"), "title", "n")
    sizes = df.groupBy("site").agg(F.greatest(F.lit(0), F.count("*") - cap).alias("more"))
    return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= cap).join(sizes, "site")


def job_mentions(jobs: DataFrame) -> DataFrame:
    """Per site: postings, and those whose text or address names the site or the first part of its name."""
    base = F.lower(F.substring_index("site", ".", 1))
    named = F.contains(F.lower("text"), base) | F.contains(F.lower("url"), base)
    return jobs.groupBy("site").agg(F.count("*").alias("postings"), F.count_if(named).alias("mentions"))


def site_summary(index: DataFrame, refused: DataFrame) -> DataFrame:
    """Per site: usable pages, those with terms, and addresses that robots rules refuse (refused: site, url)."""
    pages = index.groupBy("site").agg(F.count("*").alias("pages"), F.count_if(F.col("terms") != "-").alias("with_terms"))
    return pages.join(refused.groupBy("site").agg(F.count("*").alias("refused")), "site", "left").na.fill(0, ["refused"])
