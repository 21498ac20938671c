import random
import re

import duckdb
from pyspark.sql import functions as F

from intake_spark.operators import pages as P
from intake_spark.plans import corpus

SIG = P.Signals(topic_terms=("distribution cent(?:er|re)s?", "food waste", "fresh (?:produce|food|departments?)"), role_terms=("replenishment", "category manag\\w+"), path_tokens=("stores", "careers", "locator"), priority_paths=("stores",), secondary_paths=("careers",), seed_subdomains=("news",), seed_paths=("about",), skip=("/coupons",))


def test_text_and_refusal(spark):
    page = "<html><head><title> A &amp; B </title><style>x{}</style></head><body><!-- no --><nav>menu</nav><p>One&nbsp;two<br>three</p><script>var x='</p>'</script></body></html>"
    r = P.page_text(spark.createDataFrame([(page,)], "html string")).first()
    assert (r.title, r.markdown) == ("A & B", "One two three")
    df = spark.createDataFrame([(200, "ok"), (403, "x"), (None, None), (200, "x" * 100 + "px-captcha"), (200, "y" * 20_000 + "px-captcha"), (404, "z")], "status int, body string")
    assert [r.w for r in df.select(P.refusal("status", "body").alias("w")).collect()] == [None, "http 403", "no answer", "bot challenge", None, None]


def test_text_has_the_rows_of_its_sql_on_odd_references(spark, tmp_path):
    pages = ["<title>a &amp;&amp</title>b", "&amplt;&notit;&notin;&eacute &EACUTE;", "&#0;&#128;&#xD800;&#x110000;&#99999999999;&#1;&#13;&#65&#x41;z", "<TITLE\nid=x>T &lt t</Title > <script>x<!-- </SCRIPT>y<nav a>n</NAV>", "a&nbsp;\u3000b\x0b\x85c", "&&amp;lt;&;", "", None]
    spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.title, r.markdown) for r in corpus.page_text(spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == {n: (title, text) for n, title, text in db.sql(corpus.SQL["page_text"]).fetchall()} and got[0] == ("a &&", "b") and len(got) == len(pages)


def test_robots(spark):
    body = "User-agent: bot\nDisallow: /stores\nAllow: /stores/open$\n\nUser-agent: *\nDisallow: /private\nDisallow: /*.pdf$\n"
    robots = spark.createDataFrame([("a.example", 200, body), ("b.example", 404, None), ("c.example", 403, None), ("d.example", 503, ""), ("e.example", None, None), ("f.example", 200, "")], "host string, status int, body string")
    urls = ["https://a.example/stores", "https://a.example/stores/open", "https://a.example/stores/open/x", "https://a.example/private", "https://b.example/x", "https://c.example/", "https://d.example/", "https://e.example/", "https://f.example/y", "https://g.example/", "https://a.example/q.pdf"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    allowed = lambda agent: {r.url: r.allowed for r in P.robots_allowed(df, robots, agent).collect()}
    assert [allowed("bot/1")[u] for u in urls] == [False, True, False, True, True, False, False, False, True, False, True]
    assert [allowed("someone")[u] for u in urls][:4] == [True, True, True, False] and allowed("someone")[urls[-1]] is False


def test_ranks_and_links(spark):
    urls = ["https://a/stores", "https://a/all/stores", "https://a/careers", "https://a/restores", "https://a/x/Careers/y", "https://a/stores?x=1", "https://a/coupons/stores"]
    df = spark.createDataFrame([("a", u) for u in urls], "site string, url string")
    picked = P.pick_urls(df, SIG)
    assert {r.url for r in picked.collect()} == {urls[0], urls[1], urls[2], urls[4]}
    assert [r.url for r in P.top_seeds(picked, SIG, 3).orderBy("rank").collect()] == [urls[0], urls[1], urls[2]]
    page = spark.createDataFrame([("https://a.example/x/y", '<a href="/stores">s</a><a class=q href="locator#top"> <a href=https://b.example/careers><a href="/restores"><a href="mailto:stores">')], "url string, html string")
    assert {r.link for r in P.follow_links(page, SIG).collect()} == {"https://a.example/stores", "https://a.example/x/locator", "https://b.example/careers"}
    hosts = spark.createDataFrame([("b.example",)], "host string")
    assert [r.link for r in P.follow_links(page, SIG, hosts).collect()] == ["https://b.example/careers"]


def test_two_key_dedupe_equals_a_loop(spark):
    rng, rows = random.Random(1), []
    for i in range(400):
        rows.append((f"s{i % 4}", i, f"u{rng.randint(0, 40)}", f"h{rng.randint(0, 40)}"))
    want, seen = set(), {}
    for site, i, u, h in rows:
        urls, hashes = seen.setdefault(site, (set(), set()))
        if u not in urls and h not in hashes:
            urls.add(u), hashes.add(h), want.add((site, i))
    df = spark.createDataFrame(rows, "site string, order_key int, url string, hash string").repartition(5)
    assert {(r.site, r.order_key) for r in P.first_of_both(df).collect()} == want


def test_index(spark):
    words = "word " * 70
    rows = [("a", 1, "https://a.example:443/stores", "Stores | all", words + "Fresh produce fresh departments"), ("a", 2, "https://a.example/stores", "dup url", words + "x"), ("a", 3, "https://a.example/copy", "dup text", words + "Fresh produce fresh departments "), ("a", 4, "https://a.example/404", "Page not found", words),
            ("a", 5, "https://a.example/soft", "fine", "Sorry, we can't find that page. " + words), ("a", 6, "https://a.example/short", "short", "few words"), ("a", 7, "https://a.example/careers", "Careers", words * 2)]
    df = spark.createDataFrame([(*r, f"f{r[1]}") for r in rows], "site string, order_key int, url string, title string, markdown string, file string")
    usable = P.usable_pages(df)
    got = P.page_index(usable, SIG).orderBy("place").collect()
    assert [(r.order_key, r.title, r.terms) for r in got] == [(1, "Stores / all", "fresh departments,fresh produce"), (7, "Careers", "-")]
    assert {r.file for r in P.dropped_files(df, usable).collect()} == {"f2", "f3", "f4", "f5", "f6"}


def test_boards_feeds_and_jobs(spark):
    texts = spark.createDataFrame([("co-op.example", 1, "https://boards.greenhouse.io/embed/job_board?for=Acme https://jobs.lever.co/Two x jobs.lever.co/jobs"), ("co-op.example", 2, "jobs.eu.lever.co/two jobs.lever.co/one"), ("w.example", 1, "acme.myworkdayjobs.com")], "site string, order_key int, text string")
    boards = P.find_boards(texts)
    assert [(r.kind, r.slug) for r in boards.filter("site = 'co-op.example'").orderBy("kind", "place").collect()] == [("greenhouse", "acme"), ("lever", "two"), ("lever", "one")]
    sites = spark.createDataFrame([("co-op.example",), ("w.example",), ("n-x.example",)], "site string")
    feeds = P.feed_urls(sites, boards).orderBy("site", "place").collect()
    assert [r.origin for r in feeds if r.site == "w.example"] == [] and [r.url for r in feeds if r.site == "n-x.example"][3] == "https://api.lever.co/v0/postings/nx?mode=json"
    assert [r.origin for r in feeds if r.site == "co-op.example"] == ["site_link"] * 3 + ["guessed"] * 6
    body = '[{"text":"Baker","hostedUrl":"u1","categories":{"location":"Oslo","team":"T"},"descriptionHtml":"&lt;p&gt;food waste &amp;amp; co-op"},3,{"title":"Replenishment Analyst","location":{"name":"X"}}]'
    rows = spark.createDataFrame([("co-op.example", 1, "a", "site_link", "[]"), ("co-op.example", 2, "b", "site_link", body), ("k.example", 1, "c", "guessed", '{"jobs":[{"title":"Z","location":"L"}]}')], "site string, place int, url string, origin string, body string")
    picked = P.pick_feed(rows)
    assert {r.site: r.url for r in picked.collect()} == {"co-op.example": "b", "k.example": "c"}
    jobs = P.job_rows(picked)
    listing = P.job_listing(jobs, SIG, 1).filter("site = 'co-op.example'").collect()
    assert [(r.title, r.role, r.location, r.more) for r in listing] == [("Replenishment Analyst", True, "X", 1)]
    baker = jobs.filter("title = 'Baker'").first()
    assert (baker.location, baker.team, baker.text) == ("Oslo", "T", "food waste & co-op")
    assert {r.site: (r.postings, r.mentions) for r in P.job_mentions(jobs).collect()} == {"co-op.example": (2, 1), "k.example": (1, 0)}


def test_reachable(spark):
    links = spark.createDataFrame([("s", "a", "b"), ("s", "b", "c"), ("s", "c", "d"), ("s", "b", "a"), ("t", "a", "z")], "site string, url string, link string")
    seeds = spark.createDataFrame([("s", "a")], "site string, url string")
    assert {(r.url, r.depth) for r in P.reachable(seeds, links).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert P.reachable(seeds, links, cap=2).count() == 2 and F is not None


def test_a_long_chain_takes_a_fixed_number_of_rounds(spark, monkeypatch):
    """Each page shares its address with the one before and its text with the one after, so every other one stays."""
    jobs = []
    monkeypatch.setattr(P, "staged", lambda df, kind, keep=P.staged: jobs.append(kind) or keep(df, kind))
    n = 10_000
    df = spark.range(n).selectExpr("'s' AS site", "id AS order_key", "concat('u', (id + 1) DIV 2) AS url", "concat('h', id DIV 2) AS hash").repartition(4)
    assert sorted(r.order_key for r in P.first_of_both(df).collect()) == list(range(0, n, 2)) and len(jobs) == 5


def test_rules_are_looked_up_by_their_beginnings(spark):
    """Against all rules of a host, one by one."""
    rng = random.Random(8)
    piece = lambda: rng.choice(["a", "b", "ab", "*", "/", "/a", "c", "?"])
    lines = ["User-agent: *"] + [f"{rng.choice(['Allow', 'Disallow'])}: /{''.join(piece() for _ in range(rng.randint(0, 5)))}{rng.choice(['', '', '$'])}" for _ in range(120)] + ["Disallow: *b"]
    robots = spark.createDataFrame([("h.example", 200, "\n".join(lines)), ("k.example", 200, "")], "host string, status int, body string")
    urls = [f"https://{rng.choice(['h', 'h', 'k'])}.example/{''.join(piece() for _ in range(rng.randint(0, 8)))}" for _ in range(300)]
    rules = [(r.allow, r.pattern, r.length) for r in P.robots_rules(robots, "x").filter("host = 'h.example'").collect()]
    got = {r.url: r.allowed for r in P.robots_allowed(spark.createDataFrame([(u,) for u in urls], "url string"), robots, "x").collect()}
    for url in urls:
        place = url.split(".example", 1)[1]
        hits = [(length, allow) for allow, pattern, length in rules if re.search(re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), pattern), place)]
        assert got[url] == (max(hits)[1] if hits and "//h." in url else True), url
