import datetime as dt
import random

from pyspark.sql import functions as F

from intake_spark.functions import columns as C
from intake_spark.operators import register as R
from intake_spark.operators import selection as S
from intake_spark.sources import tables

ROW = "batch string, order_key bigint, org_id string, account_id string, name string, domain string, website_url string, industry string, headcount string, country string, parent_company string, technologies array<string>"
SCOPE = S.Scope(name_pattern=r"\b(wholesale|distributors?)\b", industry_pattern="food production", subsidiaries=True, countries=("United States", "Canada"), headcount_min=1001, headcount_max=10000)
ID = "a" * 23


def rows(spark, *given):
    base = {"batch": "2030-01-15", "org_id": None, "account_id": None, "name": None, "domain": None, "website_url": None, "industry": None, "headcount": None, "country": None, "parent_company": None, "technologies": None}
    names = [c.split()[0] for c in ROW.split(", ")]
    full = [{**base, "order_key": i, **g} for i, g in enumerate(given)]
    random.Random(1).shuffle(full)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], ROW).repartition(5)


def none(spark, schema):
    return spark.createDataFrame([], schema)


def select(spark, df, cap=100, seen=(), excluded=()):
    s = spark.createDataFrame([(x,) for x in seen], "domain string")
    e = spark.createDataFrame(list(excluded), "org_id string, domain string")
    return S.select_candidates(df, s, e, SCOPE, cap).orderBy("order_key").collect()


def test_normalize_domain(spark):
    cases = {"https://WWW.Acme.example:443/about": "acme.example", "http://sub.acme.example/x?y": "sub.acme.example", "": None, None: None, "localhost": None, " user@shop.example. ": "shop.example", "ftp+x://a.b?c#d": "a.b"}
    df = spark.createDataFrame(list(cases.items()), "a string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", C.normalize_domain("a")).collect())
    crm = spark.createDataFrame([("https://www.A.example:80/x", "a.example:80"), (None, "")], "a string, want string").withColumn("got", C.normalize_domain("a", "crm"))
    assert all(r.got == r.want for r in crm.collect())


def test_numbers_lists_countries(spark):
    df = spark.createDataFrame([("1,200",), ("2400.9",), ("x",), ("nan",), ("inf",), ("-5",), (None,)], "a string")
    assert [r.n for r in df.select(C.to_int("a").alias("n")).collect()] == [1200, 2400, None, None, None, -5, None]
    assert [r.n for r in df.select(C.employees("a").alias("n")).collect()][5] is None
    one = spark.range(1)
    assert one.select(C.to_list(F.array(F.lit("a"), F.lit(""), F.lit(None)))).first()[0] == ["a"] and one.select(C.to_list(F.array(F.lit("")))).first()[0] is None
    assert [one.select(C.country(F.lit(c))).first()[0] for c in (" USA ", "England", "France", None)] == ["united states", "united kingdom", "france", ""]


def test_cap_walks_in_order(spark):
    df = rows(spark, *[{"name": f"Co {i}" if i != 1 else "Acme Wholesale", "domain": f"co{i}.example"} for i in range(5)])
    got = select(spark, df, cap=2)
    assert [(r.order_key, r.status, r.skip_reason, r.source_rank) for r in got] == [(0, "pending", None, 1), (1, "skipped_prefilter", "name_match", 2), (2, "pending", None, 3)]
    summary = S.selection_summary(S.walk(df, none(spark, "domain string"), none(spark, "org_id string, domain string"), SCOPE, 2), df, 2).first()
    assert (summary.rows, summary.pending, summary.prefiltered, summary.need_more) == (5, 2, 1, False)


def test_history_exclusions_and_bad_rows(spark):
    df = rows(spark, {"name": "a", "domain": "https://www.co1.example/"}, {"name": "b", "domain": "seen.example"}, {"name": "c", "domain": "c.example", "org_id": "XYZ"}, {"name": "d", "domain": "d.example", "org_id": ID + "1"},
              {"name": "e", "domain": "e.example"}, {"name": "a2", "domain": "co1.example"}, {"name": "Only Name"}, {"name": "only name"}, {"website_url": "w.example"}, {"domain": "bad"})
    got = select(spark, df, seen=["seen.example"], excluded=[(ID + "1", None), (None, "e.example")])
    assert [(r.order_key, r.status, r.skip_reason) for r in got] == [(0, "pending", None), (3, "skipped_prefilter", "excluded_keyword_tag"), (4, "skipped_prefilter", "excluded_keyword_tag"), (6, "skipped_prefilter", "no_domain")]
    walked = S.walk(df, spark.createDataFrame([("seen.example",)], "domain string"), none(spark, "org_id string, domain string"), SCOPE, 100)
    assert {(r.order_key, r.problem) for r in walked.filter("status = 'invalid'").collect()} == {(2, "bad org_id"), (8, "no name or domain"), (9, "bad domain")}
    assert [r.order_key for r in walked.filter("status = 'resurfaced'").collect()] == [1]


def test_warnings_never_exclude(spark):
    r = select(spark, rows(spark, {"name": "x", "domain": "x.example", "headcount": "50,000", "country": "Germany"}))[0]
    assert r.status == "pending" and r.scope_warnings == ["country=Germany", "headcount=50000"]


def test_running_count_equals_a_loop(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN", 7)
    rng = random.Random(3)
    data = [(f"b{i % 3}", i, rng.choice(["pending", "x", None])) for i in range(200)]
    for cap in (0, 1, 5, 40):
        want, seen = set(), {}
        for b, i, s in data:
            if seen.get(b, 0) < cap:
                want.add((b, i))
                seen[b] = seen.get(b, 0) + (s == "pending")
        got = S.cap_pending(spark.createDataFrame(data, "batch string, order_key bigint, status string").repartition(4), cap).collect()
        assert {(r.batch, r.order_key) for r in got} == want


def test_match_registered_tiers(spark):
    cands = spark.createDataFrame([("b", 1, "o1", None, "n1", "d1.example"), ("b", 2, None, None, "Acme", "acme.example"), ("b", 3, None, None, "Acme", None), ("b", 4, None, "own", "x", "d1.example"), ("b", 5, "o2", None, "z", "d1.example"), ("b", 6, None, None, "nodom", "n.example")],
                                  "batch string, order_key int, org_id string, account_id string, name string, domain string")
    reg = spark.createDataFrame([(0, "www.d1.example", "q", "acc-d1", None), (1, None, "n1", "acc-org", "o1"), (2, "acme-grocers.example", "ACME ", "acc-acme", None), (3, None, "z", None, "o2"), (4, None, "nodom", "acc-nodom", None)], "reg_order int, domain string, name string, account_id string, organization_id string")
    got = {r.order_key: r.matched_id for r in R.match_registered(cands, reg).collect()}
    assert got == {1: "acc-org", 2: None, 3: "acc-acme", 4: "own", 5: None, 6: "acc-nodom"}
    assert [r.note for r in R.name_collisions(cands, reg).collect()] == ["dedupe_name_collision: acme.example vs acme-grocers.example"]


def test_prioritize(spark):
    q = spark.createDataFrame([("t", i, f"id{i}", d, s) for i, (d, s) in enumerate([("a", "done"), ("b.example", "pending"), ("c.example", "pending"), ("d", "skipped_prefilter"), ("e", "pending")], 1)], "batch string, order_key int, account_id string, domain string, status string")
    wanted = spark.createDataFrame([("id5", None), ("id1", None), ("id4", None), (None, "https://c.example")], "account_id string, website string")
    got = R.prioritize(q, wanted, "f.csv").orderBy("position").collect()
    assert [r.order_key for r in got] == [3, 5, 1, 2, 4] and sum(r.hit for r in got) == 4 and sum(r.priority is not None for r in got) == 2


def test_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for n, lines in ((1, ['{"k": 1}', "", "oops"]), (2, ['{"k": 2}', "[1]"]), (10, ['{"k": 3}} x', '{"k": 4}'])):
        (tmp_path / "p" / f"page-{n}.jsonl").write_text("\n".join(lines))
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    assert [r.k for r in tables.read_pages(spark, str(tmp_path / "p"), schema).orderBy("order_key").collect()] == [1, 2, 4]
    _, bad = tables.read_jsonl(spark, str(tmp_path / "p"), schema)
    assert sorted((r.file.rsplit("/", 1)[1], r.line_no) for r in bad.collect()) == [("page-1.jsonl", 3), ("page-10.jsonl", 1), ("page-2.jsonl", 2)]
    (tmp_path / "a.csv").write_text('﻿Company Name,Website,Apollo Account Id,Technologies,Odd\nAcme,acme.example,x1,"a, b,,c",1\n', encoding="utf-8")
    r = tables.read_accounts_csv(spark, str(tmp_path / "a.csv")).first()
    assert (r.name, r.domain, r.account_id, r.technologies) == ("Acme", "acme.example", "x1", ["a", "b", "c"])


def test_batches_are_written_once(spark, tmp_path):
    path = str(tmp_path / "q")
    one = spark.createDataFrame([("b1", 1), ("b2", 2)], "batch string, k int")
    tables.write_batch_once(one, path)
    tables.write_batch_once(one.withColumn("k", F.lit(9)).unionByName(spark.createDataFrame([("b3", 3)], "batch string, k int")), path)
    assert sorted((r.batch, r.k) for r in spark.read.parquet(path).collect()) == [("b1", 1), ("b2", 2), ("b3", 3)]
    tables.rewrite_batches(spark.createDataFrame([("b2", 7)], "batch string, k int"), path)
    assert sorted((r.batch, r.k) for r in spark.read.parquet(path).collect()) == [("b1", 1), ("b2", 7), ("b3", 3)]


def test_reset_wait(spark):
    now = F.lit(dt.datetime(2030, 1, 15, 3, 10))
    one = spark.range(1)
    wait = lambda m: one.select(C.reset_wait(F.lit(m), now)).first()[0]
    assert [wait(m) for m in ("resets 6am", "resets at 1:30am", "reset 3pm", "resets 12pm", "nothing")] == [2 * 3600 + 50 * 60, 22 * 3600 + 20 * 60, 11 * 3600 + 50 * 60, 8 * 3600 + 50 * 60, None]
