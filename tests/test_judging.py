import json
import random

import pytest
from pyspark.sql import functions as F

from intake_spark.operators import crm as H
from intake_spark.operators import enrich as E
from intake_spark.operators import runs as N
from intake_spark.operators import searches as U
from intake_spark.operators import verdicts as G

GOOD = {"domain": "a.example", "name": "A", "status": "ok", "qualification": "QUALIFIED", "buyer_or_vendor": "BUYER", "buyer_vendor_reason": "r", "evidence_links": ["http://a"], "account_tier": "TIER_A", "need_strength": "STRONG", "current_approach": "MANUAL",
        "timing": "UNKNOWN", "evidence_confidence": "HIGH", "qualification_reason": "q", "strongest_signal": "s", "main_uncertainty": "m", "roles_to_contact": "c"}


def one(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def test_last_json(spark):
    line = json.dumps(GOOD)
    df = one(spark, f"prose\n{line}", f"{line}  ", f"x\n```json\n`{line}` \n```", '{"a":\n1}', "no", '{"b": 1}\n{broken', 'é\n{"c": "é"}\nlater prose')
    assert [r.v and json.loads(r.v) for r in df.select(G.last_json("text").alias("v")).collect()] == [GOOD, GOOD, GOOD, {"a": 1}, None, {"b": 1}, {"c": "é"}]


def test_contract(spark):
    bad = {"domain": "empty domain", "qualification": "bad qualification X", "buyer_or_vendor": "bad buyer_or_vendor X", "timing": "bad timing X"}
    cases = [(json.dumps(GOOD), None), (json.dumps({"status": "error"}), None), (json.dumps({**GOOD, "status": "odd"}), "verdict status odd"), (json.dumps({**GOOD, "evidence_links": "x"}), "evidence_links must be a list"), (json.dumps({**GOOD, "name": 3}), "non-string values for: name")]
    cases += [(json.dumps({k: v for k, v in GOOD.items() if k != key}), f"missing keys: {key}") for key in G.REQUIRED if key != "status"]
    cases += [(json.dumps({**GOOD, k: " " if k == "domain" else "X"}), why) for k, why in bad.items()]
    df = spark.createDataFrame(cases, "text string, want string").withColumn("got", G.verdict_problem("text"))
    assert all(r.got == r.want for r in df.collect())


def test_backstop(spark):
    df = spark.createDataFrame([("ok", "MAYBE", "BUYER", "TIER_A"), ("ok", "QUALIFIED", "VENDOR", "TIER_C"), ("ok", "QUALIFIED", "BUYER", "TIER_C"), ("ok", "QUALIFIED", "BUYER", "TIER_A"), ("error", "MAYBE", None, None)], "status string, qualification string, buyer_or_vendor string, account_tier string")
    got = [(r.qualification, r.account_tier, r.backstop) for r in G.apply_backstop(df).collect()]
    assert got == [("NOT_QUALIFIED", "TIER_C", "MAYBE->NOT_QUALIFIED (verdicts are binary); tier TIER_A->TIER_C (not qualified)"), ("NOT_QUALIFIED", "TIER_C", "downgraded QUALIFIED->NOT_QUALIFIED (buyer_or_vendor=VENDOR)"),
                   ("QUALIFIED", "TIER_C", "QUALIFIED with TIER_C: the verdict contradicts its tier, kept as returned"), ("QUALIFIED", "TIER_A", None), ("MAYBE", None, None)]


def test_outcomes(spark):
    own = ["Claude usage limit reached|1893456000", "Error: usage limit reached", "You've hit your limit", "5-hour limit reached", "API Error: 429 too many", "weekly limit reached"]
    quoted = ["the site says: usage limit reached", "they said you have hit your limit", "a weekly limit reached message"]
    schema = "rc int, timed_out boolean, stdout string, stderr string, json struct<result:string,error:string,subtype:string,is_error:boolean,api_error_status:string>"
    rows = [(1, False, m, "", None) for m in own + quoted] + [(1, False, "", "", ("x", "", "", True, "429")), (0, False, "", "", ("usage limit reached", "", "", False, None)), (1, False, "overloaded", "", None), (1, False, "", "", ("x", "", "", True, "503")), (0, True, "", "", None), (0, False, "", "", None)]
    got = [r.k for r in spark.createDataFrame(rows, schema).select(N.classify_outcome().alias("k")).collect()]
    assert got == ["usage_limit"] * 6 + ["error"] * 3 + ["usage_limit", "ok", "transient", "transient", "timeout", "error"]


def walk(events, lim):
    n = errors = transients = 0
    spent, out, reason = 0.0, [], None
    for kind, crm, dur in events:
        if reason:
            out.append("after")
            continue
        reason = "cap_reached" if n >= lim.cap else "deadline" if lim.seconds - spent < lim.reserve else "usage_limit" if kind == "usage_limit" and not crm else None
        if reason:
            out.append("left")
            continue
        n, spent = n + 1, spent + dur
        out.append("done")
        if crm:
            continue
        transients = transients + 1 if kind == "transient" else 0
        errors = 0 if kind == "ok" else errors + 1
        if kind != "ok":
            reason = "api_errors" if transients >= lim.transients else "consecutive_errors" if errors >= lim.errors else None
    return out, reason


def test_stop_point_equals_a_loop(spark):
    rng, lim, data, want = random.Random(2), N.Limits(cap=12, seconds=1000, errors=3, transients=2), [], {}
    for run in range(60):
        events = [(rng.choices(["ok", "error", "transient", "usage_limit"], [6, 2, 2, 0.4])[0], rng.random() < 0.15, float(rng.randint(1, 120))) for _ in range(20)]
        want[run] = walk(events, lim)
        data += [(run, i, k, k == "ok", c, d) for i, (k, c, d) in enumerate(events)]
    rng.shuffle(data)
    rows = N.stop_point(spark.createDataFrame(data, "run int, order_key int, kind string, good boolean, crm_only boolean, duration double").repartition(3), lim).orderBy("run", "order_key").collect()
    for run, (states, reason) in want.items():
        mine = [r for r in rows if r.run == run]
        assert [r.state for r in mine] == states and {r.stop_reason for r in mine} == {reason}


def test_work_list_oldest_first_once(spark):
    rows = [("2030-01-14", 2, "a.example", "pending", 0, 0), ("2030-01-15", 1, "a.example", "pending", 0, 0), ("2030-01-15", 2, "b.example", "error", 1, 0), ("2030-01-15", 3, "c.example", "error", 2, 0), ("2030-01-15", 4, "d.example", "hubspot_error", 2, 1), ("2030-01-16", 1, "e.example", "pending", 0, 0), ("odd", 1, "f.example", "pending", 0, 0), ("2030-01-15", 5, None, "pending", 0, 0)]
    got = N.work_list(spark.createDataFrame(rows, "batch string, order_key int, domain string, status string, attempts int, hubspot_attempts int"), "2030-01-15", 2).orderBy("position").collect()
    assert [(r.position, r.domain, r.backlog) for r in got] == [(1, "a.example", True), (2, "b.example", False), (3, "d.example", False)]


def test_crm_actions_and_rules(spark):
    verdicts = spark.createDataFrame([({**GOOD, "domain": f"https://www.{d}.example"}) for d in "abcdefg"])
    queue = spark.createDataFrame([(f"{d}.example", d, "1,500" if d != "b" else None) for d in "abcdef"], "domain string, name string, headcount string")
    props = H.build_properties(verdicts, queue, "2030-01-15", owner="9")
    assert {r.key: r.reason for r in props.collect() if r.reason} == {"g.example": "domain mismatch: not in the queue"}
    first = props.filter("key = 'a.example'").first().props
    assert (first.website, first.sourcing_account_tier, first.numberofemployees, first.sourcing_evidence_links) == ("https://a.example", "Tier A", "1500", "http://a")
    crm = spark.createDataFrame([("1", "www.a.example", "", "x", "", "In Outreach", "5", "77"), ("2", "b.example", "", "x", "Qualified", "", "", ""), ("3", "c.example", "", "x", "Needs Review", "", "", ""), ("4", "d.example", "", "x", None, "", "", ""), ("5", "", "http://d.example/x", "y", None, "", "", "")],
                                "id string, domain string, website string, name string, sourcing_qualification_status string, sourcing_account_stage string, numberofemployees string, hubspot_owner_id string")
    plan = H.plan_actions(props, crm)
    assert {r.key: r.action for r in plan.collect()} == {"a.example": "updated", "b.example": "exists", "c.example": "human_verdict_exists", "d.example": "conflict", "e.example": "created", "f.example": "created"}
    assert {r.action for r in H.plan_actions(props, crm, dry_run=True).filter("key IN ('a.example', 'e.example')").collect()} == {"dry_run"}
    merged = H.merge_crm(crm, plan)
    a = merged.filter("id = '1'").first()
    assert (a.sourcing_account_stage, a.hubspot_owner_id, a.numberofemployees, a.name, a.sourcing_qualification_status) == ("In Outreach", "77", "5", "x", "Qualified")
    assert merged.count() == 7
    again = H.plan_actions(props, merged)
    assert {r.action for r in again.collect()} == {"exists", "human_verdict_exists", "conflict"} and sorted(map(tuple, H.merge_crm(merged, again).collect())) == sorted(map(tuple, merged.collect()))
    options = spark.createDataFrame([("sourcing_account_tier", "Tier B")], "property string, value string")
    assert {r.action for r in H.plan_actions(props, crm, options).collect()} == {"invalid"}


def test_enrichment(spark):
    options = spark.createDataFrame([(1, "Food and Beverages", "FOOD_BEVERAGES"), (2, "Retail", "RETAIL")], "order_key int, label string, value string")
    index = E.industry_index(options)
    df = spark.createDataFrame([("Food & Beverages",), ("food and beverages",), ("vertical farming",), ("retail",)], "industry string")
    assert {r.industry: r.mapped for r in E.map_industry(df, index).collect()} == {"Food & Beverages": "FOOD_BEVERAGES", "food and beverages": "FOOD_BEVERAGES", "vertical farming": None, "retail": "RETAIL"}
    queue = spark.createDataFrame([("b", i, f"{d}.example", str(i), "created") for i, d in enumerate("abc")], "batch string, order_key int, domain string, crm_id string, action string")
    crm = spark.createDataFrame([("0", None, ""), ("1", "50", None), ("2", "5", "X")], "id string, numberofemployees string, industry string")
    done = spark.createDataFrame([], "domain string")
    todo = E.enrich_todo(E.pushed(queue), crm, done)
    assert {r.domain: r.state for r in todo.collect()} == {"a.example": "todo", "b.example": "todo", "c.example": "not_needed"}
    assert sorted(r.state for r in E.limit_todo(todo, 1).collect()) == ["todo", "waiting"] and {r.state for r in E.limit_todo(todo, 0).collect()} == {"waiting"}
    results = spark.createDataFrame([(1, "a.example", True, "9", "odd"), (2, "www.a.example", True, "1,200", "retail"), (3, "b.example", True, "70", "farming"), (4, "c.example", False, None, None), (5, "z.example", True, "1", "x")], "order_key int, domain string, found boolean, estimated_num_employees string, industry string")
    got = {r.domain: (r.status, r.numberofemployees, r.industry, r.unmapped) for r in E.apply_enrichment(results, E.pushed(queue), crm, done, index).collect()}
    assert got == {"a.example": ("ok", "1200", "RETAIL", None), "b.example": ("no_new_data", None, None, "b.example: farming"), "c.example": ("not_found", None, None, None)}


@pytest.mark.parametrize(("token", "want"), [("30_days_ago", "2029-12-16"), ("2_years_ago", "2028-01-16"), ("today", "2030-01-15"), ("2029-01-01", "2029-01-01")])
def test_dates(spark, token, want):
    assert spark.range(1).select(U.resolve_date(F.lit(token), F.lit("2030-01-15b"))).first()[0] == want


def test_search_address(spark):
    url = "https://app.example/#/companies?organizationLocations[]=United%2520States&organizationLocations[]=United%20States&revenueRange[min]=$1,500,000&revenueRange=3&page=2&totalFundingMax=&prospectedByCurrentTeam[]=no&zzz=1"
    df = spark.createDataFrame([(1, url)], "search_id int, url string")
    got = {r.filter: (r["items"], r.low) for r in U.search_params(df).collect()}
    assert got == {"organization_locations": (["United States"], None), "revenue_range": ([], "1500000")}
    assert {r.param: r.reason for r in U.unmapped_params(df).collect()} == {"revenueRange": "range without [min] or [max]", "zzz": "unknown parameter"}


def test_stop_point_over_segments(spark):
    """The same loop, with runs that are cut into segments of 7 rows."""
    rng, lim, data, want = random.Random(12), N.Limits(cap=45, seconds=4000, errors=9, transients=8), [], {}
    for run in range(40):
        odds = rng.choice([[1, 6, 3, 0.05], [6, 1, 1, 0.05], [0.3, 9, 0.2, 0.0], [0.2, 0.2, 9, 0.0]])
        events = [(rng.choices(["ok", "error", "transient", "usage_limit"], odds)[0], rng.random() < 0.15, float(rng.randint(1, 120))) for _ in range(60)]
        want[run] = walk(events, lim)
        data += [(run, i, k, k == "ok", c, d) for i, (k, c, d) in enumerate(events)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "run int, order_key int, kind string, good boolean, crm_only boolean, duration double").repartition(3)
    rows = N.stop_point(df, lim, segment=7).orderBy("run", "order_key").collect()
    assert len({reason for _, reason in want.values()}) >= 4
    for run, (states, reason) in want.items():
        mine = [r for r in rows if r.run == run]
        assert [r.state for r in mine] == states and {r.stop_reason for r in mine} == {reason}
