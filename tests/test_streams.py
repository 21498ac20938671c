"""State over micro-batches: cap, rank, registry."""

import random
import time

import pandas as pd
from intake_spark.operators import crm as H
from intake_spark.operators import selection as S
from intake_spark.streaming import streams
from intake_spark.streaming.registry import Registry
from pyspark.sql import Row
from pyspark.sql import functions as F

ROWS = "batch string, order_key bigint, org_id string, name string, domain string"


def nobody(spark):
    return spark.createDataFrame([], "org_id string, domain string")


def arrive(spark, at, arrivals, cap, scope=S.Scope(), bucket_rows=4):
    for rows in arrivals:
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{at}/in")
        source = spark.readStream.schema(spark.createDataFrame([], ROWS).schema).parquet(f"{at}/in")
        streams.stream_intake(source, f"{at}/out", f"{at}/check", nobody(spark), scope, cap, bucket_rows).awaitTermination()
    return spark.read.parquet(f"{at}/out/candidates")


def test_cap_and_rank_go_on(spark, tmp_path):
    rows = [("b", i, None, f"n{i}", f"d{i}.example") for i in range(10)]
    got = arrive(spark, tmp_path, [rows[:2], rows[2:]], cap=3).orderBy("source_rank").collect()
    assert [(r.domain, r.source_rank) for r in got] == [("d0.example", 1), ("d1.example", 2), ("d2.example", 3)]


def test_the_same_as_one_job(spark, tmp_path):
    """Several batches, repeated domains and names, rows without a domain, bad rows, in arrivals that keep the order of each batch."""
    rng = random.Random(6)
    rows = [(f"b{rng.randint(1, 3)}", i, rng.choice([None, "nohex"] + [None] * 8), f"name {rng.randint(0, 20)}", rng.choice([None, f"https://www.d{rng.randint(0, 40)}.example/x"])) for i in range(160)]
    scope = S.Scope(name_pattern="name 1$")
    got = arrive(spark, tmp_path, [rows[:80], rows[80:]], 25, scope)
    seen, counts, want = set(), {}, set()
    for start in range(0, 160, 80):
        now = set()
        for batch, key, org, name, domain in rows[start : start + 80]:
            host = domain and domain.split("/")[2].removeprefix("www.")
            pending, ranked = counts.get(batch, (0, 0))
            one = host or (batch, name)
            if org == "nohex" or one in seen or (batch, one) in now or pending >= 25:
                continue
            now.add((batch, one))
            status = "pending" if host and name != "name 1" else "skipped_prefilter"
            counts[batch] = (pending + (status == "pending"), ranked + 1)
            want.add((batch, key, status, ranked + 1))
        seen |= {one for _, one in now}  # a domain that two batches bring at once is a candidate of both
    assert {(r.batch, r.order_key, r.status, r.source_rank) for r in got.collect()} == want and got.count() == len(want)


def test_a_micro_batch_that_runs_again_changes_nothing(spark, tmp_path):
    rows = [("b", i, None, f"n{i}", f"d{i % 7}.example") for i in range(20)]
    before = sorted(map(tuple, arrive(spark, tmp_path, [rows[:5], rows[5:12]], cap=6).collect()))
    (tmp_path / "check" / "commits" / "1").unlink()  # as if the job was lost before it said that micro-batch 1 is done
    for crc in (tmp_path / "check" / "commits").glob(".1.crc"):
        crc.unlink()
    after = arrive(spark, tmp_path, [rows[12:]], cap=6)
    assert sorted(tuple(r) for r in after.filter("epoch < 2").collect()) == before
    assert [r.source_rank for r in after.orderBy("source_rank").collect()] == [1, 2, 3, 4, 5, 6]


def test_registry_reads_few_rows_however_long_the_history(spark, tmp_path):
    registry, known, read = Registry(str(tmp_path), bucket_rows=64), set(), []
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    for epoch in range(7):
        new, old = [f"{epoch}-{i}.example" for i in range(60)], sorted(known)[epoch :: max(1, len(known) // 2)]
        asked = frame([*new, *old])
        assert {r.key for r in registry.known(asked, epoch).collect()} == set(old)
        if known:
            hits, buckets = registry.asked(asked, epoch)
            assert set(old) <= {r.key for r in hits.collect()} and hits.count() <= len(old) + 6
            entries = {e.bucket: e for e in registry.rows.entries(spark, epoch)}
            read.append(sum(entries[b].rows for b in buckets if b in entries))
            assert max(len(e.versions) for e in entries.values()) <= 9
        registry.register(frame(new), epoch)
        known |= set(new)
    assert registry.buckets(spark, 7) == 8 and max(read) <= 8 * 64 and sum(e.rows for e in registry.rows.entries(spark, 7)) == len(known)
    assert registry.known(frame(["never.example"]), 7).count() == 0


def test_rows_beyond_the_stop_are_not_sorted(spark, monkeypatch):
    """With a run of 10 order keys and a cap of 40, the window gets the run in which the cap is reached at most."""
    monkeypatch.setattr(S, "RUN", 10)
    df = spark.range(1000).select(F.lit("b").alias("batch"), F.col("id").alias("order_key"), F.when(F.col("id") % 2 == 0, "pending").otherwise("x").alias("status"))
    assert S.cap_pending(df, 40).count() == 79
    plan = df.withColumn("_pending", F.col("status") == "pending")
    near = S.count_before(plan, {"_before": "_pending"}, below=("_before", F.lit(40)))
    text = near._jdf.queryExecution().optimizedPlan().toString()
    window = text[: text.index("Join")]
    assert window.count("Window") == 1 and "_base__before" in text[text.index("Join") :]  # sorted inside runs only after the join that drops runs
    assert near.count() == 79


def props(spark, rows):
    made = F.struct(*[(F.lit("Qualified") if p in (H.STATUS, H.STAGE) else F.col("key") if p in ("name", "domain") else F.concat(F.lit("https://"), "key") if p == "website" else F.lit(None).cast("string")).alias(p) for p in H.PROPERTIES])
    return spark.createDataFrame([(k,) for k in rows], "key string").select("key", F.lit(None).cast("string").alias("reason"), made.alias("props"))


def test_snapshot_buckets_that_nothing_touches_keep_their_files(spark, tmp_path):
    crm = spark.createDataFrame([(str(i), f"c{i}.example", None, f"C{i}", "") for i in range(60)], f"id string, domain string, website string, name string, {H.STATUS} string")
    streams.create_snapshot(crm, str(tmp_path), buckets=16)
    def arrive(keys):
        props(spark, keys).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(props(spark, []).schema).parquet(f"{tmp_path}/in")
        streams.stream_upsert(source, str(tmp_path), f"{tmp_path}/check").awaitTermination()
        return {r.domain: (r.id, r[H.STATUS]) for r in streams.latest_snapshot(spark, str(tmp_path)).collect()}

    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "records" / "data").rglob("*.parquet")}
    before = files()
    now = arrive(["c3.example", "new.example"])
    assert now["c3.example"] == ("3", "Qualified") and now["c4.example"] == ("4", "") and now["new.example"][0].startswith("new-") and len(now) == 61
    added = {p.parent.name for p in set(files()) - set(before)}
    assert 1 <= len(added) <= 2 and all(files()[p] == t for p, t in before.items())
    assert arrive(["c3.example", "new.example"]) == now  # a record made before is found, and nothing is left to write
    added = set(files())
    (tmp_path / "check" / "commits" / "1").unlink()
    for crc in (tmp_path / "check" / "commits").glob(".1.crc"):
        crc.unlink()
    now = arrive(["c5.example"])
    assert len(now) == 61 and now["c5.example"] == ("5", "Qualified") and len({p.parent for p in set(files()) - added}) == 1


def test_settled_companies_expire_and_state_begins_with_a_table(spark, tmp_path):
    """Over two runs of the stream: what is open goes on, what is settled is forgotten after its time."""
    schema, start = "key string, order_key bigint, ok boolean", spark.createDataFrame([("old", 1, "error"), ("past", 2, "given_up")], "key string, attempts bigint, state string")

    empty = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(empty, "false")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(f"{tmp_path}/in")
        state = streams.stream_attempts(source, 3, ttl_ms=5_000, initial=start)
        seen = []
        write = lambda df, epoch: seen.extend(map(tuple, df.collect()))
        state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
        return {k: (n, now) for k, n, now in seen}

    first = arrive([("a", 1, True), ("b", 2, False), ("b", 1, False), ("old", 5, False), (None, 1, True)])
    assert first.items() >= {"a": (1, "done"), "b": (2, "error"), "old": (2, "error")}.items()
    time.sleep(6)
    assert arrive([("a", 9, False), ("b", 9, False), ("old", 9, True)]) == {"a": (1, "error"), "b": (3, "given_up"), "old": (3, "done")}
    spark.conf.unset(empty)


def test_attempts_cost_few_messages_a_company():
    """A map entry is asked for and written once at most; a group without entries is asked once, and what is settled stays as it was without a write."""
    class Entries:
        def __init__(self, ttl):
            self.of, self.ttl, self.calls = {}, ttl, []

        def exists(self):
            self.calls.append("exists")
            return bool(self.of)

        def containsKey(self, key):  # noqa: N802
            self.calls.append("asked")
            return key in self.of

        def getValue(self, key):  # noqa: N802
            return self.of[key]

        def updateValue(self, key, value):  # noqa: N802
            self.calls.append("written")
            self.of[key] = value

        def removeKey(self, key):  # noqa: N802
            del self.of[key]

    class Handle:
        def __init__(self):
            self.states = {}

        def getMapState(self, name, key, value, ttl=None):  # noqa: N802
            return self.states.setdefault(name, Entries(ttl))

    def events(oks, start=0):
        return iter([Row(key=f"c{i}", order_key=start + at, ok=ok) for at, ok in enumerate(oks) for i in range(500)])

    handle, attempts = Handle(), streams.Attempts(2, None)
    attempts.init(handle)
    assert {tuple(r) for r in attempts.handleInputRows(7, events([False]), None)} == {(f"c{i}", 1, "error") for i in range(500)}
    assert list(handle.states) == ["open"] and handle.states["open"].calls == ["exists", *["written"] * 500]
    assert {r[1:] for r in attempts.handleInputRows(7, events([True, False]), None)} == {(2, "done")}
    handle.states["open"].calls.clear()
    assert {r[1:] for r in attempts.handleInputRows(7, events([False, False]), None)} == {(2, "done")}
    assert handle.states["open"].calls == ["exists", *["asked"] * 500]
    handle, attempts = Handle(), streams.Attempts(2, 1000)
    attempts.init(handle)
    attempts.handleInitialState(7, Row(key="c1", attempts=1, state="pending"), None)
    assert {r.key: (r.attempts, r.state) for r in attempts.handleInputRows(7, events([False]), None)}["c1"] == (2, "given_up")
    assert handle.states["settled"].ttl == 1000 and handle.states["settled"].of == {("c1",): (2, "given_up")} and ("c1",) not in handle.states["open"].of


def test_events_that_cannot_matter_stay_before_the_shuffle():
    """One company with most of 400,000 events, in batches of 10,000 in any order, and 2,000 others, by one task."""
    rng = random.Random(3)
    order = rng.sample(range(400_000), 400_000)
    events = pd.DataFrame({"key": ["hot" if i % 20 else f"c{i % 40_000}" for i in order], "order_key": order, "ok": [i % 7 == 0 for i in order]})
    got = pd.concat(streams._first_events((events[at : at + 10_000] for at in range(0, len(events), 10_000)), 2))
    want = events.sort_values("order_key").groupby("key").head(2)
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want.itertuples(index=False, name=None)) and len(got) == 2 * 2001


def test_events_are_handed_on_where_few_can_be_left_out(monkeypatch):
    monkeypatch.setattr(streams, "EVENTS_HELD", 100)
    events = pd.DataFrame({"key": [f"c{i % 900}" for i in range(1800)], "order_key": range(1800), "ok": False})
    got = list(streams._first_events((events[at : at + 30] for at in range(0, 1800, 30)), 2))
    assert max(map(len, got)) <= 130 and sorted(pd.concat(got)["order_key"]) == list(range(1800))


def test_attempts_are_those_of_a_loop(spark, tmp_path):
    """Two arrivals; several events of one order key (what failed comes first), rows without an order key (last), a key or an outcome."""
    rng, schema = random.Random(8), "key string, order_key bigint, ok boolean"
    arrivals = [[(f"c{rng.randint(0, 60)}", rng.choice([None, *range(9)]), rng.choice([None, True, False, False])) for _ in range(200)] + [(None, 1, True), ("tie", 1, True), ("tie", 1, False)] for _ in range(2)]
    state, want, got = {}, [], []
    for rows in arrivals:
        now = {}
        for key, _, ok in sorted((r for r in rows if r[0]), key=lambda r: (r[0], r[1] is None, r[1] or 0, bool(r[2]))):
            attempts, was = state.get(key, (0, "pending"))
            if was not in ("done", "given_up"):
                state[key] = (attempts + 1, "done" if ok else "given_up" if attempts == 2 else "error")
            now[key] = state[key]
        want.append(now)
    for rows in arrivals:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        found = streams.stream_attempts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 3)
        found.writeStream.outputMode("update").foreachBatch(lambda df, epoch: got.append(df.collect())).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    assert [{r.key: (r.attempts, r.state) for r in rows} for rows in got] == want and [len(rows) for rows in got] == [len(now) for now in want]
