import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from intake_spark.llm import exact_dedup, mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, row string, kept int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", 3) for i, t, s in rows], SCHEMA)


def test_exact_dedup_against_brute_force(spark):
    rng = random.Random(1)
    texts = ["", None, "a", "b\x00c", "long " * 30_000, "é", "é", "é", " a"]
    rows = [(i, rng.choice(texts), "s") for i in range(300)] + [(None, "a", "s"), (7, "only", "s"), (7, "only", "s")]
    got = exact_dedup.content_sort(docs(spark, rows)).select("row.doc_id", "row.text", "keep_id", "group_size", "kept", "text_sha256").collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    for r in got:
        group = groups[r.text or ""]
        assert (r.keep_id, r.group_size) == (max((x for x in group if x is not None), default=None), len(group))
        assert r.text_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    kept = Counter((r.text or "") for r in got if r.kept)
    assert kept == Counter(groups.keys())
    assert Counter(r.text for r in got) == Counter(t for _, t, _ in rows)


def test_exact_dedup_hot_group_and_smallest(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = exact_dedup.content_sort(df, keep="smallest")
    assert got.filter("row.text = 'hot'").select("keep_id", "group_size").distinct().collect() == [(0, 2000)]
    assert [r.doc_id for r in got.filter("kept AND row.text = 'hot'").select("row.doc_id").collect()] == [0]
    assert got.filter("kept").count() == 4001


def test_exact_dedup_empty(spark):
    df = docs(spark, [])
    assert exact_dedup.drop_copies(df).collect() == [] and exact_dedup.drop_copies(df).columns == df.columns


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)) or None, rng.choice(["a", "b", "c", None])) for i in range(500)] + [(3, "x y z", "b")] * 2
    for shards in (1, 5, 16):
        plan = mixing.plan_mix(docs(spark, rows), shards=shards, carry=["source"]).collect()
        assert len(plan) == len(rows)
        total = sum(r.size for r in plan)
        by = defaultdict(list)
        for r in plan:
            by[r.row.source].append(r)
            assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies or []) and all(0 <= c.shard < shards for c in r.copies or [])
        assert abs(sum(x[0].target for x in by.values()) - 1.5 * total) < 1e-6 * total
        for rs in by.values():
            assert rs[0].source_size == sum(r.size for r in rs) and rs[0].target <= 2 * rs[0].source_size
            assert abs(sum(r.taken for r in rs) - rs[0].target) <= 1


def test_mix_rows_and_shards(spark):
    rows = [(i, f"w{i} b c d", f"s{i % 3}") for i in range(400)]
    df = docs(spark, rows)
    mixed = mixing.mix(df, shards=4)
    got = mixed.collect()
    assert [sorted(r.mix_position for r in got if r.mix_shard == k) == list(range(1, sum(r.mix_shard == k for r in got) + 1)) for k in range(4)]
    assert sum(len(r.text.split()) for r in got) == 2400
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(df.repartition(7), shards=4).collect()), key=repr)
    assert mixing.mix(docs(spark, []), shards=2).collect() == [] and mixing.plan_mix(docs(spark, [])).collect() == []


def test_split_tree_is_exact_and_spread(spark):
    quotas = spark.createDataFrame([(1, 900), (2, 90), (3, 7), (4, 0)], "source_no bigint, quota bigint")
    got = mixing.split_quotas(quotas, 10).collect()
    by_source, by_shard = Counter(), Counter()
    for r in got:
        assert r.blocks >= 0
        by_source[r.source_no] += r.blocks
        by_shard[r.shard] += r.blocks
    assert by_source == Counter({1: 900, 2: 90, 3: 7}) and sorted(by_shard) == list(range(10))
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    firsts = sorted(r.blocks for r in got if r.source_no == 1)
    assert 80 <= firsts[0] and firsts[-1] <= 99 and len(set(firsts)) > 2
