import corpus_pipeline as cp
from intake_spark.llm import mixing
from pyspark.sql import functions as F


def test_stage_deals_and_shuffles(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3000)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c w"), "id").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit(0).cast("long").alias("n_chars"))
    placed = mixing.mix(docs, weights=(5.0, 2.0, 1.0), epochs=1.5, cap=2.0).collect()
    shards = {}
    for r in sorted(placed, key=lambda r: (r.mix_shard, r.mix_position)):
        shards.setdefault(r.mix_shard, []).append((r.doc_id, r.text))
    cp.mix_sources(spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    got = [(r.doc_id, r.text) for p in sorted(tmp_path.glob("mixed/part-*")) for r in spark.read.parquet(str(p)).collect()]
    assert len(shards) > 1 and len(got) == len(placed) and all(x != sorted(x) for x in shards.values())
    at = 0
    while at < len(got):
        k = next(k for k, rows in shards.items() if got[at : at + len(rows)] == rows)
        at += len(shards.pop(k))
    assert not shards
