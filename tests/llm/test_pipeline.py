import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from intake_spark.llm import simhash, toxicity
from intake_spark.llm.tokens import encoder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(600):
        words = [word() for _ in range(rng.randint(30, 300))]
        if i % 5 == 0:
            words[3] = words[9] = rng.choice(["vile", "nasty"])
        rows.append((i, " ".join(words), "en", f"s{i % 4}"))
    rows += [(1000 + i, rows[i][1], "en", "s1") for i in range(1, 60)]
    rows += [(2000 + i, rows[i][1] + " tail", "en", "s2") for i in range(1, 30) if len(rows[i][1]) > 1200]
    rows += [(3000, None, "en", None), (3001, "", "en", "s0")]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(500)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_against_plain_versions(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {}
    for name, stage in cp.STAGES:
        out = spark.createDataFrame(stage(spark, docs, corpus).collect(), stage(spark, docs, corpus).schema)
        seen[name] = (docs.collect(), out.collect())
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    before, after = seen["toxicity"]
    toxic = {r.doc_id for r in before if {"vile", "nasty"} & set((r.text or "").split())}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - toxic
    before, after = seen["exact dedup"]
    best = {}
    for r in before:
        best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
    assert Counter(r.doc_id for r in after) == Counter(best.values())
    before, after = seen["simhash near-dedup"]
    prints = {r.doc_id: simhash.fingerprint(r.text or "", 5) for r in before}
    kept = {r.doc_id for r in after}
    linked = lambda a, b: ((prints[a] ^ prints[b]) & ((1 << 64) - 1)).bit_count() <= 4
    assert all(any(linked(i, k) for k in kept) for i in prints) and not any(linked(a, b) for a in kept for b in kept if a < b)
    before, after = seen["mixing"]
    size = lambda t: len((t or "").split())
    by = defaultdict(int)
    for r in after:
        by[r.doc_id] += size(r.text)
    assert abs(sum(by.values()) - 1.5 * sum(size(r.text) for r in before)) <= 4 and all(by[r.doc_id] <= 2 * size(r.text) for r in before)
    before, after = seen["packing"]
    ids = Counter()
    for t in (r.text or "" for r in before):
        ids[len(encoder().encode([t])[0]) // 4 + 1] += 1
    assert sum(r.length for r in after) == sum(n * c for n, c in ids.items())
    fill = defaultdict(int)
    for r in after:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and np.mean([*fill.values()]) > 1900


def test_run(spark, corpus):
    assert set(cp.run(spark, corpus).columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}
    assert toxicity.POSITIVES > 0 and [n for n, _ in cp.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "mixing", "packing"]
