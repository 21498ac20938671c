import random

import numpy as np
from pyspark.sql import functions as F

from intake_spark.llm import quality, toxicity

SCHEMA = "doc_id bigint, text string, lang string, score string"


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(rng.randint(20, 60))]
        toxic, bad = rng.random() < 0.2, rng.random() < 0.3
        if toxic:
            words[rng.randint(0, 19)] = rng.choice(["vile", "nasty", "ugly"])
        if bad:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "en", "x"))
        if i % 2 == 0:
            labels.append((i, int(not bad), int(toxic)))
    return docs, labels, {i: (q, t) for i, q, t in labels}


def test_toxicity_and_quality(spark):
    docs, labels, truth = corpus(1600, 1)
    docs += [(None, "nasty vile", "en", ""), (9000, None, "en", ""), (9001, "ugly " + "w " * 100_000, "en", "")]
    df, lf = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (0, *truth[0])], "doc_id bigint, quality int, toxic int")
    held = lambda r: r.doc_id is not None and r.doc_id < 9000 and r.doc_id % 3 == 1 and r.doc_id in truth
    model = toxicity.train(df, lf, learn_from=F.col("id") % 3 != 1)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    right = [(r.score >= 0.7) == truth[r.doc_id][1] for r in rows if held(r)]
    assert np.mean(right) > 0.97
    assert {r.doc_id: r.score >= 0.7 for r in rows if r.doc_id is None or r.doc_id >= 9000} == {None: True, 9000: False, 9001: True}
    fm = quality.train(df, lf, learn_from=F.col("id") % 3 != 1)
    rows = toxicity.score(df, fm).collect()
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id][0] for r in rows if held(r)]) > 0.97


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b", "", ""), (2, None, "", "")], SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [round(r.score, 6) for r in toxicity.score(df, toxicity.train(df, none)).collect()] == [0.1, 0.1]
    assert [r.score for r in toxicity.score(df, quality.train(df, none)).collect()] == [0.5, 0.5]
    assert toxicity.score(df.limit(0), quality.train(df.limit(0), none)).collect() == []


def test_fm_identity_and_gradient_step():
    rng = np.random.default_rng(0)
    n = quality.BUCKETS + quality.STATISTICS
    model = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), 0.1, rng.normal(size=n), rng.normal(size=(n, quality.RANK)))
    text = "one two two three. Four!"
    places, values, stats = quality.inputs(text, quality._Hashed())
    x = np.zeros(n)
    x[places], x[quality.BUCKETS :] = values, np.clip(stats, -4, 4)
    used = np.flatnonzero(x)
    pairs = sum(model.vectors[i] @ model.vectors[j] * x[i] * x[j] for i in used for j in used if i < j)
    assert np.isclose(model.score([text])[0], 1 / (1 + np.exp(-(0.1 + model.linear @ x + pairs))))


def test_nnpu_never_rewards_negative_risk():
    rng = np.random.default_rng(1)
    x = (rng.random((600, 40)) < 0.1).astype(np.float32)
    toxic = rng.random(600) < 0.3
    x[:, 0] = toxic
    confirmed = x[toxic & (rng.random(600) < 0.5)]
    rows = lambda a: toxicity.Rows.of([np.flatnonzero(r).tolist() for r in a])
    w, b = toxicity.nnpu(rows(confirmed), rows(x), 40, 0.3)
    score = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.isfinite(w).all() and np.argmax(w) == 0 and ((score > 0.5) == toxic).mean() > 0.95
