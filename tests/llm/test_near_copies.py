import random

import corpus_pipeline as cp
import pytest
from intake_spark.llm import near_copies
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def planted():
    """Originals with copies at 0.65 to 0.98, and one group of many copies of one text."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(150):
        words = [word() for _ in range(rng.randint(60, 400))]
        rows.append((10 * i, " ".join(words)))
        for k, share in enumerate((0.004, 0.012, 0.02, 0.03, 0.04)[: i % 6]):
            copy = [word() if rng.random() < share else w for w in words]
            rows.append((10 * i + 1 + k, " \t".join(copy)))
    base = [word() for _ in range(200)]
    for i in range(80):
        copy = list(base)
        copy[rng.randrange(200)] = word()
        rows.append((5000 + i, " ".join(copy)))
    return [*rows, (6000, ""), (6001, " \n"), (6002, None), (6003, "one two")]


def test_stage_takes_all_copies_from_similarity_08(spark):
    rows = planted()
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = {"0.8": 0, "0.9": 0}
    for a in range(len(rows)):
        for b in range(a):
            if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and (s := similarity(sets[a], sets[b])) >= 0.8:
                n["0.9" if s >= 0.9 else "0.8"] += 1
                parent[root(a)] = root(b)
    assert n["0.8"] > 100 and n["0.9"] > 100
    want = {}
    for i, (d, _) in enumerate(rows):
        want[root(i)] = min(want.get(root(i), d), d)
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in cp.drop_near_copies(spark, docs, "").collect()) == sorted(want.values())


@pytest.mark.parametrize("stars", [0, 2])
def test_stars_change_no_component(spark, stars, monkeypatch):
    monkeypatch.setattr(near_copies.near_components, "__defaults__", (near_copies.MOST, stars))
    docs = spark.createDataFrame([(None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g"), (4, "another text"), (3, "A B c d e f g"), (None, None)], "doc_id bigint, text string")
    got = near_copies.drop_similar(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, [(3, "A B c d e f g"), (4, "another text"), (None, None), (None, "a b c d e f g")]))
    assert near_copies.drop_similar(docs.limit(0)).collect() == []


def test_simhash_and_pivots_find_close_pairs_by_themselves(spark, monkeypatch):
    """Where no two texts meet by smallest shingles, those whose fingerprints are close are still found, and verified."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(2000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join(words[:1999])), (4, " ".join(reversed(words)))]
    alone = lambda df, *args: made(df, *args).withColumn("places", F.array(F.monotonically_increasing_id()))
    made = near_copies.sketches
    monkeypatch.setattr(near_copies, "sketches", alone)
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in cp.drop_near_copies(spark, docs, "").collect()) == [1, 4]
