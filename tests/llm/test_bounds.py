"""Long texts in parts, crowded places, empty tables and null ids."""

import random
from collections import Counter

import corpus_pipeline as cp
import numpy as np
import pytest
from intake_spark.llm import ann, caches, common, exact_dedup, mixing, near_copies, packing, quality, simhash, sstable, suffix_dedup, text_features, tokens, toxicity
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "The quick  brown fox's tail, über\tall   hills   and\n\n don't 12 34!! ΣΊΣΥΦΟΣ Ω " * 40


@pytest.mark.parametrize("size", [1, 13, 100, 10**6])
def test_parts_change_nothing(monkeypatch, size):
    whole = tokens.Encoder(tokens.default_path()).encode([LONG, "x"]), sorted(text_features.WordBuckets(1 << 12).features(LONG)), np.concatenate(list(simhash.shingle_hashes(LONG, 4)))
    monkeypatch.setattr(common, "PART_CHARS", size)
    monkeypatch.setattr(tokens, "GROUP_CHARS", size)
    assert "".join(common.parts_of(LONG)) == LONG and (size > 10**5) == (len(list(common.parts_of(LONG))) == 1)
    assert tokens.Encoder(tokens.default_path()).encode([LONG, "x"]) == whole[0]
    assert sorted(text_features.WordBuckets(1 << 12).features(LONG)) == whole[1]
    assert np.array_equal(np.concatenate(list(simhash.shingle_hashes(LONG, 4))), whole[2])


def test_cache_is_bounded_and_right():
    class Doubles(caches.Generations):
        made = 0

        def make(self, keys):
            Doubles.made += len(keys)
            return {k: k * 2 for k in keys}

        def weigh(self, entries):
            return 10 * len(entries)

    rng, cache = random.Random(1), Doubles(1000)
    for _ in range(300):
        keys = [str(int(rng.expovariate(0.05))) for _ in range(20)]
        cache.learn(keys)
        assert all(cache.known[k] == k * 2 for k in keys) and len(cache.known) <= 70 and len(cache.old) <= 70
    assert Doubles.made < 300 * 20 / 3


def test_small_token_cache_gives_the_same_ids(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdé1'!\n") for _ in range(rng.randint(1, 9))) for _ in range(60)) for _ in range(50)]
    whole = tokens.Encoder(tokens.default_path()).encode(texts)
    monkeypatch.setattr(tokens, "CACHE_BYTES", 3000)
    coder = tokens.Encoder(tokens.default_path())
    assert [x for t in texts for x in coder.encode([t])] == whole


def test_dense_nnpu_step():
    """One step of the fit against risk and gradient written out over dense rows, on either side of zero."""
    rng = np.random.default_rng(3)
    for prior, flat in ((0.1, False), (0.9, True)):
        p, u = (rng.random((n, 5)) < 0.4 for n in (30, 50))
        rows = lambda a: toxicity.Rows.of([np.flatnonzero(r).tolist() for r in a])
        w, b = toxicity.nnpu(rows(p), rows(u), 5, prior, rounds=1, rate=0.05, ridge=0.0)
        start = np.log(prior / (1 - prior))
        s = 1 / (1 + np.exp(-start))
        ones = lambda a: np.hstack([a.astype(float), np.ones((len(a), 1))])
        slope = s * ones(u).mean(axis=0) - prior * s * ones(p).mean(axis=0)
        negative_part = -np.log(1 - s) - prior * -np.log(1 - s)
        assert negative_part >= 0
        grad = prior * (s - 1) * ones(p).mean(axis=0) + slope
        want = np.append(np.zeros(5), start) - 0.05 * grad / (np.abs(grad) + 1e-8)
        assert np.allclose(np.append(w, b), want, atol=1e-6), flat


def test_rates_count_the_texts_found(spark):
    docs = [(i, "vile thing here" if i % 4 == 0 else "calm thing here") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = [(i, 1) for i in range(0, 400, 8)] + [(i, 0) for i in range(1, 400, 2)]
    absent = [(100_000 + i, 1) for i in range(2000)]
    models = [toxicity.train(df, spark.createDataFrame(x, "doc_id bigint, toxic int"), prior=0.2) for x in (labels, labels + absent)]
    assert models[0].chosen == models[1].chosen and models[0].chosen and np.allclose(models[0].weights, models[1].weights)


def test_toxicity_of_nothing_and_of_repeats(spark):
    df = spark.createDataFrame([(1, "vile"), (1, "vile"), (2, "calm"), (None, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.score(df, toxicity.train(df, labels)).count() == 4
    none = df.limit(0)
    assert toxicity.score(none, toxicity.train(none, labels)).collect() == []


def test_ann_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 12)).astype(np.float32)
    x[2000:] = x[7] + rng.normal(size=(1000, 12)) * 1e-3  # a third lies under the same pivots
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(9, [9.0] * 12)], "vec_id bigint, embedding array<float>")
    rows = ann.search(ann.index(df), F.col("vec_id") % 60 == 0, k=10).collect()
    assert Counter(r.query_id for r in rows) == Counter({i: 10 for i in range(0, 3000, 60)})
    hits = 0
    y = x.astype(float)
    for q in range(0, 3000, 60):
        far = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        hits += len({r.vec_id for r in rows if r.query_id == q} & {int(i) for i in np.argsort(far, kind="stable") if i != q and i != 9} & {int(i) for i in np.argsort(far, kind="stable")[:11]})
    assert hits >= 0.9 * 10 * 50


@pytest.mark.parametrize("stars", [0, 1])
def test_crowded_places_in_tiles(spark, monkeypatch, stars):
    """Many edits of one text, few of them similar enough to each other: slices of a few entries give what brute force gives."""
    monkeypatch.setattr(near_copies, "SLICE", 7)
    monkeypatch.setattr(near_copies.near_components, "__defaults__", (near_copies.MOST, stars))
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, rows = [word() for _ in range(150)], []
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(0, 150, 10), rng.choice([1, 2, 4])):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(146)} for _, t in rows]
    root = list(range(60))
    for _ in range(60):
        for a in range(60):
            for b in range(a):
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = near_copies.drop_similar(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert 1 < len(set(root)) < 60 and sorted(r.doc_id for r in got) == sorted(set(root))


def test_hot_text_under_null_ids_and_small_parts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PART_ROWS", 16)
    rows = [(i if i % 2 else None, "hot", str(i)) for i in range(200)] + [(1000 + i, f"t{i}", "") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _part string")
    for keep, best in (("largest", 199), ("smallest", 1)):
        got = exact_dedup.content_sort(df, keep=keep).filter("row.text = 'hot'").collect()
        assert {(r.keep_id, r.group_size) for r in got} == {(best, 200)} and [r.row.doc_id for r in got if r.kept] == [best]
        assert exact_dedup.drop_copies(df, keep=keep).count() == 51


def test_lookup_over_many_shards(spark):
    df = spark.createDataFrame([(i * i * 10**9 - 5 * 10**12, "w " * 200_000 if i % 40 == 0 else f"t {i}") for i in range(160)] + [(None, "n"), (7, "a"), (7, "b")], "doc_id bigint, text string")
    manifest = sstable.write_shards(df.repartition(9), shard_bytes=1)
    wanted = spark.createDataFrame([(None,), (7,), (12345,), *[(i * i * 10**9 - 5 * 10**12,) for i in range(0, 160, 3)]], "doc_id bigint")
    found = Counter(r.doc_id for r in sstable.lookup(manifest, wanted).collect())
    assert manifest.count() > 3 and found == Counter({None: 1, 7: 2} | {i * i * 10**9 - 5 * 10**12: 1 for i in range(0, 160, 3)})


def test_more_entries_more_blocks():
    assert [simhash.blocks_for(n, 4) for n in (0, 1 << 23, 1 << 24, 1 << 30, 1 << 36)] == [6, 6, 7, 8, 9]
    assert simhash.blocks_for(10, 2) == 4


def test_pipeline_of_nothing_and_of_null_ids(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    for name, rows in (("none", []), ("null", [(None, "some words", "en", None, 10), (None, None, None, "a", 0), (3, "some words", "en", "a", 10), (4, "", "en", "a", 0)])):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        out = cp.run(spark, path).collect()
        assert (len(out) > 0) == bool(rows) and all(r.length <= 2048 for r in out)


def test_packed_rows_of_one_id_are_told_apart(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None)], "doc_id bigint, text string")
    got = packing.pack(packing.cut(df, capacity=2), capacity=2).collect()
    assert len({(r.doc_id, r.row, r.start) for r in got}) == len(got) and len({r.row for r in got if r.doc_id == 1}) == 2
    assert packing.pack(packing.cut(df.filter("text IS NULL")), capacity=4).count() == 1


def test_repeats_in_texts_longer_than_a_cut(spark):
    """A passage across the place where a long text is cut, and one inside the text itself."""
    rng = np.random.default_rng(8)
    letters = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    passage = letters(700)
    long = letters(suffix_dedup.BUFFER - 300) + passage + letters(90_000)
    texts = [(1, long), (2, letters(400) + passage + letters(400)), (3, letters(5000) + long[1000:1500]), (4, "é" * 150), (None, letters(199))]
    data = {i: t.encode() for i, t in texts}
    seen = Counter(hash(d[k : k + 200]) for d in data.values() for k in range(len(d) - 199))
    want = {}
    for i, d in data.items():
        gone = np.zeros(len(d) + 1, np.int64)
        for k in range(len(d) - 199):
            if seen[hash(d[k : k + 200])] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        want[i] = int((np.cumsum(gone)[:-1] > 0).sum())
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == want and want[1] > 1100 and want[2] == 700


def test_mix_of_null_ids_and_a_very_long_text(spark):
    rows = [(None, "a b c", "s"), (None, "a b c", "s"), (1, "w " * 200_000, "t"), (2, None, None), (3, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.taken_by_shard(df).collect()
    assert len(got) == 5 and abs(sum(r.taken for r in got) - sum(t for t in {r.source_size: r.target for r in got}.values())) <= 3
    mixed = mixing.mix(df).collect()
    assert sum(len((r.text or "").split()) for r in mixed) == sum(r.taken for r in got) and all(r.mix_shard is not None for r in mixed)


def test_quality_of_repeats_and_other_columns(spark):
    docs = [(i % 60, "good words here. " * (i % 7 + 1) if i % 2 else "BAD!!! BAD!!! " * (i % 5 + 1), "x") for i in range(120)] + [(None, None, "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    scores = toxicity.score(df, quality.train(df, labels)).collect()
    by = {}
    for r in scores:
        by.setdefault((r.doc_id, r.text), set()).add(r.score)
    assert len(scores) == 121 and all(len(x) == 1 for x in by.values())
    assert all((max(s) > 0.5) == t.startswith("good") for (i, t), s in by.items() if i is not None)
