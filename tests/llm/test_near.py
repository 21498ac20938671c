import random
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from intake_spark.llm import ann, components, simhash, suffix_dedup

SCHEMA = "doc_id bigint, text string, k string, n int, fp string, id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, "b", "c") for i, t in rows], SCHEMA)


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def test_ann_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[500] = x[100]
    rows = [(i, [float(v) for v in r], "z") for i, r in enumerate(x)] + [(1000, None, ""), (1001, [], ""), (1002, [0.0] * 16, ""), (1003, [float("nan")] * 16, ""), (1004, [None] + [1.0] * 15, ""), (None, [1.0] * 16, ""), (1005, [1.0] * 3, ""), (7, [float(v) for v in x[7]], "")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, block string")
    got = defaultdict(list)
    for r in ann.search(ann.index(df), F.col("vec_id") % 50 == 0, k=10).collect():
        got[r.query_id].append(r)
    assert set(got) == set(range(0, 900, 50))
    hits = 0
    for q, rs in got.items():
        far = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(900), far)) if i != q][:10]
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 11)) and all(r.score == far[r.vec_id] or abs(r.score - far[r.vec_id]) < 1e-12 for r in rs)
        hits += len({*best} & {r.vec_id for r in rs})
    assert hits >= 0.9 * 10 * len(got)
    few = ann.search(ann.index(df.filter("vec_id < 4")), F.col("vec_id") % 2 == 0, k=10).collect()
    assert Counter(r.query_id for r in few) == {0: 3, 2: 3}
    assert ann.search(ann.index(df.limit(0)), F.col("vec_id") == 0).collect() == []


def test_postings_give_footrule():
    rng = np.random.default_rng(1)
    orders = np.array([rng.permutation(20)[:6] for _ in range(50)], np.uint16)
    got = ann.Postings(orders).footrule(orders[3])
    place = lambda o: {p: i for i, p in enumerate(o.tolist())}
    want = [sum(abs(place(o).get(p, 6) - place(orders[3]).get(p, 6)) for p in range(20)) for o in orders]
    assert got.tolist() == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 560)] + [(rng.randint(600, 700), rng.randint(600, 700)) for _ in range(70)] + [(9, 9), (-5, 500), (1, 0)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        parent[find(parent, a)] = find(parent, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (find(parent, a) == find(parent, b))
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def by_hand(text, width):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["É", "b", "Cc", "d\x85", "e"]) for _ in range(rng.randint(0, 9)))) for i in range(150)]
    long = [rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(400)]
    for i in range(40):
        copy = list(long)
        copy[rng.randint(0, 399)] = "Edit"
        rows.append((1000 - i, " \t".join(copy)))
    rows += [(None, None), (None, " \n"), (2, None), (2, None), (5000, "x " * 60_000)]
    prints = [by_hand(t, 4) for _, t in rows]
    parent = {i: i for i in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                parent[find(parent, a)] = find(parent, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        root = find(parent, i)
        least[root] = min((x for x in (least.get(root), d) if x is not None), default=None)
    want = Counter((d, f"{prints[i]:016x}", least[find(parent, i)]) for i, (d, _) in enumerate(rows))
    for tile in (4096, 8):
        simhash.links.__defaults__ = (4, simhash.BLOCKS, tile)
        assert Counter(map(tuple, simhash.groups(docs(spark, rows)).collect())) == want
    simhash.links.__defaults__ = (4, simhash.BLOCKS, simhash.TILE)
    assert simhash.groups(docs(spark, [])).collect() == []


def test_streamed_shingles_equal_whole():
    text = " ".join(f"w{i % 13}" for i in range(1000))
    whole = np.concatenate(list(simhash.shingle_hashes(text, 5)))
    assert np.array_equal(whole, np.concatenate(list(simhash.shingle_hashes(text, 5, at_once=3)))) and len(whole) == 996


def test_suffix_array_order():
    rng = random.Random(4)
    for _ in range(100):
        alphabet = rng.choice([b"ab", b"a\0", bytes(range(256))])
        segments = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(5)] + [b"a" * 30]
        width = rng.choice([3, 8, 19])
        suffixes, at = {}, 0
        for s in segments:
            suffixes |= {at + i: s[i : i + width] for i in range(len(s))}
            at += len(s) + 1
        data, ends = np.frombuffer(b"\0".join(segments) + bytes(9), np.uint8), np.cumsum([len(s) + 1 for s in segments]) - 1
        order = suffix_dedup.suffix_array(data, ends, width).tolist()
        assert sorted(order) == sorted(suffixes) and [suffixes[i] for i in order] == sorted(suffixes.values())


def test_suffix_dedup_against_brute_force(spark):
    rng = random.Random(5)
    shared = ["".join(rng.choice("abcdé") for _ in range(rng.randint(10, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice("abcdefghijklmnop é\0") for _ in range(rng.randint(0, 80)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(shared) + text[at:]
        rows.append((i, text))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1]), (None, None), (202, "z" * 100), (203, ""), (204, "xy" * 20), (None, shared[0] * 4)]
    width, data = 20, [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    want = Counter()
    for (doc_id, _), d in zip(rows, data, strict=True):
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want[(doc_id, len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone, strict=True) if not g))] += 1
    for hot in (8192, 2):
        got = suffix_dedup.remove_repeats(docs(spark, rows), width=width, gram=6, hot=hot).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert suffix_dedup.remove_repeats(docs(spark, [])).collect() == []


def test_suffix_dedup_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 1000)
    rng = random.Random(6)
    a = "".join(rng.choice("abcdefgh") for _ in range(5000))
    b = "".join(rng.choice("abcdefgh") for _ in range(700)) + a[1234:3456] + "!" * 150
    batch = [(1, a), (2, b)]
    tables = suffix_dedup._segments(200, 32, False)
    import pyarrow as pa

    rb = pa.RecordBatch.from_arrays([pa.array([t for _, t in batch]), pa.array([1, 2], pa.int64()), pa.array([len(t) for _, t in batch], pa.int32())], names=["text", "k", "n"])
    covered = Counter()
    for out in tables(iter([rb])):
        for r in out.to_pylist():
            for w in range(r["shape"] >> 16):
                covered[(r["k"], r["lo"] + w)] += 1
    assert covered == Counter({(k, i): 1 for k, t in batch for i in range(len(t) - 199)})
