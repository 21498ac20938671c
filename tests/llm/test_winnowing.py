"""Winnowing against every window of every item looked up in every document."""

import hashlib
import random
import re

import pytest
from intake_spark.llm import queries, winnowing
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, row string, item string, _row int"
ITEMS = "item_id bigint, text string, size int"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, size=10):
    windows = {}
    for id_, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(id_)
    out = []
    for id_, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        named = sorted(str(i) for i in found if i is not None)
        out.append((id_, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "Straße", "x1", "İz", "日本", "é", "A9", "go", "we", "it", "up"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "-", "\n", "_", "\x7f"]) for _ in range(n))
    items = [(i, text(rng.choice([10, 11, 14, 30]))) for i in range(12)]
    items += [(20, text(9)), (21, text(7)), (22, "x1 go we"), (23, "unseenword"), (24, ""), (25, None), (26, "..."), (None, text(12)), (1, text(13)), (40, items[0][1]), (41, items[0][1].upper())]
    docs = []
    for i in range(150):
        parts = [text(rng.choice([0, 3, 20, 60]))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            w = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(w) - 3))
            parts += [" ".join(w[a : a + rng.randint(5, 40)]), text(rng.choice([0, 1, 8]))]
        docs.append((i, " ".join(parts)))
    docs += [(200 + i, items[0][1] + " " + items[1][1]) for i in range(60)]  # a passage that many documents share
    docs += [(300, None), (301, ""), (302, "..."), (None, items[2][1]), (5, items[3][1]), (5, items[3][1]), (303, " ".join([items[4][1]] * 400))]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "r", "i", 1) for d in docs], DOCS).repartition(3), spark.createDataFrame([(*i, 1) for i in items], ITEMS)


def digest(found):
    return sorted(((r.row.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found.collect()), key=repr)


def test_query_against_all_windows(spark, data, tmp_path):
    for name, df in zip(("documents", "benchmark"), frames(spark, *data), strict=True):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = queries.op12_winnowing(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(*data)


def test_items_in_blocks_and_other_sizes(spark, data):
    assert digest(winnowing.contaminated(*frames(spark, *data), size=10, most_windows=40)) == plain(*data)
    assert digest(winnowing.contaminated(*frames(spark, *data), size=6)) == plain(*data, size=6)


def test_carried_columns_and_spans(spark, data):
    docs, items = [(1, "a b c d e f g h i j k l")], [(7, "B c D e f g h i j k L")]
    r = winnowing.contaminated(*frames(spark, docs, items)).first()
    assert r.row.asDict() == {"doc_id": 1, "row": "r", "item": "i", "_row": 1} and [tuple(s) for s in r.spans] == [(1, 10), (2, 10)] and r.n_hit == 11 and r["items"] == ["7"]


@pytest.mark.parametrize(("docs", "items"), [(0, 0), (0, 1), (1, 0)])
def test_empty_tables(spark, data, docs, items):
    d, i = data[0][: 20 * docs], data[1][: 9 * items]
    assert digest(winnowing.contaminated(*frames(spark, d, i))) == plain(d, i)


def test_every_shared_window_has_a_selected_gram_in_both(spark):
    """The guarantee: whatever surrounds ten words, the fingerprint of their window is the same."""
    rng = random.Random(2)
    span = [str(rng.random()) for _ in range(10)]
    rows = [(" ".join(["x"] * a + [w.replace(".", "") for w in span] + ["y"] * b),) for a in range(4) for b in range(3)]
    first = span[0].replace(".", "")
    df = winnowing.with_grams(spark.createDataFrame(rows, "text string").select(winnowing.words_of(F.col("text")).alias("_words")), [10])
    at = F.array_position("_words", first).cast("int") - 1
    assert df.select(winnowing.fingerprint(at, 10, F.col("_grams_5"), 5)).distinct().count() == 1
