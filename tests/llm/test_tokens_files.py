import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow.fs
import pytest

from intake_spark.llm import packing, sstable, tokens, warc

TEXTS = ["", None, "Hello world", "a'b 'll it's  x\n\n y ", "naïve Éenê ½ ² 12.5 3", "日本語 text", "x\x1cy\x00z", "<|endoftext|> end", "word " * 5000, "\t\r\n \x0b\x0c", "ß🙂é", "a" * 30_000]
SCHEMA = "doc_id bigint, text string, ids string, start int, page_id string"


@lru_cache(maxsize=1)
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    return t


def plain(text, end):
    return [*library().encode(text or "", add_special_tokens=False).ids, end]


def docs(spark, n=60, seed=0):
    rng = random.Random(seed)
    rows = [(rng.choice([i, -i, i * 10**12]), rng.choice(TEXTS), "x", 1, "y") for i in range(n)] + [(None, "null id", "x", 1, "y"), (5, "five", "x", 1, "y"), (5, "five", "x", 1, "y")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_encoder_equals_library():
    got = tokens.Encoder(tokens.default_path()).encode([t or "" for t in TEXTS])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain(t, 0)[:-1] for t in TEXTS]


def test_sstables_round_trip(spark):
    rows, df = docs(spark, 200)
    manifest = sstable.write_shards(df, shard_bytes=1)
    got = sorted(sstable.read_shards(manifest).collect(), key=lambda r: r.start)
    assert manifest.count() > 1 and len(got) == len(rows)
    keys = [(-(1 << 63) - 1) if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    at, want = 0, defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(plain(t, 2))
    seen = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids)
        at += len(ids)
        seen[r.doc_id].append(ids)
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    asked = spark.createDataFrame([(None,), (5,), (rows[3][0],), (123456789,)], "doc_id bigint")
    found = sstable.lookup(manifest, asked).collect()
    assert sorted(map(repr, (np.frombuffer(r.ids, "<u4").tolist() for r in found))) == sorted(map(repr, want[None] + want[5] + want[rows[3][0]]))
    assert sstable.read_shards(sstable.write_shards(df.limit(0))).collect() == []


def test_packing_keeps_every_id(spark):
    rows, df = docs(spark, 400, 3)
    pieces = packing.pack(packing.cut(df, capacity=256), capacity=256).collect()
    by, seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
        assert r.length * 4 == len(r.ids) and 0 < r.length <= 256
    tokens_in = sum(len(plain(t, 1)) for _, t, *_ in rows)
    assert sum(r.length for r in pieces) == tokens_in
    once = [i for i, *_ in rows if sum(x[0] == i for x in rows) == 1]
    text_of = {i: t for i, t, *_ in rows}
    for i in once:
        parts = sorted(by[i], key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == plain(text_of[i], 1)
        assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts[:-1]]])) and {r.doc_tokens for r in parts} == {sum(r.length for r in parts)}
    for rs in seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert packing.pack(packing.cut(df.limit(0))).collect() == []


def test_fill_is_optimal_and_windows_waste_little():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(6)}
        gap, sums = rng.randint(1, 80), {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        picked = packing.fill(sorted(counts, reverse=True), counts, gap)
        assert all(0 < n <= counts[x] for x, n in picked)
        assert sum(x * n for x, n in picked) == max(s for s in sums if s <= gap)
    lengths = np.array([rng.randint(1, 2047) for _ in range(5000)])
    window, _ = packing.windows(lengths, 2048)
    assert (window.max() + 1) * 2048 - lengths.sum() < 12 * 2048


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "z", 1) for i, u, h in rows], "page_id bigint, url string, html string, row string, data int")


@pytest.mark.parametrize("least", [0, 10])
def test_warc_round_trip(spark, least):
    big = "".join(random.Random(5).choice("abc é\r\n") for _ in range(700_000))
    rows = [(1, "http://a/x y", "same"), (2, None, "same"), (3, "http://a/é\n", big), (4, "u", big), (5, "u", None), (6, "u", ""), (None, "u", "same"), (7, "u", "alone\r\n\r\nWARC/1.1\r\n"), (2, None, "same"), (8, "u", "ten bytes!"), (9, "u", "ten bytes!")]
    got = warc.read_archives(warc.archive(pages(spark, rows), min_bytes=least)).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next((h or "") for i, _, h in rows if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), warc.base32(hashlib.sha1(html.encode()).digest()))
        same = [i for i, _, h in rows if (h or "") == html]
        top = max(i for i in same if i is not None)
        if r.record_type == "revisit":
            assert r.refers_to == top and len(html.encode()) >= least
        else:
            assert r.refers_to is None and (r.page_id == top or len(html.encode()) < least)
    assert sum(r.record_type == "response" for r in got) == (5 if least == 0 else 9)
    assert warc.read_archives(warc.archive(pages(spark, []))).collect() == []


def test_warc_chunks_and_members(spark):
    payload = "0123456789" * 100
    df = pages(spark, [(1, "u", payload), (2, "u", "")])
    chunks = sorted(warc.chunk_table(df, chunk_bytes=64).collect(), key=lambda r: (r.page_id, r.chunk_no))
    assert b"".join(bytes(r.data) for r in chunks if r.page_id == 1) == payload.encode() and max(len(r.data) for r in chunks) == 64
    for r in chunks:
        assert r.digest == warc.base32(hashlib.sha1((payload if r.page_id == 1 else "").encode()[: r.bytes]).digest())
    path = warc.archive(df).first().path
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    data, heads = fs.open_input_file(root).read(), []
    while data:
        d = zlib.decompressobj(31)
        heads.append(d.decompress(data)[:8])
        data = d.unused_data
    assert heads and set(heads) == {b"WARC/1.1"}
