"""Words of one polynomial hash (a Thue-Morse word of 1,024 letters and its complement) are told apart by their characters."""

import numpy as np
import corpus_pipeline as cp
from intake_spark.llm import queries, tokens
from tokenizers import Tokenizer

WORD = "".join("ab"[i.bit_count() & 1] for i in range(1024))
OTHER = WORD.translate(str.maketrans("ab", "ba"))
TEXTS = [f"{WORD}\n{OTHER}", WORD, OTHER, f"{OTHER} {WORD} and {OTHER}", f"x {WORD}", f"x {OTHER}"]


def want(text):
    return Tokenizer.from_file(tokens.default_path()).encode(text, add_special_tokens=False).ids


def test_the_words_do_collide():
    codes = lambda w: np.frombuffer(w.encode("utf-32-le"), "<u4")
    hashed = [((codes(w) + np.uint64(1)) * tokens._POWERS[:1024]).sum() for w in (WORD, OTHER)]
    assert hashed[0] == hashed[1] and WORD != OTHER


def test_encoder_equals_library():
    for texts in (TEXTS[:1], TEXTS[1:3], TEXTS):
        assert [np.frombuffer(x, "<u4").tolist() for x in tokens.Encoder(tokens.default_path(), added=True).encode(texts)] == [want(t) for t in texts]


def test_pre_tokens_that_are_parted_in_another_way(monkeypatch):
    words = tokens._Words(Tokenizer.from_file(tokens.default_path()))
    words.spaced[:] = False
    assert words.make([" and", " or"]) == {w: np.array(want(w), "<u4").tobytes() for w in (" and", " or")}


def test_queries(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lengths = {i: len(want(t)) + 1 for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in queries.op3_token_sstables(spark, str(tmp_path)).collect()} == lengths
    assert {r.doc_id: r.doc_tokens for r in queries.op9_pack_bin_slack(spark, str(tmp_path)).collect()} == lengths
    assert {r.doc_id: r.doc_tokens for r in cp.pack(spark, docs, "").collect()} == lengths
