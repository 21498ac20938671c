import numpy as np
import corpus_pipeline as cp
from intake_spark.llm import queries, tokens
from tokenizers import Tokenizer

TEXTS = ["plain words here", "<|endoftext|>", "a <|endoftext|>b", "x<|endoftext", None, "two<|endoftext|><|endoftext|> \n", "more plain words"]


def want(text):
    """The plain call of the library."""
    return Tokenizer.from_file(tokens.default_path()).encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_added_tokens_as_the_library_does():
    got = tokens.Encoder(tokens.default_path(), added=True).encode([t or "" for t in TEXTS])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [want(t) for t in TEXTS] and want(TEXTS[1]) == [50256]


def test_queries_give_added_tokens(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lengths = {i: len(want(t)) + 1 for i, t in enumerate(TEXTS)}
    rows = queries.op3_token_sstables(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == lengths and {r.doc_id: r.start for r in rows} == {i: sum(lengths[k] for k in range(i)) for i in lengths}
    assert {r.doc_id: r.length for r in queries.op9_pack_bin_slack(spark, str(tmp_path)).collect()} == lengths
    assert {r.doc_id: r.length for r in cp.pack(spark, docs, "").collect()} == lengths
