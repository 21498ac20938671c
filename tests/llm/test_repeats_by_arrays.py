from intake_spark.llm import suffix_dedup


def test_arrays_decide(spark, monkeypatch):
    """What equal segments share is found by the arrays: without them nothing is, and with them all copies of a passage are."""
    passage = " ".join(f"w{i * i % 977}" for i in range(400))
    texts = [f"begin {i} {passage[: 1200 + 3 * (i % 2)]} end {i * 7}" for i in range(5)] + ["other " * 3, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()}
    assert all(got[i] >= 1200 for i in range(5)) and got[5] == got[6] == 0

    whole = suffix_dedup._array_spans

    def nothing(width):
        found = whole(width)

        def each(batches):
            for batch in found(batches):
                yield batch.slice(0, 0)

        return each

    monkeypatch.setattr(suffix_dedup, "_array_spans", nothing)
    assert all(r.n_removed == 0 for r in suffix_dedup.remove_repeats(docs).collect())


def test_neighbours_of_any_width():
    """Widths that are no multiple of eight, and segments as long as a window."""
    import random

    rng = random.Random(3)
    for width in (5, 8, 13, 16):
        segments = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(width, 60))) for _ in range(20)]
        segments += [segments[0], segments[1][:width]]
        windows = [(at, s[at : at + width]) for s in segments for at in range(len(s) - width + 1)]
        times: dict = {}
        for _, w in windows:
            times[w] = times.get(w, 0) + 1
        want = [times[s[at : at + width]] > 1 if at + width <= len(s) else False for s in segments for at in range(len(s) + 1)]
        assert suffix_dedup.repeated(segments, width).tolist() == want
