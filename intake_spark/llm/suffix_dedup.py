"""Remove passages that occur elsewhere, by suffix arrays built in two stages.

A corpus-wide suffix array would order every suffix in one place. Only whether a window of `width` bytes starts elsewhere is asked,
so suffixes are dealt out first: each window belongs to the place in it with the smallest hash of GRAM bytes (the leftmost, if tied), which
depends on the window's bytes alone. Windows in a row that share a place form a segment; equal windows meet under the hash of their place.
Places that occur once are left out. Equal segments of the others (64-bit hashes next to that of the place) are counted. The first and the last copy of
each that is counted twice go into a suffix array; where many in a row have their copies in the same two texts, as one run of both. Where different
segments meet under a place, one copy of each goes into an array with the others. Arrays take a few megabytes at a time:

- stage one sorts directly only the suffixes that are smaller than their successors;
- stage two scans the buckets of first bytes in order and induces each remaining suffix from its successor;
- common prefixes of neighbours then tell which windows are repeated. What they tell of two copies holds for all copies of that segment.

A place that many texts share (the edge of a common passage) would hold segments without bound. The segments of a place with over CROWD
of them are cut again, by the smallest hash of a longer run of bytes, and so on up to runs of a whole window; whatever the step, equal windows meet
and arrays decide where different segments do (there alone, equal ones are repeated by their count). No step gathers a place in one task to count it.

Nulls: a null text counts as empty, a null id is kept. Repeated rows are occurrences of their own. Texts under width bytes lose nothing.
Very long texts are cut in runs of BUFFER bytes that overlap by a window; Spark's limit of 2 GB a text holds. Empty input gives an empty
result. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of, written

WIDTH, GRAM, CROWD = 200, 104, 512
BUFFER, ARRAY_BYTES, BATCH_BYTES = 512 << 10, 2 << 20, 8_000_000
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
SEGMENT = "anchor bigint, seg bigint, shape int, k bigint, n int, lo int"
SPAN = "anchor bigint, k bigint, n int, start int, end int"


@lru_cache(maxsize=1)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and `size` powers of the multiplier, and of its inverse modulo 2^64."""
    power = lambda base: np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, base, np.uint64))])
    symbols = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return symbols, power(np.uint64(MULTIPLIER)), power(np.uint64(pow(MULTIPLIER, -1, 1 << 64)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substrings of a buffer, from one running sum."""

    def __init__(self, data: np.ndarray):
        symbols, powers, self.inverse = _tables(max(4 * BUFFER, 1 << len(data).bit_length()))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(symbols[data] * powers[: len(data)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def _least(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each `span` keys in a row."""
    rows = -(-len(keys) // span)
    table = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    table[: len(keys)] = keys
    table = table.reshape(rows, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - span + 1
    return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])


def cut_segments(parts: list[tuple[int, int, np.ndarray]], width: int, gram: int) -> tuple[np.ndarray, ...]:
    """For byte runs (document, place in it, bytes): document, lo, windows, offset of the place, its hash and the segment's, of all segments."""
    data = np.concatenate([p[2] for p in parts])
    sizes = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(sizes)
    hashes = Hashes(data)
    grams = hashes.all(gram)
    keys = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    place = (_least(keys, width - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    starts = np.arange(len(place))
    part = np.searchsorted(ends, starts, side="right")
    good = starts + width <= ends[part]
    starts, part, place = starts[good], part[good], place[good]
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (part[1:] != part[:-1])])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(starts)))
    lo, at, of = starts[first], place[first], part[first]
    anchor, seg = grams[at].view(np.int64), hashes.of(lo, lo + windows + width - 1).view(np.int64)
    begin = (ends - sizes)[of]
    base = np.array([p[1] for p in parts])[of]
    return np.array([p[0] for p in parts])[of], lo - begin + base, windows, at - lo, anchor, seg


def _cuts(batch: pa.RecordBatch, width: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """cut_segments over the first column of a batch, about BUFFER bytes at a time; the document is the row of the batch."""
    parts, size = [], 0
    for i, text in enumerate(batch.column(0)):
        data = np.frombuffer(text.as_buffer(), np.uint8)
        for at in range(0, max(1, len(data) - width + 1), BUFFER):
            parts.append((i, at, data[at : at + BUFFER + width - 1]))
            size += len(parts[-1][2])
            if size >= BUFFER:
                yield cut_segments(parts, width, gram)
                parts, size = [], 0
    if parts:
        yield cut_segments(parts, width, gram)


def _segments(width: int, gram: int, only_places: bool):
    """Arrow function from (text, k, n) to SEGMENT (shape: windows and, in the low 16 bits, the offset of the place); only_places: to the places (anchor)
    and how often they occur, equal ones of a cut together."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for doc, lo, windows, offset, anchor, seg in _cuts(batch, width, gram):
                if only_places:
                    anchors, times = np.unique(anchor, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(times, pa.int64())], names=["anchor", "times"])
                    continue
                columns = [anchor, seg, (windows * 65536 + offset).astype(np.int32), k[doc], n[doc].astype(np.int32), lo.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "seg", "shape", "k", "n", "lo"])

    return each


def _cut_again(width: int, gram: int):
    """Arrow function from (data, k, n, lo, times), segments of a crowded place, to smaller segments: SEGMENT, times and data."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(0)
            k, n, base, times = (batch.column(i).to_numpy() for i in range(1, 5))
            for piece, lo, windows, offset, anchor, seg in _cuts(batch, width, gram):
                own = [data[p].as_buffer()[a : a + w + width - 1].to_pybytes() for p, a, w in zip(piece.tolist(), lo.tolist(), windows.tolist(), strict=True)]
                columns = [anchor, seg, (windows * 65536 + offset).astype(np.int32), k[piece], n[piece], (base[piece] + lo).astype(np.int32), times[piece]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], pa.array(own, pa.binary())], names=["anchor", "seg", "shape", "k", "n", "lo", "times", "data"])

    return each


def _loaded(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, without a copy."""
    return np.ndarray(len(data) - 7, np.dtype("<u8"), data, strides=(1,))


def _words(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes at each place as a big-endian number, zero beyond the `left` bytes there; data has 8 bytes to spare at its end."""
    loaded = _loaded(data)[np.minimum(at, len(data) - 8)].byteswap()
    if left.min(initial=8) >= 8:
        return loaded
    beyond = (8 - np.clip(left, 0, 8)).astype(np.uint64) * np.uint64(8)
    return np.where(beyond < 64, (loaded >> np.minimum(beyond, np.uint64(63))) << np.minimum(beyond, np.uint64(63)), np.uint64(0))


def sort_directly(data: np.ndarray, at: np.ndarray, left: np.ndarray, width: int) -> np.ndarray:
    """Order of the suffixes at `at` by their first width bytes; `left` bytes remain in each. An ended suffix is smaller.

    A group of suffixes that agree so far goes on where they differ: blocks that have the same hash in all of them are passed over, then 8 bytes
    are sorted by. A group is done when all of it has the same hash of what counts; equal suffixes need no order.
    """
    hashes, left = Hashes(data), np.minimum(left, width)
    order, active = np.arange(len(at)), np.arange(len(at))
    starts, depth = np.zeros(min(1, len(at)), np.int64), np.zeros(len(at), np.int64)

    def block(rows: np.ndarray, a: np.ndarray, size: int) -> np.ndarray:
        """Identity of up to `size` bytes from a on."""
        end = np.minimum(a + size, left[rows])
        a = np.minimum(a, end)
        return hashes.of(at[rows] + a, at[rows] + end) ^ (end - a).astype(np.uint64) * np.uint64(MULTIPLIER)

    def alike(values: np.ndarray) -> np.ndarray:
        """Whether all of a group are the same, for each of the group."""
        return np.repeat(np.minimum.reduceat(values, starts) == np.maximum.reduceat(values, starts), np.diff(np.append(starts, len(values))))

    while len(active):
        rows = order[active]
        for size in (64, 16) if len(starts) > 1 else ():
            depth += np.where(alike(block(rows, depth, size)), size, 0)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(active))))
        rest = np.clip(left[rows] - depth, 0, 8)
        words = _words(data, at[rows] + np.minimum(depth, left[rows]), rest)
        by = np.lexsort((rest, words, group))
        order[active] = rows = rows[by]
        words, rest, depth = words[by], rest[by], depth[by] + 8
        new = np.concatenate([[True], (words[1:] != words[:-1]) | (rest[1:] != rest[:-1]) | (group[1:] != group[:-1])])
        starts = np.flatnonzero(new)
        more = ~alike(block(rows, np.zeros(len(rows), np.int64), width))
        active, depth, new = active[more], depth[more], new[more]
        starts = np.flatnonzero(new)
    return order


def suffix_array(data: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Suffixes of segments in order of their first width bytes. data: bytes of all segments, each with one byte to spare at its end
    (the places `ends`), and 8 more at the end of all."""
    size = int(ends[-1]) + 1
    symbols = data[:size].astype(np.int16)
    symbols[ends] = -1
    left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(size)
    # Smaller than its successor: decided by the next other symbol.
    change = np.flatnonzero(symbols[1:] != symbols[:-1])
    run_end = np.append(change, size - 1)
    smaller_run = np.append(symbols[change] < symbols[change + 1], False)
    smaller = np.repeat(smaller_run, np.diff(run_end, prepend=-1))
    smaller[ends] = True  # the end marks are placed first, by themselves
    direct = np.flatnonzero(smaller & (symbols >= 0))
    direct = direct[sort_directly(data, direct, left[direct], width)]
    by_symbol = np.searchsorted(symbols[direct], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    placed = []

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = symbols[before]
        order = np.argsort(first.astype(np.uint8), kind="stable")
        before, first = before[order], first[order]
        for a, b in zip((starts := np.flatnonzero(np.diff(first, prepend=-2))).tolist(), [*starts[1:].tolist(), len(first)], strict=False):
            buckets[first[a]].append(before[a:b])

    induce(ends)
    for symbol in range(256):
        inside = np.concatenate(buckets[symbol]) if buckets[symbol] else np.zeros(0, np.int64)
        runs = [inside]
        while len(inside):
            before = inside[inside > 0] - 1
            inside = before[~smaller[before] & (symbols[before] == symbol)]
            runs.append(inside)
        bucket = np.concatenate([*runs, direct[by_symbol[symbol] : by_symbol[symbol + 1]]])
        if len(bucket):
            placed.append(bucket)
            before = bucket[bucket > 0]
            induce(before[symbols[before - 1] > symbol])
    return np.concatenate(placed) if placed else np.zeros(0, np.int64)


def repeated(segments: list[bytes], width: int) -> np.ndarray:
    """Over the segments with a byte between them: whether the width bytes that start there also start elsewhere."""
    data = np.frombuffer(b"\0".join(segments) + bytes(9), np.uint8)
    ends = np.cumsum([len(s) + 1 for s in segments]) - 1
    order = suffix_array(data, ends, width)
    left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(int(ends[-1]) + 1)
    a, b = order[:-1], order[1:]
    keep = (left[a] >= width) & (left[b] >= width)
    after = np.full(len(data), -1)
    after[a[keep]] = b[keep]
    a = np.flatnonzero(after >= 0)  # in the order of the bytes, which are then read one after the other
    b, words = after[a], _loaded(data)
    for come in range(0, width, 8):  # how far neighbours agree; those that do up to width remain
        if come + 8 <= width:
            same = words[a + come] == words[b + come]
        else:
            same = _words(data, a + come, np.full(len(a), width - come)) == _words(data, b + come, np.full(len(b), width - come))
        if not same.all():
            a, b = a[same], b[same]
    flags = np.zeros(int(ends[-1]) + 1, bool)
    flags[a] = flags[b] = True
    return flags


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _array_spans(width: int):
    """Arrow function from (anchor, seg, shape, k, n, lo, times, data), sorted by anchor, to the spans of segments that occur once."""
    names = pa.schema([("anchor", pa.int64()), ("k", pa.int64()), ("n", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def solve(held: list[dict]) -> pa.RecordBatch:
        flags, at, out = repeated([r["data"] for r in held], width), 0, []
        for r in held:
            if r["times"] == 1:
                windows = flags[at : at + len(r["data"]) - width + 1]
                out += [{"anchor": r["anchor"], "k": r["k"], "n": r["n"], "start": r["lo"] + a, "end": r["lo"] + b - 1 + width} for a, b in _ranges(windows)]
            at += len(r["data"]) + 1
        return pa.RecordBatch.from_pylist(out, schema=names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if size >= ARRAY_BYTES and r["anchor"] != last["anchor"]:
                    yield solve(held)
                    held, size = [], 0
                if last is None or (r["anchor"], r["seg"], r["shape"]) != (last["anchor"], last["seg"], last["shape"]):
                    held.append(r)
                    size += len(r["data"])
                last = r
        if held:
            yield solve(held)

    return each


def _end(width: int):
    """Where a segment ends in its text."""
    return F.col("lo") + F.floor(F.col("shape") / 65536).cast("int") + (width - 1)


def _met(kinds: DataFrame) -> DataFrame:
    """Stored kinds of segments (anchor, seg, shape, times, ...) that are repeated or meet others, with how many meet at the place and how many of those
    occur once. Places are counted with map-side sums and stored, so that Spark can split the join with a crowded one."""
    places = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("times") == 1).alias("once"))
    return kinds.join(written(places, "places"), "anchor").filter("times > 1 OR kinds > 1")


def _solved(pieces: DataFrame, width: int) -> DataFrame:
    """Spans (SPAN) of the repeated windows among pieces (SEGMENT, times, data) of places that are not crowded, and of runs; those of pieces that occur once."""
    columns = ["anchor", "seg", "shape", "k", "n", "lo", "times", "data"]
    dealt = pieces.select(columns).repartition("anchor").sortWithinPartitions("anchor", "seg", "shape")
    return dealt.mapInArrow(_array_spans(width), SPAN)


def _runs(repeats: DataFrame) -> DataFrame:
    """Kinds that occur twice or more (anchor, seg, shape, and their first and last copy), with the run they lie in: kinds in a row whose first copies lie
    in one text and whose last ones in one text, as far apart. A run begins anew after BUFFER bytes. No group holds more than a text has."""
    near, far = F.col("rep"), F.col("last")
    flat = repeats.select(
        "anchor", "seg", "shape", near.k.alias("k"), near.n.alias("n"), near.lo.alias("lo"), far.k.alias("far_k"), far.n.alias("far_n"),
        (far.lo - near.lo).alias("apart"), "size", (near.lo + F.col("size")).alias("end"),
    )
    pair = ["k", "n", "far_k", "far_n", "apart"]
    order = Window.partitionBy(*pair, F.floor(F.col("lo") / BUFFER)).orderBy("lo")
    begins = F.coalesce(F.lag("end").over(order) < F.col("lo"), F.lit(True))
    begun = flat.withColumn("begins", begins).withColumn("first", F.max(F.when(F.col("begins"), F.col("lo"))).over(order))
    return begun.drop("begins").withColumn("run", F.xxhash64(*pair, "first"))


def repeated_spans(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = CROWD) -> DataFrame:
    """texts (text, k, n: bytes) to spans (k, n, start, end) in bytes; together they cover what is repeated. hot: segments that make a place crowded."""
    key = ["anchor", "seg", "shape"]
    long = texts.filter(F.col("n") >= width).select("text", "k", "n")
    # Segments of places that occur more than once; the rest can't be repeated.
    again = long.mapInArrow(_segments(width, gram, True), "anchor bigint, times bigint").groupBy("anchor").agg(F.sum("times").alias("times")).filter("times > 1").select("anchor")
    again = written(again, "places")
    segments = written(long.mapInArrow(_segments(width, gram, False), SEGMENT).join(again, "anchor", "left_semi"), "segments")
    copy = F.struct("k", "n", "lo")
    kinds = segments.groupBy(*key).agg(F.count("*").alias("times"), F.min(copy).alias("rep"), F.max(copy).alias("last"))
    live = written(_met(written(kinds, "kinds")).withColumn("size", F.floor(F.col("shape") / 65536).cast("int") + (width - 1)), "kinds")

    # Copies of the repeated kinds, two of each, as runs; then those that meet others at their place.
    repeats = written(_runs(live.filter("times > 1")), "runs")
    runs = repeats.groupBy("run", "k", "n", "far_k", "far_n", "apart", "first").agg((F.max("end") - F.col("first")).alias("size"))
    side = lambda k, n, lo, seg: F.struct(
        F.col(k).alias("k"), F.col(n).alias("n"), lo.cast("int").alias("lo"), F.col("run").alias("anchor"), F.lit(seg).cast("bigint").alias("seg"),
        F.lit(0).alias("shape"), F.lit(seg + 1).cast("bigint").alias("times"), F.lit(0).cast("bigint").alias("kinds"), F.col("size").cast("int").alias("size"),
    )
    sides = F.array(side("k", "n", F.col("first"), 0), side("far_k", "far_n", F.col("first") + F.col("apart"), 1))
    wanted = live.filter("kinds > 1 AND once > 0").select("rep.*", *key, "times", "kinds", "size").unionByName(runs.select(F.inline(sides)))
    asked = wanted.groupBy("k", "n").agg(F.collect_list(F.struct("lo", *key, "times", "kinds", "size")).alias("asked"))
    taken = long.join(asked, ["k", "n"]).select("k", "n", F.encode("text", "utf-8").alias("bytes"), F.explode("asked").alias("x"))
    pieces = written(taken.select("x.*", "k", "n", F.expr("substring(bytes, x.lo + 1, x.size)").alias("data")), "pieces")
    decided = written(_solved(pieces.filter(F.col("kinds") <= hot), width), "decided")
    inside = (F.col("r.run") == F.col("d.anchor")) & (F.col("r.k") == F.col("d.k")) & (F.col("r.n") == F.col("d.n"))
    inside = inside & (F.col("r.lo") >= F.col("d.start")) & (F.col("r.end") <= F.col("d.end"))
    whole = repeats.alias("r").join(decided.alias("d"), inside, "left_semi").select(key)
    spans = segments.join(whole, key, "left_semi").select("k", "n", F.col("lo").alias("start"), _end(width).alias("end"))
    spans = spans.unionByName(decided.drop("anchor"))

    crowded = pieces.filter(F.col("kinds") > hot)
    while gram < width and not crowded.isEmpty():
        gram = min(width, gram + max(8, (width - gram) // 2))
        smaller = written(crowded.select("data", "k", "n", "lo", "times").mapInArrow(_cut_again(width, gram), SEGMENT + ", times bigint, data binary"), "smaller-segments")
        kinds = smaller.groupBy(*key).agg(F.sum("times").alias("times"), F.min(F.struct("k", "n", "lo", "data")).alias("rep"))
        live = written(_met(kinds), "kinds")
        whole = smaller.filter("times = 1").join(live.filter("times > 1").select(key), key, "left_semi")
        pieces = live.filter("kinds > 1 AND once > 0").select(*key, "rep.*", "times", "kinds")
        spans = spans.unionByName(whole.select("k", "n", F.col("lo").alias("start"), _end(width).alias("end"))).unionByName(_solved(pieces.filter(F.col("kinds") <= hot), width).drop("anchor"))
        crowded = pieces.filter(F.col("kinds") > hot)
    return spans


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = CROWD, id_column="doc_id", text_column="text") -> DataFrame:
    """Per row of docs: id, n_bytes, n_removed, n_spans and kept (the remaining bytes)."""
    text = text_of(docs, text_column)
    keyed = docs.select(docs[id_column].alias("id"), text.alias("text"), F.xxhash64(docs[id_column], text).alias("k"), F.octet_length(text).cast("int").alias("n"))
    spans = repeated_spans(keyed, width, gram, hot).groupBy("k", "n").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = []
            size = 0
            for row, (text, spans) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                data, runs = text.as_buffer().to_pybytes(), []
                for s in spans.as_py() or ():
                    if runs and s["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["end"])
                    else:
                        runs.append([s["start"], s["end"]])
                edges = [0, *[x for run in runs for x in run], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((row, len(data), len(data) - len(kept), len(runs), kept))
                size += len(kept)
                if size > BATCH_BYTES:
                    yield made(batch, out)
                    out, size = [], 0
            yield made(batch, out)

    def made(batch, out):
        row, n, removed, spans, kept = zip(*out, strict=True) if out else ((), (), (), (), ())
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (n, removed, spans)], pa.array(kept, pa.binary())], names=[id_column, "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())])
    return keyed.join(spans, ["k", "n"], "left").select("id", "text", "spans").mapInArrow(cut, schema)
