"""SimHash near-duplicates with pivot distance tables.

A fingerprint has a bit set where over half of the text's shingle hashes have it. Equal fingerprints are one entry. Each entry gets a
table row: its Hamming distances to PIVOTS reference fingerprints. A table discards pairs that are looked at, but to look at few of
them entries have to be dealt out first: by blocks that must agree. Of BLOCKS bit blocks (more, where more entries need longer keys), at most `most` can differ, so two entries within `most` bits agree on BLOCKS - most of them, and meet under that choice of blocks.
Where entries meet, pairs whose table rows differ by more than `most` in any coordinate are discarded, the rest are verified. A meeting
place with over TILE entries is split into square tiles, so it is never one task's. A tile gives a spanning forest of its
links, not all of them; components come from contraction.

Nulls: a null text counts as empty, and empty texts have fingerprint zero; a null id never is a component's id unless all its ids
are null. Repeated rows share a component. Empty input gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parts_of, written
from .components import components

PIVOTS, BLOCKS, TILE = 16, 6, 4096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str, width: int, seed: int = 42, at_once: int | None = None) -> Iterator[np.ndarray]:
    """XXH64 of the text's shingles of lower-cased words, joined by spaces, in parts of at_once characters; fewer words than width: of them all; none: nothing."""
    digest = xxhash.xxh64_intdigest
    words: list[bytes] = []
    first = True
    for part in parts_of(text, at_once):
        words += _WORD.findall(part.encode("utf-8", "surrogatepass").translate(_LOWER))
        if len(words) < width:
            continue
        ends = np.cumsum([len(w) + 1 for w in words])
        starts, joined = np.concatenate([[0], ends[:-1]]).tolist(), b" ".join(words)
        yield np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())], np.uint64)  # noqa: B905
        words, first = words[len(words) - width + 1 :], False
    if first and words:
        yield np.array([digest(b" ".join(words), seed)], np.uint64)


def fingerprint(text: str, width: int = 4) -> int:
    """As a signed 64-bit integer."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width):
        n += len(hashes)
        for i in range(0, len(hashes), 4096):
            counts += np.unpackbits(hashes[i : i + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">i8")[0]) if n else 0


def fingerprints(docs: DataFrame, width: int = 4, id_column="doc_id", text_column="text") -> DataFrame:
    """The stored table of id and fingerprint (bigint)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py() or "", width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=[id_column, "fp"])

    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("fp", T.LongType())])
    return written(docs.select(id_column, text_column).mapInArrow(each, schema), "fingerprints")


def references(n: int = PIVOTS) -> list[int]:
    """Fixed reference fingerprints, signed."""
    return [int(np.array([xxhash.xxh64_intdigest(b"pivot %d" % i)], np.uint64).view(np.int64)[0]) for i in range(n)]


def pivot_table(entries: DataFrame) -> DataFrame:
    """fp with its distances to the references, eight to a bigint (columns near0, near1, ...)."""
    packed = []
    for group in itertools.batched(references(), 8):
        column = F.lit(0).cast("long")
        for i, ref in enumerate(group):
            column = column.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(ref))).cast("long"), 8 * i))
        packed.append(column)
    return entries.select("fp", *[c.alias(f"near{i}") for i, c in enumerate(packed)])


def blocks_for(entries: int, most: int) -> int:
    """The fewest blocks by which a few of so many entries, at random, meet at a place: the more entries, the more bits have to agree."""
    blocks = most + 2
    while blocks < 32 and entries > 4 << (64 * (blocks - most) // blocks):
        blocks += 1
    return blocks


def _masks(most: int, blocks: int) -> list[int]:
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    spans = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    return [sum(c) - (1 << 64) * (sum(c) >> 63) for c in itertools.combinations(spans, blocks - most)]


def forest(fps: np.ndarray, near: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest, as positions, of the links among the entries of one tile."""
    edges, left = [], np.arange(len(fps))
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            close = np.abs(near[left].astype(np.int16) - near[at]).max(axis=1) <= most
            close[close] = np.bitwise_count(fps[left[close]] ^ fps[at]) <= most
            found = left[close].tolist()
            edges += [(at, x) for x in found]
            frontier += found
            left = left[~close]
    return edges


def links(entries: DataFrame, most: int = 4, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints within `most` bits: enough of them to connect all that are linked."""
    masks = _masks(most, blocks)
    nears = [f"near{i}" for i in range(PIVOTS // 8)]
    meet = written(pivot_table(entries), "pivot-table").select("fp", *nears, F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "place"))
    met = meet.groupBy("choice", "place").agg(F.count("*").alias("n")).filter("n > 1").withColumn("slices", F.ceil(F.col("n") / tile).cast("int"))
    rows = meet.join(met, ["choice", "place"]).withColumn("slice", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    key = ["choice", "place", "one", "two"]
    rows = rows.select("choice", "place", F.least("slice", "with").alias("one"), F.greatest("slice", "with").alias("two"), "fp", *nears)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            table = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
            if len(table) == 0:
                continue
            cut = np.flatnonzero((table[1:, :4] != table[:-1, :4]).any(axis=1)) + 1
            if held and (table[0, :4] != held[-1][-1, :4]).any():
                yield solved(np.concatenate(held))
                held = []
            if len(cut) == 0:
                held.append(table)
                continue
            yield solved(np.concatenate([*held, table[: cut[-1]]]))
            held = [table[cut[-1] :]]
        if held:
            yield solved(np.concatenate(held))

    def solved(table: np.ndarray) -> pa.RecordBatch:
        """Links of whole tiles."""
        starts = np.flatnonzero(np.concatenate([[True], (table[1:, :4] != table[:-1, :4]).any(axis=1)]))
        sizes = np.diff(np.append(starts, len(table)))
        fps, near = table[:, 4].copy().view(np.uint64), np.ascontiguousarray(table[:, 5:]).view(np.uint8).reshape(len(table), -1)
        a = starts[sizes == 2]
        b = a + 1
        ok = np.abs(near[a].astype(np.int16) - near[b]).max(axis=1, initial=0) <= most
        a, b = a[ok], b[ok]
        ok = np.bitwise_count(fps[a] ^ fps[b]) <= most
        one, two = [fps[a[ok]]], [fps[b[ok]]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = slice(start, start + size)
            edges = np.array(forest(fps[own], near[own], most), np.int64).reshape(-1, 2) + start
            one.append(fps[edges[:, 0]]), two.append(fps[edges[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in (one, two)], names=["a", "b"])

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(tiles, "a bigint, b bigint").distinct()


def _components(prints: DataFrame, most: int, id_column: str) -> DataFrame:
    """The stored table of fp, component_id, and the id and fingerprint (rep_fp) of the component's first row."""
    entries = written(prints.groupBy("fp").agg(F.min(id_column).alias("_first")), "entries")
    roots = components(links(entries.select("fp"), most, blocks_for(entries.count(), most)))
    rooted = entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min(F.when(F.col("_first").isNotNull(), F.struct("_first", "fp"))).alias("rep"))
    return written(rooted.join(least, "root").select("fp", F.col("rep._first").alias("component_id"), F.col("rep.fp").alias("rep_fp")), "fp-components")


def groups(docs: DataFrame, width: int = 4, most: int = 4, id_column="doc_id", text_column="text") -> DataFrame:
    """Per row of docs: id, fingerprint (16 hex digits) and component_id, the smallest id that links reach."""
    prints = fingerprints(docs, width, id_column, text_column)
    return prints.join(_components(prints, most, id_column).drop("rep_fp"), "fp").select(id_column, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
