"""Near copies by similarity: Jaccard of the sets of word shingles, exact for every pair that is looked at.

Entries are first held against each other by SimHash and pivot tables, as op 6 does: of the fingerprints of the sets, those within CLOSE bits are found by
blocks and pivot distances, and the pairs are verified. SimHash bits alone can't deal entries out at this similarity (0.8 is about 10 of 64 bits, and any block
of bits that pairs so far apart still share is shared by most others), so what is still apart meets by BANDS keys of ROWS smallest shingles each, under seeded orders: two at 0.8 share a key but for 1 in
2,800. Where they meet, pairs whose sizes rule the similarity out, or whose fingerprints (of the set) differ in over MOST of 64 bits, are discarded;
the rest are verified by their shingle sets, and verified links make components.

In a group of n copies, pairs grow with its square. So each entry is then held against one centre of each place, STARS times, which
connects a group of any size by as many pairs as it has entries. Where entries of different components still meet, the place is split into tiles of bounded
size; a tile holds the shingle sets of its entries, compares those of different components, and gives only links that
connect what was apart. No pair that meets is left out, but those whose ends are connected already, and no pairs are listed.

Nulls: a null text counts as empty, and texts without words are alike; rows with a null id stay. Empty input gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .caches import TEXT_ROWS, give_back
from .common import join_small, sliced, text_of, written
from .components import components
from .simhash import blocks_for, links as simhash_links, shingle_hashes

BANDS, ROWS, MOST, STARS, CLOSE = 20, 5, 22, 2, 4
#: Entries of a slice of a crowded place, and shingles of all of them, about; a tile holds two slices.
SLICE, SLICE_SHINGLES = 2048, 1 << 20
#: Rows with shingle sets that go to Python at once.
ARROW_ROWS = 256
_ODD = np.random.default_rng(6).integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = np.random.default_rng(7).integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str, width: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, width)]))


def set_bits(hashes: np.ndarray) -> int:
    """The SimHash fingerprint of a set, as a signed 64-bit integer."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[i : i + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def places(hashes: np.ndarray) -> np.ndarray:
    """The BANDS keys of a set; the empty set has one."""
    if not len(hashes):
        return np.zeros(1, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, (_ODD * hashes[None, i : i + 1024]).min(axis=1), out=least)
    return (least.reshape(BANDS, ROWS) * _JOIN).sum(axis=1, dtype=np.uint64).view(np.int64)


def _keyed(docs: DataFrame, text_column: str) -> Column:
    return F.xxhash64(text_of(docs, text_column))


def sketches(docs: DataFrame, width: int, id_column: str, text_column: str) -> DataFrame:
    """The stored table of id, node (hash of the text), bits, n (shingles) and places."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (part for batch in batches for part in sliced(batch, 64)):
            sets = [shingle_set(t.as_py() or "", width) for t in some.column(2)]
            columns = [some.column(0), some.column(1), pa.array([set_bits(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([places(s) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "node", "bits", "n", "places"])
        give_back()

    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *[T.StructField(c, T.LongType()) for c in ("node", "bits", "n")], T.StructField("places", T.ArrayType(T.LongType()))])
    return written(docs.select(id_column, _keyed(docs, text_column).alias("node"), text_column).mapInArrow(each, schema), "sketches", TEXT_ROWS)


def sets_of(nodes: DataFrame, docs: DataFrame, width: int, text_column: str) -> DataFrame:
    """The stored shingle sets (node, shingles) of the nodes."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (part for batch in batches for part in sliced(batch, 64)):
            made = [shingle_set(t.as_py() or "", width).tobytes() for t in some.column(1)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(made, pa.binary())], names=["node", "shingles"])
        give_back()

    nodes = written(nodes.select("node").distinct(), "candidates")
    texts = docs.select(_keyed(docs, text_column).alias("node"), text_of(docs, text_column).alias("text"))
    texts = join_small(texts, nodes, ["node"], nodes.count(), "left_semi", 1_000_000).dropDuplicates(["node"])
    return written(texts.mapInArrow(each, "node bigint, shingles binary"), "shingle-sets", TEXT_ROWS)


def verified(pairs: DataFrame, docs: DataFrame, width: int, least: float, text_column: str) -> DataFrame:
    """The stored table of those of the stored pairs (a, b) whose texts have a similarity of `least` or more."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), docs, width, text_column)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                ok.append(both >= least * (len(one) + len(two) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    side = lambda name, column: sets.select(F.col("node").alias(name), F.col("shingles").alias(column))
    found = pairs.join(side("a", "_one"), "a").join(side("b", "_two"), "b").select("a", "b", "_one", "_two").mapInArrow(alike, "a bigint, b bigint")
    return written(found, "links", ARROW_ROWS)


def tile_links(nodes: np.ndarray, bits: np.ndarray, slices: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], least: float, most: int) -> list[tuple[int, int]]:
    """Links, as positions, that connect what is apart (by roots) among the entries of a tile; of two slices, only from one to the other."""
    _, comp = np.unique(roots, return_inverse=True)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    shingles, ids = np.unique(flat, return_inverse=True)
    starts, mark, across, out = np.cumsum(sizes) - sizes, np.zeros(len(shingles) + 1, bool), slices.min() != slices.max(), []
    for at in range(len(nodes) - 1):
        rest = np.arange(at + 1, len(nodes))
        near = (comp[rest] != comp[at]) & (np.bitwise_count(bits[rest] ^ bits[at]) <= most) & (np.minimum(sizes[rest], sizes[at]) >= least * np.maximum(sizes[rest], sizes[at]) - 1e-9)
        rest = rest[near & (slices[rest] != slices[at])] if across else rest[near]
        if not len(rest):
            continue
        own = ids[starts[at] : starts[at] + sizes[at]]
        mark[own] = True
        # The shingles of all the rest in a row, and how many of each are among those of `at`.
        ends = np.cumsum(sizes[rest])
        places = np.repeat(starts[rest] - (ends - sizes[rest]), sizes[rest]) + np.arange(ends[-1])
        hits = np.concatenate([[0], np.cumsum(mark[ids[places]])])
        both = hits[ends] - hits[ends - sizes[rest]]
        mark[own] = False
        for x in rest[both >= least * (sizes[at] + sizes[rest] - both) - 1e-9].tolist():
            if comp[x] != comp[at]:
                out.append((at, x))
                comp[comp == comp[x]] = comp[at]
    return out


def tiled(rows: DataFrame, docs: DataFrame, width: int, least: float, text_column: str, most: int) -> DataFrame:
    """The stored links (a, b) among the stored rows (band, place, node, bits, n, root) that meet and are apart."""
    key = ["band", "place"]
    sets = sets_of(rows, docs, width, text_column)
    slices = F.ceil(F.greatest(F.count("*") / SLICE, F.sum("n") / SLICE_SHINGLES)).cast("int")
    cut = rows.join(rows.groupBy(*key).agg(slices.alias("slices")), key).withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumns({"one": F.least("slice", "with"), "two": F.greatest("slice", "with")})
    tile = [*key, "one", "two"]
    dealt = cut.join(sets, "node").select(*tile, "node", "bits", "slice", "root", "shingles").repartition(*tile).sortWithinPartitions(*tile, "node")

    def solved(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        nodes, bits, slice_, roots = (table.column(i).to_numpy() for i in range(4, 8))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column(8)]
        found = np.array(tile_links(nodes, bits.view(np.uint64), slice_, roots, sets, least, most), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(nodes[found[:, i]], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for a, b in itertools.pairwise(edges):
                if held and tuple(keys[a]) != last:
                    yield solved(held)
                    held = []
                last = tuple(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield solved(held)
        give_back()

    return written(dealt.mapInArrow(each, "a bigint, b bigint"), "links", ARROW_ROWS)


def close_links(entries: DataFrame, docs: DataFrame, width: int, least: float, text_column: str) -> DataFrame:
    """The stored links (a, b) that SimHash finds: entries with fingerprints within CLOSE bits, or equal ones, by blocks and pivot tables; verified by their texts.

    Of equal fingerprints each is held against that with the smallest node, which stands for them.
    """
    heads = written(entries.groupBy("bits").agg(F.min("node").alias("head")), "fingerprints")
    same = entries.join(heads, "bits").filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    near = simhash_links(heads.select(F.col("bits").alias("fp")), CLOSE, blocks_for(heads.count(), CLOSE))
    end = lambda c: heads.select(F.col("bits").alias(c), F.col("head").alias(f"_{c}"))
    near = near.join(end("a"), "a").join(end("b"), "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    return verified(written(same.unionByName(near), "pairs"), docs, width, least, text_column)


def near_components(entries: DataFrame, docs: DataFrame, width: int, least: float, text_column: str, most: int = MOST, stars: int = STARS) -> DataFrame:
    """(node, root) of the entries (node, bits, n, places) that are linked to another."""
    key = ["band", "place"]
    meet = entries.select("node", "bits", "n", F.posexplode("places").alias("band", "place"))
    met = meet.groupBy(*key).agg(F.count("*").alias("_met")).filter("_met > 1").select(*key)
    meet = written(meet.join(met, key), "meeting-places")
    links = close_links(entries, docs, width, least, text_column)
    roots = components(links)
    for turn in range(stars + 1):
        rows = meet.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = rows.groupBy(*key).agg(F.min("root").alias("_r"), F.max("root").alias("_s")).filter("_r <> _s").select(*key)
        rows = written(rows.join(apart, key), "open-places")
        if turn == stars:
            found = tiled(rows, docs, width, least, text_column, most)
        else:
            first = rows.groupBy(*key).agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", "bits", "n", "root")).alias("c"))
            centre = first.select(*key, *[F.col(f"c.{c}").alias(f"_{c}") for c in ("node", "bits", "n", "root")])
            near = (F.bit_count(F.col("bits").bitwiseXOR(F.col("_bits"))) <= most) & (F.least("n", "_n") >= F.lit(least) * F.greatest("n", "_n") - 1e-9)
            pairs = rows.join(centre, key).filter(near & (F.col("root") != F.col("_root")))
            pairs = written(pairs.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct(), "pairs")
            found = verified(pairs, docs, width, least, text_column)
        links = links.unionByName(found)
        roots = components(links)
    return roots


def drop_similar(docs: DataFrame, width: int = 5, least: float = 0.8, id_column="doc_id", text_column="text") -> DataFrame:
    """The rows of docs with one of each component of similar texts kept: the one with the smallest id. Rows with a null id stay.

    Of rows that share the id and the text, one stays.
    """
    made = sketches(docs, width, id_column, text_column)
    entries = written(made.groupBy("node").agg(F.min(id_column).alias("_first"), *[F.first(c).alias(c) for c in ("bits", "n", "places")]), "entries")
    roots = near_components(entries, docs, width, least, text_column)
    rooted = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).filter("_first IS NOT NULL")
    kept = rooted.groupBy("root").agg(F.min(F.struct("_first", "node")).alias("rep")).select(F.col("rep._first").alias("_keep"), F.col("rep.node").alias("_rep"))
    kept = written(kept, "kept")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_column].alias("_id"), _keyed(docs, text_column).alias("_node"))
    place = Window.partitionBy("_id", "_node").orderBy(F.lit(0))
    one = rows.join(kept, (rows["_id"] == kept["_keep"]) & (rows["_node"] == kept["_rep"])).withColumn("_n", F.row_number().over(place)).filter("_n = 1").select("row.*")
    return one.unionByName(docs.filter(docs[id_column].isNull()))
