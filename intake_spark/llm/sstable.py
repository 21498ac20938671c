"""Token ids in sorted-string-table shards.

Rows are range-partitioned and sorted by id; each task tokenises its rows in order and writes shard files to the shared folder, so ids
never pass a shuffle. A shard is a run of blocks, a sparse index (first key, place and rows of each block), a Bloom filter over the keys and a
fixed footer. A block holds entries (shared key bytes, own key bytes, value bytes, own key, value) with the full key at every RESTART-th,
then the restart places; it is one zstd frame. Keys are a null flag and the id as big-endian with the sign flipped, so that byte
order is id order. Values are the ids, 2 bytes each if the largest fits, else 4.

Files of lost attempts are not in the manifest, which is a table of what the successful tasks wrote.

Nulls: a null text counts as empty; a null id comes first. Repeated ids are all kept, in the order of a hash of their texts.
Empty input gives no shards and an empty result. Other columns take no part.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .caches import TEXT_ROWS, give_back
from .common import new_path, written
from .files import folder, new_name

BLOCK_BYTES, SHARD_BYTES, RESTART, BLOOM_BITS, BLOOM_HASHES = 64 << 10, 64 << 20, 16, 10, 7
MAGIC = b"IDSTABL1"
FOOTER = struct.Struct("<QQQQQQB8s")
ENTRY = struct.Struct("<HHI")
MANIFEST = "path string, part int, number int, first_id bigint, last_id bigint, docs bigint, tokens bigint, bytes bigint"


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + (int(doc_id) + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else int.from_bytes(key[1:], "big") - (1 << 63)


def _bloom_places(key: bytes, bits: int) -> list[int]:
    a, b = xxhash.xxh64_intdigest(key, 0), xxhash.xxh64_intdigest(key, 1) | 1
    return [(a + i * b) % bits for i in range(BLOOM_HASHES)]


class ShardWriter:
    """Writes one shard; keys must come in order."""

    def __init__(self, stream, wide: bool):
        self.stream, self.wide, self.at, self.codec = stream, wide, 0, zstandard.ZstdCompressor(level=1)
        self.index, self.keys, self.tokens = [], [], 0
        self._open()

    def _open(self):
        self.block, self.restarts, self.rows, self.last, self.first = bytearray(), [], 0, b"", None

    def add(self, key: bytes, ids: bytes) -> None:
        value = ids if self.wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
        shared = 0
        if self.rows % RESTART == 0:
            self.restarts.append(len(self.block))
        else:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        self.block += ENTRY.pack(shared, len(key) - shared, len(value)) + key[shared:] + value
        self.first = key if self.first is None else self.first
        self.last, self.rows = key, self.rows + 1
        self.keys.append(key)
        self.tokens += len(ids) // 4
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            data = self.codec.compress(bytes(self.block) + struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts)))
            self.index.append((self.first, self.at, len(data), self.rows))
            self.stream.write(data)
            self.at += len(data)
            self._open()

    def close(self) -> int:
        self.flush()
        bits = max(64, len(self.keys) * BLOOM_BITS)
        bloom = np.zeros((bits + 7) // 8, np.uint8)
        for key in self.keys:
            for p in _bloom_places(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        index = b"".join(struct.pack("<HQII", len(k), at, n, rows) + k for k, at, n, rows in self.index)
        foot = FOOTER.pack(self.at, len(index), self.at + len(index), bits, len(self.keys), self.tokens, self.wide, MAGIC)
        self.stream.write(index + bloom.tobytes() + foot)
        self.stream.close()
        return self.at + len(index) + len(bloom) + len(foot)


class Shard:
    """Reads one shard: all of it in order, or single keys by Bloom filter, binary search in the index and in the block's restarts."""

    def __init__(self, file):
        self.file, size = file, file.size()
        index_at, index_bytes, bloom_at, self.bits, self.docs, self.tokens, self.wide, magic = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        self.bloom = np.frombuffer(file.read_at((self.bits + 7) // 8, bloom_at), np.uint8)
        raw, self.firsts, self.places, at = file.read_at(index_bytes, index_at), [], [], 0
        while at < len(raw):
            n, place, size, _ = struct.unpack_from("<HQII", raw, at)
            at += struct.calcsize("<HQII")
            self.firsts.append(raw[at : at + n])
            self.places.append((place, size))
            at += n
        self.codec = zstandard.ZstdDecompressor()

    def _block(self, i: int) -> tuple[bytes, list[int], int]:
        data = self.codec.decompress(self.file.read_at(self.places[i][1], self.places[i][0]))
        (n,) = struct.unpack_from("<I", data, len(data) - 4)
        end = len(data) - 4 - 4 * n
        return data, list(struct.unpack_from(f"<{n}I", data, end)), end

    def _entries(self, data: bytes, at: int, end: int) -> Iterator[tuple[bytes, bytes]]:
        key = b""
        while at < end:
            shared, own, size = ENTRY.unpack_from(data, at)
            at += ENTRY.size
            key = key[:shared] + data[at : at + own]
            at += own
            value = data[at : at + size]
            at += size
            yield key, value if self.wide else np.frombuffer(value, "<u2").astype("<u4").tobytes()

    def scan(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.places)):
            data, _, end = self._block(i)
            yield from self._entries(data, 0, end)

    def get(self, key: bytes) -> list[bytes]:
        """The values of a key, in order; usually one."""
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _bloom_places(key, self.bits)):
            return []
        found = []
        for i in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            data, restarts, end = self._block(i)
            full = lambda at: data[at + ENTRY.size : at + ENTRY.size + ENTRY.unpack_from(data, at)[1]]  # noqa: B023, E731
            for k, value in self._entries(data, restarts[max(0, bisect_left(restarts, key, key=full) - 1)], end):
                if k >= key:
                    if k > key:
                        break
                    found.append(value)
        return found


def write_shards(docs: DataFrame, end_id: int = 2, tokenizer: str | None = None, id_column="doc_id", text_column="text", wide: bool = False, shard_bytes: int = SHARD_BYTES, added: bool = False) -> DataFrame:
    """Write shards below the shared folder; return the manifest, one row a shard. wide: 4 bytes an id, for vocabularies beyond 65,536."""
    base = new_path(docs.sparkSession, "sstables")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = folder(base)
        fs.create_dir(root, recursive=True)
        part, done, writer, ids_of, name = TaskContext.get().partitionId(), [], None, [None, None], ""

        def close():
            size = writer.close()
            done.append({"path": f"{base}/{name}", "part": part, "number": len(done), "first_id": ids_of[0], "last_id": ids_of[1], "docs": len(writer.keys), "tokens": writer.tokens, "bytes": size})

        for batch in batches:
            names = batch.column(0).to_pylist()
            for doc_id, ids in zip(names, tokens.encoded(batch.column(1), tokenizer, end_id, added=added), strict=True):
                if writer is None:
                    name = new_name(part, len(done), ".sst")
                    writer, ids_of[0] = ShardWriter(fs.open_output_stream(f"{root}/{name}"), wide), doc_id
                writer.add(key_of(doc_id), ids)
                ids_of[1] = doc_id
                if writer.at >= shard_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        fields = [("path", pa.string()), ("part", pa.int32()), ("number", pa.int32()), *[(c, pa.int64()) for c in ("first_id", "last_id", "docs", "tokens", "bytes")]]
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema(fields))
        give_back()

    rows = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"), F.xxhash64(docs[text_column]).alias("tie"))
    placed = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    return written(placed.mapInArrow(write, MANIFEST), "sstable-manifest", TEXT_ROWS)


def read_shards(manifest: DataFrame) -> DataFrame:
    """All documents of the shards: doc_id, start (ids of all documents before it), n_tokens and ids as binary."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("path", "base").repartition(max(1, manifest.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, root = folder(path)
                with fs.open_input_file(root) as file:
                    rows, held = [], 0
                    for key, ids in Shard(file).scan():
                        rows.append((id_of(key), start, len(ids) // 4, ids))
                        start += len(ids) // 4
                        held += len(ids)
                        if held > 8_000_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    def batch_of(rows):
        ids, starts, lengths, values = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (ids, starts, lengths)], pa.array(values, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def lookup(manifest: DataFrame, wanted: DataFrame, id_column="doc_id") -> DataFrame:
    """Ids of the wanted documents: each goes to the shards whose key range holds it and is searched there; missing ones give no row.

    The span of all keys is cut in as many strips as there are shards. As ranges are disjoint (but for repeated ids), shards lie in twice as many
    strips together, and wanted ids meet them by an equal strip, however many of either there are. Null ids have a strip of their own.
    """
    facts = manifest.agg(F.count("*").alias("n"), F.min(F.least("first_id", "last_id")).alias("low"), F.max("last_id").alias("high")).first()
    low = facts["low"] if facts["low"] is not None else 0
    wide = max(1.0, (float(facts["high"] or 0) - float(low)) / max(1, facts["n"]))
    strip = lambda c: F.greatest(F.lit(0), F.floor((c.cast("double") - F.lit(float(low))) / F.lit(wide))).cast("long")
    first = F.coalesce("first_id", F.lit(low))  # a shard that begins with null ids holds the smallest others too
    numbers = F.when(F.col("last_id").isNotNull(), F.sequence(strip(first), strip(F.col("last_id")))).otherwise(F.array().cast("array<bigint>"))
    nulls = F.when(F.col("first_id").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    ranges = manifest.select("path", "first_id", "last_id", F.explode(F.concat(nulls, numbers)).alias("_strip"))
    asked = wanted.select(F.col(id_column).cast("long").alias("doc_id")).distinct().withColumn("_strip", F.coalesce(F.when(F.col("doc_id").isNotNull(), strip(F.col("doc_id"))), F.lit(-1)))
    inside = (F.col("_strip") == -1) | ((F.col("doc_id") <= F.col("last_id")) & (F.col("first_id").isNull() | (F.col("doc_id") >= F.col("first_id"))))
    routed = asked.join(ranges, "_strip").filter(inside).select("path", "doc_id")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, group in pdf.groupby("path"):
                fs, root = folder(path)
                with fs.open_input_file(root) as file:
                    shard = Shard(file)
                    out += [(i, len(v) // 4, v) for i in group["doc_id"] for v in shard.get(key_of(None if pd.isna(i) else int(i)))]
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids"]).astype({"doc_id": "Int64"})

    return routed.repartition("path").sortWithinPartitions("path").mapInPandas(search, "doc_id bigint, n_tokens bigint, ids binary")
