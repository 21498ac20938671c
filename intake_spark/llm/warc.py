"""WARC archives through a chunked record table.

Each payload is cut into chunk rows (record number, chunk number, bytes) while its SHA-1 is carried along, so every row holds the digest and
length up to its end and the last row those of the record; nothing holds a record besides the cell it came in. The chunk table is
written to the shared folder. Decisions (response or revisit) need only its last rows. A task then writes records chunk by chunk,
each its own gzip member, and archives are read back the same way.

Of records with equal payloads of at least min_bytes, the one with the largest id is the response, the others revisit it.
The digest and the length stand for the payload.

Nulls: a null payload is empty; a null id ranks last and has no id header; a null address has no address header. Repeated rows are
records of their own; of those with the same id and payload one is the response. Empty input gives no archives and an empty result.
Other columns take no part.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, written
from .files import folder, new_name

CHUNK_BYTES, ARCHIVE_BYTES = 256 << 10, 128 << 20
CHUNKS = "page_id bigint, url string, row bigint, chunk_no int, last boolean, data binary, digest string, bytes bigint"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_column="page_id", url_column="url", payload_column="html") -> DataFrame:
    """The stored chunk table of pages: record_no, page_id, url, chunk_no, last, data, and digest and bytes up to the chunk's end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for batch in batches:
            out: dict = {c: [] for c in ("page_id", "url", "row", "chunk_no", "last", "data", "digest", "bytes")}
            held = 0
            for page_id, url, payload in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                whole, so_far = memoryview(payload.as_buffer() or b""), hashlib.sha1()
                for number, at in enumerate(range(0, max(1, len(whole)), chunk_bytes)):
                    part = whole[at : at + chunk_bytes]
                    so_far.update(part)
                    end = at + len(part)
                    for c, x in (("page_id", page_id.as_py()), ("url", url.as_py()), ("row", row), ("chunk_no", number), ("last", end == len(whole)), ("data", bytes(part)), ("digest", base32(so_far.digest())), ("bytes", end)):
                        out[c].append(x)
                    held += len(part)
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pydict(out, schema=schema)
                        out, held = {c: [] for c in out}, 0
                row += 1
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("row", pa.int64()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("data", pa.binary()), ("digest", pa.string()), ("bytes", pa.int64())])
    rows = pages.select(pages[id_column].cast("long").alias("page_id"), pages[url_column].cast("string").alias("url"), pages[payload_column].cast("binary").alias("payload"))
    chunks = rows.mapInArrow(cut, CHUNKS).withColumn("record_no", F.shiftleft(F.spark_partition_id().cast("long"), 36) + F.col("row")).drop("row")
    path = new_path(pages.sparkSession, "warc-chunks")
    chunks.write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(chunks.schema).parquet(path)


def decide(chunks: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per record: record_no, payload digest and bytes, record_type, and for revisits the response's id and record number."""
    ends = chunks.filter("last").select("record_no", "page_id", F.col("digest").alias("payload_digest"), F.col("bytes").alias("payload_bytes"))
    shared = (
        ends.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.count("*").alias("n"), F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "record_no")).alias("top"))
        .filter("n > 1").drop("n")
    )
    both = ends.drop("page_id").join(shared, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("top").isNotNull() & (F.col("top.record_no") != F.col("record_no"))
    return both.select(
        "record_no", "payload_digest", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("top.page_id")).alias("refers_to"), F.when(revisit, F.col("top.record_no")).alias("refers_to_record"),
    )


def _record_id(number: int) -> str:
    h = hashlib.md5(str(number).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _clean(url: str) -> str:
    return "".join(c if c.isprintable() and c not in " <>" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def write_archives(chunks: DataFrame, decisions: DataFrame, date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records to gzipped WARC files below the shared folder; return the manifest (path, records, bytes)."""
    base = new_path(chunks.sparkSession, "warc")

    def head(r: dict) -> tuple[bytes, bytes]:
        http = HTTP.format(r["payload_bytes"]).encode()
        block = len(http) + (r["payload_bytes"] if r["record_type"] == "response" else 0)
        fields = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", _record_id(r["record_no"])), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", block), ("X-Payload-Bytes", r["payload_bytes"])]
        if r["url"] is not None:
            fields.append(("WARC-Target-URI", _clean(r["url"])))
        if r["page_id"] is not None:
            fields.append(("X-Page-ID", r["page_id"]))
        if r["record_type"] == "revisit":
            fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(r["refers_to_record"]))]
            if r["refers_to"] is not None:
                fields.append(("X-Refers-To-Page-ID", r["refers_to"]))
        return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode(), http

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = folder(base)
        fs.create_dir(root, recursive=True)
        part, done, out, name, size, records, member = TaskContext.get().partitionId(), [], None, "", 0, 0, None

        def put(data: bytes):
            nonlocal size
            out.write(data)
            size += len(data)

        for batch in batches:
            for r in batch.to_pylist():
                if r["chunk_no"] == 0:
                    if out is not None and size >= archive_bytes:
                        out.close()
                        done.append({"path": f"{base}/{name}", "records": records, "bytes": size})
                        out = None
                    if out is None:
                        name, size, records = new_name(part, len(done), ".warc.gz"), 0, 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    member, records = zlib.compressobj(3, zlib.DEFLATED, 31), records + 1
                    for data in head(r):
                        put(member.compress(data))
                if r["record_type"] == "response":
                    put(member.compress(r["data"]))
                if r["last"]:
                    put(member.compress(b"\r\n\r\n") + member.flush())
        if out is not None:
            out.close()
            done.append({"path": f"{base}/{name}", "records": records, "bytes": size})
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    # A revisit needs one row only: its first, made its last.
    rows = chunks.drop("digest", "bytes").join(decisions, "record_no")
    rows = rows.filter("record_type = 'response' OR chunk_no = 0").withColumns({"data": F.when(F.col("record_type") == "response", F.col("data")), "last": F.col("last") | (F.col("record_type") == "revisit")})
    ordered = rows.repartition("record_no").sortWithinPartitions("record_no", "chunk_no")
    return written(ordered.mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-manifest")


def _members(file, piece: int = 1 << 20) -> Iterator[Iterator[bytes]]:
    """The gzip members of a file, each as an iterator over its pieces, to be used up before the next."""
    rest = b""
    while rest or (rest := file.read(piece)):
        member = zlib.decompressobj(31)

        def pieces(member=member):
            nonlocal rest
            while not member.eof:
                data = rest or file.read(piece)
                if not data:
                    raise ValueError("the archive ends inside a record")
                got = member.decompress(data, piece)
                rest = member.unconsumed_tail if not member.eof else member.unused_data
                yield got

        yield pieces()


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], int, str]:
    """Header fields, and bytes and digest of the payload as streamed from one record; checks them against the header."""
    def until(buffer: bytearray, mark: bytes) -> bytes:
        while (at := buffer.find(mark)) < 0:
            buffer += next(pieces)
        found = bytes(buffer[:at])
        del buffer[: at + len(mark)]
        return found

    buffer = bytearray()
    fields = dict(line.split(": ", 1) for line in until(buffer, b"\r\n\r\n").decode().split("\r\n")[1:])
    http = len(until(buffer, b"\r\n\r\n")) + 4
    left, n, so_far = int(fields["Content-Length"]) - http, 0, hashlib.sha1()
    while left > n:
        part = bytes(buffer[: left - n])
        del buffer[: len(part)]
        so_far.update(part)
        n += len(part)
        if left > n:
            buffer += next(pieces)
    for more in pieces:
        buffer += more
    digest = base32(so_far.digest())
    if bytes(buffer) != b"\r\n\r\n" or fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, n, digest


def read_archives(manifest: DataFrame) -> DataFrame:
    """Per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, url and record_id."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("record_id", pa.string())])

    def number(text):
        return None if text is None else int(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, root = folder(path)
                rows = []
                with fs.open_input_stream(root, compression=None) as file:
                    for pieces in _members(file):
                        f, n, digest = read_record(pieces)
                        response = f["WARC-Type"] == "response"
                        rows.append({
                            "page_id": number(f.get("X-Page-ID")), "payload_bytes": n if response else int(f["X-Payload-Bytes"]), "payload_digest": digest if response else f["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "record_type": f["WARC-Type"], "refers_to": number(f.get("X-Refers-To-Page-ID")), "url": f.get("WARC-Target-URI"), "record_id": f["WARC-Record-ID"],
                        })
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = manifest.select("path").repartition(max(1, manifest.count()))
    return files.mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, record_id string")


def archive(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Write pages to archives; return the manifest."""
    chunks = chunk_table(pages, **columns)
    return write_archives(chunks, decide(chunks, min_bytes))
