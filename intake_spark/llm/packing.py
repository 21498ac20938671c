"""Pack documents into fixed windows by minimum bin slack.

Documents are tokenised and cut into full windows and one remainder each. Remainders are dealt by a hash over groups of about GROUP_PIECES,
each packed in one task: the longest remainder left opens a window, and a bounded subset-sum over the multiset of the
lengths left (a bitset of reachable sums in one Python integer, lengths in descending order, stopping as soon as the gap is
reachable) picks the counts of each length that fill it closest; they are found by going back through the bitsets. A group ends with a
few windows that nothing is left to fill.

Nulls: a null text counts as empty, so it is just its end id; a null id is kept. Repeated rows are packed once each.
Empty input gives an empty result. Columns other than id and text take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .caches import TEXT_ROWS, give_back
from .common import written

GROUP_PIECES = 20_000


def cut(docs: DataFrame, capacity: int = 2048, end_id: int = 1, tokenizer: str | None = None, id_column="doc_id", text_column="text", added: bool = False) -> DataFrame:
    """Pieces of the documents' ids: id, row (a number of the row, as rows may share an id), start, length, doc_tokens and ids (little-endian
    unsigned 32-bit); all but a document's last are full. A very long text's ids are held at once, and handed on a few megabytes at a time."""
    id_type = docs.schema[id_column].dataType

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = (batch.column(0), batch.column(2))
            which, starts, lengths, totals, parts, held = [], [], [], [], [], 0
            for row, ids in enumerate(tokens.encoded(batch.column(1), tokenizer, end_id, added=added)):
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    which.append(row), starts.append(start), lengths.append(len(part) // 4), totals.append(n), parts.append(part)
                    held += len(part)
                    if held > 8_000_000:
                        yield made(names, which, starts, lengths, totals, parts)
                        which, starts, lengths, totals, parts, held = [], [], [], [], [], 0
            yield made(names, which, starts, lengths, totals, parts)
        give_back()

    def made(names, which, starts, lengths, totals, parts):
        longs = [pa.array(x, pa.int64()) for x in (starts, lengths, totals)]
        of = [x.take(pa.array(which, pa.int64())) for x in names]
        return pa.RecordBatch.from_arrays([*of, *longs, pa.array(parts, pa.binary())], names=[id_column, "row", "start", "length", "doc_tokens", "ids"])

    schema = T.StructType([T.StructField(id_column, id_type), *[T.StructField(c, T.LongType()) for c in ("row", "start", "length", "doc_tokens")], T.StructField("ids", T.BinaryType())])
    return docs.select(docs[id_column], docs[text_column], F.monotonically_increasing_id()).mapInArrow(pieces, schema)


def fill(lengths: list[int], counts: dict[int, int], gap: int) -> list[tuple[int, int]]:
    """(length, how many) whose sum is the largest reachable up to gap. lengths: those left, descending."""
    mask, reach, trail = (1 << (gap + 1)) - 1, 1, []
    for length in lengths:
        if length > gap:
            continue
        shifted, sums = reach, reach
        for _ in range(min(counts[length], gap // length)):
            shifted = (shifted << length) & mask
            if not shifted:
                break
            sums |= shifted
        trail.append((length, reach))
        reach = sums
        if reach >> gap & 1:
            break
    at, picked = reach.bit_length() - 1, []
    for length, before in reversed(trail):
        n = 0
        while not before >> at & 1:
            at -= length
            n += 1
        if n:
            picked.append((length, n))
    return picked


def windows(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece of one group."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    of: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        of.setdefault(int(lengths[i]), []).append(i)
    counts = {n: len(x) for n, x in of.items()}
    left = sorted(counts, reverse=True)
    number = 0
    while left:
        at, take = 0, [(left[0], 1)]
        counts[left[0]] -= 1
        if capacity > left[0]:
            usable = [x for x in left if counts[x]] if not counts[left[0]] else left
            take += fill(usable, counts, capacity - left[0])
        for k, (length, n) in enumerate(take):
            counts[length] -= n if k else 0
            for _ in range(n):
                i = of[length].pop()
                window[i], offset[i] = number, at
                at += length
        if not all(counts[x] for x, _ in take):
            left = [x for x in left if counts[x]]
        number += 1
    return window, offset


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """pieces (any columns, with length up to capacity) with sequence_id and offset added. Numbers are unique, with few gaps."""
    held = written(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces", TEXT_ROWS)
    groups = max(1, -(-held.count() // GROUP_PIECES))

    def one(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_piece", kind="stable")
        window, offset = windows(pdf["length"].to_numpy(), capacity)
        return pdf.drop(columns=["_piece", "_group"]).assign(sequence_id=window * groups + group[0], offset=offset)

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return held.withColumn("_group", F.pmod(F.xxhash64("_piece"), F.lit(groups))).groupBy("_group").applyInPandas(one, schema)
