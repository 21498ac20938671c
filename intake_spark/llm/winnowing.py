"""Benchmark passages in training documents, found by winnowing, with built-in functions alone.

A window is `size` consecutive words of an item, or the whole of a shorter one. Of the grams (K words, or fewer in shorter windows) that a window holds,
that with the smallest hash is its fingerprint, in items and documents alike; so every span of `size` words that a document shares with an item has a
fingerprint that both select. Documents' fingerprints are joined with those of the items, and each hit is extended to the words of its window, which must be
those of an item's window, word for word.

The items' windows are broadcast at most MOST_WINDOWS at a time: with more, items are dealt into so many blocks, and documents go by each. Neither
fingerprints nor hits of documents reach the driver; per document there is a marker and a row for each window that is found.

Defined results: only A-Z are lower-cased; a null or empty text has no words, and a document without words is not contaminated. Items without words have no
window. Items of one id are one item; an item with a null id marks words and is not named. Rows of documents are judged one by one, whether ids or
texts repeat or are null; other columns are carried, whatever their names. No items: no hits. No documents: no rows. Texts of any length are read whole.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

#: Words of a gram.
K = 5
#: Windows of items that are broadcast at once, with their texts.
MOST_WINDOWS = 1 << 18
#: The fingerprint of the marker that each document has besides its own.
MARK = 0
#: What parts words: ASCII but for digits and letters.
_BETWEEN = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def words_of(text: Column) -> Column:
    """Runs of digits, letters and all characters beyond ASCII, in the case given; without what parts words at its ends a text is split at it."""
    inner = F.btrim(text, F.lit(_BETWEEN))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))


def folded(text: Column) -> Column:
    """With A-Z in lower case, and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def with_grams(df: DataFrame, sizes: list[int]) -> DataFrame:
    """df (_words) with the hash of the gram that begins at each word, for each length of grams that windows of these sizes need; null where too few words follow."""
    # Few words have capitals, and lower() tells it faster than folded().
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(F.when(F.lower(w) == w, w).otherwise(folded(w)))))

    def gram(k: int) -> Column:
        last = F.size("_hashes") - k
        return F.transform("_hashes", lambda h, i: F.when(i <= last, F.xxhash64(h, *[F.get("_hashes", i + j) for j in range(1, k)])))

    return df.withColumns({f"_grams_{k}": gram(k) for k in grams_of(sizes)}).drop("_hashes")


def grams_of(sizes: list[int]) -> list[int]:
    """The lengths of grams for windows of these sizes."""
    return sorted({min(K, s) for s in sizes})


def fingerprint(at: Column, size: Column | int, grams: Column, k: int) -> Column:
    """That of the window of `size` words which begins at a word: the smallest hash of its grams."""
    return F.array_min(F.slice(grams, at + 1, size - F.lit(k) + 1))


def window_text(at: Column, size: Column | int) -> Column:
    return folded(F.array_join(F.slice("_words", at + 1, size), " "))


def item_windows(items: DataFrame, size: int, item_column: str, text_column: str) -> DataFrame:
    """(item, size, hash, window): the windows of items, with their fingerprints."""
    worded = items.select(items[item_column].cast("string").alias("item"), words_of(text_of(items, text_column)).alias("_words")).withColumn("size", F.least(F.size("_words"), F.lit(size))).filter("size > 0")
    of = None
    sizes = sorted(r.size for r in worded.select("size").distinct().collect())  # no more than `size` numbers
    for one in sizes:
        k = min(K, one)
        starts = F.explode(F.sequence(F.lit(0), F.size("_words") - one))
        grams = with_grams(worded.filter(F.col("size") == one), [one]).select("item", "size", "_words", f"_grams_{k}", starts.alias("at"))
        found = grams.select("item", "size", fingerprint(F.col("at"), one, F.col(f"_grams_{k}"), k).alias("hash"), window_text(F.col("at"), one).alias("window"))
        of = found if of is None else of.unionByName(found)
    return of if of is not None else worded.select("item", "size", F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("string").alias("window")).limit(0)


def found_windows(worded: DataFrame, windows: DataFrame, sizes: list[int], marked: bool) -> DataFrame:
    """worded (_row, _words, carried columns) to a row for each window of a document that is one of an item: at, size, items; and, if marked, one without for each.

    A document's grams are looked up among the items' fingerprints before it is seen which of them are fingerprints of the document, as that is asked of few then.
    """
    carried, ks = [c for c in worded.columns if c != "_words"], grams_of(sizes)
    every = F.concat(F.array(F.lit(MARK).cast("bigint")), *[F.col(f"_grams_{k}") for k in ks])
    grams = with_grams(worded, sizes)
    prints = grams.select(*carried, "_words", *[f"_grams_{k}" for k in ks], F.posexplode(every).alias("_pos", "_hash"))
    known = windows.select(F.col("hash").alias("_hash")).distinct()
    if marked:
        known = known.unionByName(worded.sparkSession.range(1).select(F.lit(MARK).cast("bigint").alias("_hash"))).distinct()
    hits = prints.join(F.broadcast(known), "_hash", "left_semi")
    n = F.size("_words")
    p, which = F.pmod(F.col("_pos") - 1, n), F.floor((F.col("_pos") - 1) / n)
    marker = F.array(F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("size")))


    def around(size: int, k: int) -> Column:
        """The windows of a size that hold the gram at p."""
        low, high = F.greatest(F.lit(0), p - (size - k)), F.least(p, n - size)
        return F.when(low <= high, F.transform(F.sequence(low, high), lambda at: F.struct(at.alias("at"), F.lit(size).alias("size"))))

    spans = marker
    for i, k in enumerate(ks):
        own = F.array_compact(F.array(*[around(s, k) for s in sizes if min(K, s) == k]))
        spans = F.when((F.col("_pos") > 0) & (which == i), F.flatten(own)).otherwise(spans)
    hits = hits.select(*carried, "_words", *[f"_grams_{k}" for k in ks], "_pos", "_hash", F.explode(spans).alias("_span")).select("*", "_span.at", "_span.size").drop("_span")
    print_ = F.lit(None).cast("bigint")
    for k in ks:
        print_ = F.when(F.least(F.lit(K), "size") == k, fingerprint(F.col("at"), F.col("size"), F.col(f"_grams_{k}"), k)).otherwise(print_)
    hits = hits.filter(F.col("at").isNull() | (print_ == F.col("_hash"))).select(*carried, "at", "size", window_text(F.col("at"), F.col("size")).alias("window"))
    of = windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return hits.join(F.broadcast(of), "window", "left").filter(F.col("items").isNotNull() | F.col("at").isNull()).drop("window")


def covered(spans: Column) -> Column:
    """How many words lie in any of the sorted spans (at, size)."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("words"))
    step = lambda a, s: F.struct(F.greatest(a["upto"], s["at"] + s["size"]).alias("upto"), (a["words"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(a["upto"], s["at"]))).alias("words"))
    return F.aggregate(spans, start, step, lambda a: a["words"].cast("bigint"))


def contaminated(docs: DataFrame, items: DataFrame, size: int = 10, text_column: str = "text", item_column: str = "item_id", item_text: str = "text", most_windows: int | None = None) -> DataFrame:
    """Every row of docs as struct `row` (without the text) with n_words, n_hit, spans (at, size of the windows found, in order), items (sorted ids) and n_items."""
    windows = written(item_windows(items, size, item_column, item_text), "item-windows")
    total = windows.count()
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())
    blocks = max(1, math.ceil(total / (most_windows or MOST_WINDOWS)))
    carried = [docs[c] for c in docs.columns if c != text_column]
    worded = docs.select(F.struct(*carried).alias("row") if carried else F.struct(F.lit(1).alias("none")).alias("row"), words_of(text_of(docs, text_column)).alias("_words"))
    worded = worded.withColumns({"_row": F.monotonically_increasing_id(), "n_words": F.size("_words").cast("bigint")})
    if blocks > 1:
        worded = written(worded, "words")  # numbers of rows are the same for each block
    found = None
    for block in range(blocks):
        own = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == block)
        some = found_windows(worded, own, sizes, marked=block == 0)
        found = some if found is None else found.unionByName(some)
    span = F.when(F.col("at").isNotNull(), F.struct("at", "size"))
    each = found.groupBy("_row").agg(F.first("row").alias("row"), F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(span)).alias("spans"), F.collect_set("items").alias("_sets"))
    named = F.array_sort(F.array_distinct(F.flatten("_sets")))
    return each.select("row", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", named.alias("items")).withColumn("n_items", F.size("items").cast("bigint"))
