"""Mix sources to target weights: exact block quotas, split over output shards by a multivariate-hypergeometric tree.

A document's place in its source is a seeded permutation (the order of an MD5). Each source's permuted documents fall into blocks
of about BLOCK_DOCS, and into MIN_BLOCKS if it has the documents for that. A source is taken whole as often as its target allows; the rest is the leading part of its permutation, and
the document on the border is cut, so that the words taken meet the target (rounded to words) exactly. The blocks so taken
are the source's quota. A binary tree over the shards splits the quotas: each inner node draws how many of its blocks of each source
go left, from the multivariate hypergeometric distribution (one source after another, by inversion). Each leaf then draws its
blocks from a second permutation of the source's blocks, so shards are disjoint and use up the quotas, and shuffles its documents.

What is taken of a document is what the leaves have drawn: its words, epoch by epoch, each with the shard and the place there.

All of it is DataFrame expressions. Texts are read once for the plan, and what it needs of them is stored; only sums by block or source meet
in one window. Texts of any length are counted where they are, and no text is shuffled for the plan.
The number of sources is that of a mixing table: it is counted, and broadcast only up to a limit.

Nulls: a null text has no words; a null source is a source of its own, last in order; a null id is permuted as the text "null".
Repeated rows are separate documents. A source without words has target 0. Empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_small, text_of, written

BLOCK_DOCS, MIN_BLOCKS, SHARD_WORDS, MIN_SHARDS, SEED = 4096, 32, 8_000_000, 16, "mix"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...], epochs: float, cap: float) -> DataFrame:
    """Add target to rows (no_source, source, rows, words): epochs times all words, shared by weight, none above cap times its words.

    Sharing the excess again until nobody is above its cap has a closed form: with the sources in order of cap / weight, the share per
    unit of weight is what is left after the first k at their caps, for the smallest k at which the next stays below its own.
    """
    order = Window.orderBy("no_source", "source")
    listed = sources.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    listed = listed.withColumn("_cap", F.col("words") * F.lit(float(cap)))
    by = Window.orderBy(F.col("_cap") / F.col("_w"), "no_source", "source")
    everything = Window.partitionBy()
    listed = listed.withColumns({
        "_before": F.coalesce(F.sum("_cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_from": F.sum("_w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "_all": F.sum("words").over(everything) * F.lit(float(epochs)),
    }).withColumn("_unit", (F.col("_all") - F.col("_before")) / F.col("_from"))
    listed = listed.withColumn("_share", F.min(F.when(F.col("_unit") * F.col("_w") <= F.col("_cap"), F.struct("_before", "_unit"))).over(everything))
    return listed.withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_share._unit") * F.col("_w"), F.col("_cap")))).select(*sources.columns, "target")


def _log_factorial(x: str) -> str:
    """ln x! by Stirling's series, shifted by 8 so that it is right to about 1e-10."""
    y = f"({x} + 9D)"
    shift = " * ".join(f"({x} + {k}D)" for k in range(1, 9))
    return f"(({y} - 0.5D) * ln({y}) - {y} + 0.9189385332046727D + 1D / (12D * {y}) - 1D / (360D * {y} * {y} * {y}) - ln({shift}))"


def _hypergeometric(total: str, good: str, drawn: str, u: str) -> str:
    """SQL for a draw: how many of `drawn` of `total` blocks are of the `good`, from the uniform number u, by inversion within 12 deviations."""
    choose = lambda n, k: f"({_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')})"
    low, high = f"greatest(0L, {drawn} - ({total} - {good}))", f"least({good}, {drawn})"
    mean = f"({drawn} * CAST({good} AS DOUBLE) / greatest({total}, 1L))"
    wide = f"(12 * sqrt({mean} * (1 - CAST({good} AS DOUBLE) / greatest({total}, 1L)) + 1) + 12)"
    chance = f"exp({choose(good, 'x')} + {choose(f'({total} - {good})', f'({drawn} - x)')} - {choose(total, drawn)})"
    ks = f"sequence(greatest({low}, CAST(floor({mean} - {wide}) AS LONG)), least({high}, CAST(ceil({mean} + {wide}) AS LONG)))"
    return (
        f"aggregate({ks}, named_struct('left', {u}, 'x', {low}, 'found', false), (h, x) -> IF(h.found, h, named_struct('left', h.left - {chance}, 'x', x, "
        f"'found', h.left - {chance} <= 0)), h -> h.x)"
    )


def split_quotas(quotas: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """(source_no, quota) to (source_no, shard, blocks): shards get equal numbers of blocks (to one), exact per source in total.

    The tree has one row per node, with the node's counts by source as an array; every level is one select.
    """
    node = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("source_no", "quota"))).alias("q")).select(
        F.col("q.source_no").alias("nos"), F.col("q.quota").alias("counts"), F.lit(0).alias("lo"), F.lit(shards).alias("hi")
    )
    uniform = f"(CAST(conv(substring(md5(concat('{seed}:', lo, ':', hi, ':', c.i)), 1, 13), 16, 10) AS DOUBLE) + 0.5D) / 4503599627370496D"
    step = _hypergeometric("a.total", "c.k", "a.n", uniform)
    sequential = (
        "aggregate(transform(counts, (k, i) -> named_struct('k', k, 'i', i)), named_struct('total', total, 'n', n_left, 'out', CAST(array() AS ARRAY<BIGINT>)), "
        f"(a, c) -> element_at(transform(array({step}), d -> named_struct('total', a.total - c.k, 'n', a.n - d, 'out', array_append(a.out, d))), 1), a -> a.out)"
    )
    width = 1
    while width < shards:
        width *= 2
        node = node.withColumns({"mid": F.expr("CAST((lo + hi) DIV 2 AS INT)"), "total": F.expr("aggregate(counts, 0L, (a, b) -> a + b)")})
        node = node.withColumn("n_left", F.expr("IF(hi - lo = 1, total, (total * (mid - lo)) DIV (hi - lo))"))
        node = node.withColumn("left", F.expr(f"IF(hi - lo = 1, counts, {sequential})"))
        node = node.withColumn("both", F.expr("IF(hi - lo = 1, array(named_struct('lo', lo, 'hi', hi, 'counts', counts)), array(named_struct('lo', lo, 'hi', mid, 'counts', left), named_struct('lo', mid, 'hi', hi, 'counts', zip_with(counts, left, (a, b) -> a - b))))"))
        node = node.select("nos", F.explode("both").alias("b")).select("nos", "b.counts", "b.lo", "b.hi")
        if width % 8 == 0:
            node = written(node, "mix-tree")
    return node.select(F.col("lo").alias("shard"), F.explode(F.arrays_zip("nos", "counts")).alias("x")).select("shard", F.col("x.nos").alias("source_no"), F.col("x.counts").alias("blocks"))


def plan_mix(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source", weights=(5.0, 2.0, 1.0), epochs=1.5, cap=2.0, shards: int | None = None, seed: str = SEED, carry: list[str] | None = None) -> DataFrame:
    """One row per row of docs: id, the carried columns as struct `row`, size, source_size, target, taken, copies and place.

    copies: array of (epoch, shard, words), one for each time that the mix takes the document; words below size means its first words.
    place: (source_no, block, nth), by which rows are told apart.
    """
    kept = [c for c in docs.columns if c in carry] if carry else []
    sized = docs.select(
        docs[id_column].alias("_id"),
        *([F.struct(*[docs[c] for c in kept]).alias("_row")] if kept else []),
        docs[source_column].isNull().alias("no_source"),
        F.coalesce(docs[source_column].cast("string"), F.lit("")).alias("source"),
        words(text_of(docs, text_column)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_column].cast("string"), F.lit("null")))).alias("_key"),
        F.xxhash64(docs[text_column]).alias("_tie"),
    )
    counted = written(sized.drop("_row"), "mix-sizes")
    totals = written(source_targets(counted.groupBy("no_source", "source").agg(F.count("*").alias("rows"), F.sum("size").alias("words")), weights, epochs, cap), "mix-sources")
    facts = totals.agg(F.count("*").alias("n"), F.sum("target").alias("mixed")).first()
    shards = shards or max(MIN_SHARDS, -(-int(facts["mixed"] or 0) // SHARD_WORDS))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_DOCS), F.least("rows", F.lit(MIN_BLOCKS)))
    per_source = totals.select(
        "no_source", "source", F.col("words").alias("source_size"), "target",
        blocks.cast("long").alias("_blocks"),
        F.row_number().over(Window.orderBy("no_source", "source")).cast("long").alias("source_no"),
        F.round("target").cast("long").alias("_goal"),
    )
    block = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("_blocks")).cast("long")
    in_blocks = lambda rows: join_small(rows, per_source, ["no_source", "source"], facts["n"], "inner").withColumn("block", block)
    # Words of each block, and how far its source has come before it.
    before = Window.partitionBy("source_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = in_blocks(counted).groupBy("source_no", "block").agg(F.sum("size").alias("block_words"), F.first("source_size").alias("source_size"), F.first("_goal").alias("_goal"))
    blocks = blocks.withColumn("come", F.coalesce(F.sum("block_words").over(before), F.lit(0)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("_goal") / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0)).cast("long")
    taken = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), whole))).withColumn(
        "words", F.greatest(F.lit(0), F.least(F.col("block_words"), F.col("_goal") - F.col("epoch") * F.col("source_size") - F.col("come")))
    ).filter("words > 0").select("source_no", "block", "epoch", "words")
    taken = written(taken, "mix-blocks")
    # Which shard draws which block.
    drawn_order = Window.partitionBy("source_no").orderBy(F.md5(F.concat_ws(":", F.lit(seed), "source_no", "epoch", "block")), "epoch", "block")
    ranked = taken.withColumn("place", F.row_number().over(drawn_order).cast("long"))
    leaves = split_quotas(taken.groupBy("source_no").agg(F.count("*").alias("quota")), shards, seed).filter("blocks > 0")
    first = F.coalesce(F.sum("blocks").over(Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    leaves = leaves.withColumn("first", first).withColumn("place", F.explode(F.expr("sequence(first, first + blocks - 1)"))).select("source_no", "place", "shard")
    draws = ranked.join(leaves, ["source_no", "place"]).groupBy("source_no", "block").agg(F.array_sort(F.collect_list(F.struct("epoch", "shard", "words"))).alias("_draws"))
    # What that means for each document of a block.
    inside = Window.partitionBy("source_no", "block").orderBy("_key", "_id", "size", "_tie")
    before = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        in_blocks(sized if kept else counted).withColumns({"_inside": F.coalesce(before, F.lit(0)), "_nth": F.row_number().over(inside)})
        .join(draws, ["source_no", "block"], "left")
        .withColumn("copies", F.expr("filter(transform(_draws, d -> named_struct('epoch', d.epoch, 'shard', d.shard, 'words', greatest(0L, least(size, d.words - _inside)))), d -> d.words > 0)"))
        .select(F.col("_id").alias(id_column), *([F.col("_row").alias("row")] if kept else []), F.struct("source_no", "block", F.col("_nth").alias("nth")).alias("place"), "size", "source_size", "target", F.expr("coalesce(aggregate(copies, 0L, (a, b) -> a + b.words), 0L)").alias("taken"), "copies")
    )


def _shuffled(epoch: Column, id_: Column, place: Column, seed: str) -> list[Column]:
    """The order of documents in a shard."""
    return [F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(id_.cast("string"), F.lit("null")))), epoch, place]


def taken_by_shard(docs: DataFrame, id_column="doc_id", seed: str = SEED, **options) -> DataFrame:
    """plan_mix without carried columns, and for each document the shards that take it and its positions there: texts with one number for each epoch."""
    plan = written(plan_mix(docs, id_column=id_column, seed=seed, **options), "mix-plan")
    each = plan.select("place", F.col(id_column).alias("_id"), F.explode("copies").alias("copy"))
    order = Window.partitionBy("copy.shard").orderBy(*_shuffled(F.col("copy.epoch"), F.col("_id"), F.col("place"), seed))
    each = each.select("place", F.struct("copy.epoch", "copy.shard", F.row_number().over(order).alias("position")).alias("at"))
    drawn = each.groupBy("place").agg(F.array_sort(F.collect_list("at")).alias("at"))
    told = lambda field: F.coalesce(F.array_join(F.col(f"at.{field}").cast("array<string>"), ","), F.lit(""))
    return plan.join(drawn, "place", "left").withColumns({"shards": told("shard"), "positions": told("position")}).drop("at", "place", "copies")


def mix(docs: DataFrame, text_column="text", seed: str = SEED, placed: bool = True, **options) -> DataFrame:
    """The mixed rows: the columns of docs, the text cut to its first words where the mix takes only those; and, if placed, mix_shard and mix_position,
    in which case rows are dealt to their shard and shuffled there.

    A cut text is its first words joined by single spaces.
    """
    planned = plan_mix(docs, text_column=text_column, seed=seed, carry=docs.columns, **options)
    id_ = F.col(options.get("id_column", "doc_id"))
    each = planned.withColumn("copy", F.explode("copies"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col("row")[text_column], F.lit(WORD), F.lit(0)), F.lit(1), F.col("copy.words").cast("int")), " ")
    text = F.when(F.col("copy.words") < F.col("size"), part).otherwise(F.col("row")[text_column])
    columns = [(text if c == text_column else F.col("row")[c]).alias(c) for c in docs.columns]
    order = Window.partitionBy("copy.shard").orderBy(*_shuffled(F.col("copy.epoch"), id_, F.col("place"), seed))
    return each.select(*columns, *([F.col("copy.shard").alias("mix_shard"), F.row_number().over(order).alias("mix_position")] if placed else []))


def dealt(mixed: DataFrame) -> DataFrame:
    """Placed rows of a mix in the order of their shards, without mix_shard and mix_position: the window that numbers them has brought each shard to one task."""
    return mixed.sortWithinPartitions("mix_shard", "mix_position").drop("mix_shard", "mix_position")
