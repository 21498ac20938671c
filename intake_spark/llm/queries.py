"""The registered queries of this subpackage, with SQL where DuckDB can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, conversations, exact_dedup, mixing, packing, quality, simhash, sstable, suffix_dedup, toxicity, warc, whitening, winnowing


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_archives(warc.archive(_table(spark, sf_dir, "pages"), min_bytes=0))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _fold(modulus: int) -> Column:
    return F.crc32(F.col("id").cast("string")) % modulus


def _judged(docs: DataFrame, model, held_out: Column, least: float) -> DataFrame:
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op2_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), learn_from=_fold(3) != 1)
    return _judged(docs, model, F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 0.7)


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), learn_from=_fold(5) != 0)
    return _judged(docs, model, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 0.3)


def op4_ann_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(ann.index(_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0, k=10)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), width=200)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_table(spark, sf_dir, "documents"), width=4, most=4)


def op3_token_sstables(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sstable.write_shards(_table(spark, sf_dir, "documents"), end_id=2, added=True)
    return sstable.read_shards(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_pack_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(_table(spark, sf_dir, "documents"), capacity=2048, end_id=1, added=True)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=2048)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.taken_by_shard(_table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), epochs=1.5, cap=2.0)
    return planned.select("doc_id", "size", "source_size", "target", "taken", "shards", "positions")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.content_sort(docs, keep="largest").select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op11_whitening_gkl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(*whitening.train(_table(spark, sf_dir, "embeddings"), many=4))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = winnowing.contaminated(docs, _table(spark, sf_dir, "benchmark"), size=10)
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_warc_chunks": op1_warc_chunks,
    "op2_toxicity_nnpu": op2_toxicity_nnpu,
    "op3_token_sstables": op3_token_sstables,
    "op4_ann_permutation": op4_ann_permutation,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_simhash_pivots": op6_simhash_pivots,
    "op7_mix_sources": op7_mix_sources,
    "op8_quality_fm": op8_quality_fm,
    "op9_pack_bin_slack": op9_pack_bin_slack,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening_gkl": op11_whitening_gkl,
    "op12_winnowing": op12_winnowing,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op1_warc_chunks": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top, sha1(h) AS hex FROM p)
        SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex || '0', (k * 5 // 4)::INT + 1, 2))::BIGINT >> (3 - (k * 5) % 4)) & 31)::INT + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
        FROM g
    """,
    "op7_mix_sources": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('mix:' || doc_id) AS k FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS no, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source
        ), c AS (
            SELECT *, source_size * 2.0::DOUBLE AS cap,
                   coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   sum(w) OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
                   sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total
            FROM s
        ), t AS (
            SELECT *, min(CASE WHEN (total - before) / rest * w <= cap THEN before END) OVER () AS b FROM c
        ), u AS (
            SELECT source, source_size, no, greatest(1, ceil(n / 4096), least(n, 32)) AS nb, least(cap, w * max(CASE WHEN before = b AND (total - before) / rest * w <= cap THEN (total - before) / rest END) OVER ()) AS target FROM t
        ), p AS (
            SELECT d.*, u.no, u.source_size, u.target, round(u.target)::BIGINT AS goal, floor(('0x' || substr(k, 1, 8))::BIGINT / 4294967296.0::DOUBLE * nb)::BIGINT AS block,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS come
            FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
        ), b AS (  -- blocks, how often they are taken, and in which order of their source
            SELECT no, block, any_value(goal) AS goal, any_value(source_size) AS source_size, sum(size) AS words, min(come) AS come FROM p GROUP BY 1, 2
        ), tk AS (
            SELECT no, block, e AS epoch, greatest(0, least(words, goal - e * source_size - come)) AS words FROM b, range(0, 3) t(e)
        ), rk AS (
            SELECT *, row_number() OVER (PARTITION BY no ORDER BY md5('mix:' || no || ':' || epoch || ':' || block), epoch, block) AS place FROM tk WHERE words > 0
        ), qs AS (
            SELECT list(no ORDER BY no) AS nos, list(quota ORDER BY no) AS ks FROM (SELECT no, count(*) AS quota FROM rk GROUP BY 1)
        ), tree AS (  -- a node draws source by source (i) how many of its n blocks to the left are of the source; then it gives way to two nodes
            SELECT 0 AS lo, greatest(16, (SELECT ceil(sum(target) / 8000000) FROM u))::BIGINT AS hi, 0 AS i, 0::BIGINT AS total, 0::BIGINT AS n, ks, []::BIGINT[] AS lefts FROM qs
            UNION ALL
            SELECT x.lo, x.hi, x.i, x.total, x.n, x.ks, x.lefts FROM (
                SELECT unnest(CASE
                    WHEN i = 0 THEN [{'lo': lo, 'hi': hi, 'i': 1, 'total': list_sum(ks)::BIGINT, 'n': (list_sum(ks)::BIGINT * ((lo + hi) // 2 - lo)) // (hi - lo), 'ks': ks, 'lefts': lefts}]
                    WHEN i <= len(ks) THEN [{'lo': lo, 'hi': hi, 'i': i + 1, 'total': total - ks[i], 'n': n - drawn, 'ks': ks, 'lefts': list_append(lefts, drawn)}]
                    ELSE [{'lo': lo, 'hi': (lo + hi) // 2, 'i': 0, 'total': 0::BIGINT, 'n': 0::BIGINT, 'ks': lefts, 'lefts': []::BIGINT[]},
                          {'lo': (lo + hi) // 2, 'hi': hi, 'i': 0, 'total': 0::BIGINT, 'n': 0::BIGINT, 'ks': list_transform(ks, lambda k, j: k - lefts[j]), 'lefts': []::BIGINT[]}] END) AS x
                FROM (
                    SELECT *, low + len(list_filter(range(1, len(chances) + 1), lambda j: list_sum(chances[1:j]) < chance)) AS drawn FROM (
                        SELECT *, (('0x' || substr(md5('mix:' || lo || ':' || hi || ':' || (i - 1)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS chance,
                            list_transform(range(low, least(good, n) + 1), lambda x: exp(lgamma(good + 1) - lgamma(x + 1) - lgamma(good - x + 1) + lgamma(total - good + 1) - lgamma(n - x + 1)
                                - lgamma(total - good - n + x + 1) - lgamma(total + 1) + lgamma(n + 1) + lgamma(total - n + 1))) AS chances
                        FROM (SELECT *, greatest(0, n - total + good) AS low FROM (SELECT *, CASE WHEN i BETWEEN 1 AND len(ks) THEN ks[i] ELSE 0 END AS good FROM tree WHERE hi - lo > 1)))))
        ), lv AS (
            SELECT lo AS shard, unnest((SELECT nos FROM qs)) AS no, unnest(ks) AS blocks FROM tree WHERE hi - lo = 1 AND i = 0
        ), dr AS (
            SELECT *, sum(blocks) OVER (PARTITION BY no ORDER BY shard) AS upto FROM lv
        ), lies AS (  -- what each draw takes of each document, and where it lies in the shard
            SELECT doc_id, rk.epoch, dr.shard, row_number() OVER (PARTITION BY dr.shard ORDER BY md5('mix:' || rk.epoch || ':' || doc_id), rk.epoch) AS position
            FROM p JOIN rk USING (no, block) JOIN b USING (no, block) JOIN dr ON dr.no = p.no AND rk.place > dr.upto - dr.blocks AND rk.place <= dr.upto WHERE least(size, rk.words - (p.come - b.come)) > 0
        ), sh AS (
            SELECT doc_id, string_agg(shard, ',' ORDER BY epoch) AS shards, string_agg(position, ',' ORDER BY epoch) AS positions FROM lies GROUP BY 1
        )
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (greatest(0, least(size, goal - come)) + greatest(0, least(size, goal - source_size - come)) + greatest(0, least(size, goal - 2 * source_size - come)))::BIGINT AS taken,
               coalesce(shards, '') AS shards, coalesce(positions, '') AS positions
        FROM p LEFT JOIN sh USING (doc_id)
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_winnowing": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), iw AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
        ), dw AS (
            SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
        ), h AS (
            SELECT r, p, n, item_id FROM dw JOIN iw USING (n, g)
        ), c AS (
            SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT r, p, n FROM h)) GROUP BY 1
        ), s AS (
            SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM h WHERE item_id IS NOT NULL) GROUP BY 1
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)
    """,
    "op13_conversation_repair": r"""
        WITH RECURSIVE k AS (  -- the CRC is taken bit by bit
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) AS c FROM conversations
        ), d AS (
            SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM (SELECT *, xor(c, 4294967295) % 20 AS h FROM k) WHERE h <> 0
        ), o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) || left(role, 1) AS pair FROM d
        ), f AS (
            SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM o
        ), s AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM f GROUP BY 1
        ), w AS (  -- the least (cost, audit, lines) for each state after n rows: nothing, system, user, assistant
            SELECT conv_id, 0::BIGINT AS n, {'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]} AS x0, NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) AS x1, NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) AS x2, NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) AS x3 FROM s
            UNION ALL
            SELECT conv_id, n,
                CASE WHEN y0 IS NOT NULL THEN {'c': y0.c + 2, 'a': y0.a || 'D', 'l': y0.l} END,
                least(CASE WHEN y1 IS NOT NULL THEN {'c': y1.c + 2, 'a': y1.a || 'D', 'l': y1.l} END, CASE WHEN ok AND r = 's' AND y0 IS NOT NULL THEN {'c': y0.c + e, 'a': y0.a || 'K', 'l': list_append(y0.l, line)} END),
                least(CASE WHEN y2 IS NOT NULL THEN {'c': y2.c + 2, 'a': y2.a || 'D', 'l': y2.l} END, CASE WHEN ok AND r = 'u' AND u IS NOT NULL THEN {'c': u.c + e, 'a': u.a || 'K', 'l': list_append(u.l, line)} END,
                    CASE WHEN ok AND u IS NOT NULL THEN {'c': u.c + e + 1, 'a': u.a || 'R', 'l': list_append(u.l, 'user:' || text)} END),
                least(CASE WHEN y3 IS NOT NULL THEN {'c': y3.c + 2, 'a': y3.a || 'D', 'l': y3.l} END, CASE WHEN ok AND r = 'a' AND y2 IS NOT NULL THEN {'c': y2.c + e, 'a': y2.a || 'K', 'l': list_append(y2.l, line)} END,
                    CASE WHEN ok AND y2 IS NOT NULL THEN {'c': y2.c + e + 1, 'a': y2.a || 'R', 'l': list_append(y2.l, 'assistant:' || text)} END)
            FROM (
                SELECT *, least(y0, y1, y3) AS u FROM (
                    SELECT f.*, f.role || ':' || f.text AS line, fault IN ('', 't') AS ok, CASE fault WHEN 't' THEN 5 ELSE 0 END AS e, x0 AS y0, x1 AS y1,
                        least(x2, CASE WHEN least(x0, x1, x3) IS NOT NULL THEN {'c': least(x0, x1, x3).c + 5, 'a': least(x0, x1, x3).a || 'I', 'l': list_append(least(x0, x1, x3).l, 'user:')} END) AS y2,
                        least(x3, CASE WHEN x2 IS NOT NULL THEN {'c': x2.c + 5, 'a': x2.a || 'I', 'l': list_append(x2.l, 'assistant:')} END,
                            CASE WHEN least(x0, x1) IS NOT NULL THEN {'c': least(x0, x1).c + 10, 'a': least(x0, x1).a || 'II', 'l': least(x0, x1).l || ['user:', 'assistant:']} END) AS y3
                    FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1))
        ), z AS (
            SELECT conv_id, gaps, blank, duplicate, truncated, illegal, least(x0, x3, CASE WHEN x1 IS NOT NULL THEN {'c': x1.c + 10, 'a': x1.a || 'II', 'l': x1.l || ['user:', 'assistant:']} END, CASE WHEN x2 IS NOT NULL THEN {'c': x2.c + 5, 'a': x2.a || 'I', 'l': list_append(x2.l, 'assistant:')} END) AS b
            FROM w JOIN s USING (conv_id) WHERE w.n = s.rows
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
            sha256(coalesce(array_to_string(b.l, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN z USING (conv_id)
    """,
}
