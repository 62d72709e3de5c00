"""The registered queries of this subpackage and, where SQL can state them, their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, importance, language_id, mixing, ngram_join, packing, quality_rules, resharding, spelling
from . import suffix_array, suffix_automaton, url_filter, warc

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = resharding.reshard(documents(spark, sf_dir), resharding.old_shard_of_file(), row=resharding.row_in_file())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


def op2_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_automaton.remove_repeats(documents(spark, sf_dir))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).drop("shrunk_rate")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge_urls(pages).drop("block_probability")


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_array.remove_repeats(documents(spark, sf_dir))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_resharding, op2_suffix_automaton, op3_quality_rules, op4_ngram_join, op5_language_id, op6_mixing, op7_url_filter,
        op8_suffix_array, op9_packing, op10_exact_dedup, op11_warc, op12_spelling, op13_importance,
    )
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _crc32(data: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a string's UTF-8 bytes, bit by bit from its polynomial."""
    crc_bytes = f"list_transform(range(octet_length(encode({data}))), lambda i: ('0x' || substr(hex(encode({data})), 2 * i + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc_table[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {crc_bytes}), {step}), 4294967295)"


_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table
)"""

ORACLE: dict[str, str] = {
    "op3_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d
), tri AS (
  SELECT r, i, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p AS t FROM w
  WINDOW p AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i FROM tri WHERE t IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, t) > 1
), covered AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r
), lines AS (
  SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL
), dup AS (
  SELECT r, sum(n - 1) AS n FROM lines GROUP BY r
), m AS (
  SELECT d.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN dup ON d.r = dup.r LEFT JOIN covered ON d.r = covered.r
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT source AS host, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS failed FROM b GROUP BY source
), moments AS (
  SELECT least(greatest(avg(failed / n), 1e-6), 1 - 1e-6) AS mean, var_pop(failed / n) AS v FROM h
), prior AS (
  SELECT mean, least(greatest(mean * (1 - mean) / greatest(v, 1e-9) - 1, 1), 1000) AS strength FROM moments
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (failed + mean * strength) / (n + strength) <= 0.5 AS kept
FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.host, prior
""",
    "op6_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    (source_size * 2)::DOUBLE AS most FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, encode(source) NULLS LAST) AS k FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER b, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM o WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, most, weight, most <= level * weight AS full,
    min_by(level, k) FILTER (NOT most <= level * weight) OVER () AS level FROM l
), r AS (
  SELECT source, source_size, CASE WHEN "full" THEN most ELSE level * weight END AS target FROM t
), e AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM e
""",
    "op10_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""",
    "op11_warc": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), g AS (
  SELECT payload, max(page_id) AS top, sha1(payload) AS digest FROM p GROUP BY payload
)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(digest, 10 * (k // 8) + 1, 10))::BIGINT >> (35 - 5 * (k % 8))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN g USING (payload)
""",
    "op12_spelling": rf"""
WITH RECURSIVE {_CRC_TABLE}, run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), per AS (
  SELECT doc_id || ':' || run AS id, run, count(*) AS n FROM run GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {_crc32('id')} AS h FROM per, crc
), counted AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM counted WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gap AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less, left(word, i - 1) || '$' || substr(word, i + 1) AS marked
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS other, b.n FROM gap a JOIN gap b ON a.marked = b.marked AND a.word <> b.word
    UNION ALL SELECT g.word, w.word, w.n FROM gap g JOIN words w ON g.less = w.word
    UNION ALL SELECT w.word, g.word, g.n FROM gap g JOIN words w ON g.less = w.word
  )
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS near_n FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n,
    CASE WHEN near_n >= 2 * w.n THEN decode((SELECT min(encode(x.other)) FROM near x WHERE x.word = w.word AND x.n = near_n)) END AS form
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
), last AS (
  SELECT c.word, c.root FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NULL
)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN last USING (word)
""",
    "op13_importance": rf"""
WITH {_CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS words
  FROM documents
), b AS (
  SELECT list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS words
  FROM benchmark
), dw AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY r, word
), bw AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY word
), bucket AS MATERIALIZED (
  SELECT word, {_crc32('word')} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc
), counts AS (
  SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM (
    SELECT word, n AS s, 0 AS t FROM dw UNION ALL SELECT word, 0, n FROM bw
  ) JOIN bucket USING (word) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM counts, totals
), weights AS (
  SELECT r, sum(n * gain)::BIGINT AS weight FROM dw JOIN bucket USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)
), placed AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS eligible FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= eligible * 10 // 100 THEN place END AS rank FROM placed
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < 20
""",
}
