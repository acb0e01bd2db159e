"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (buckets, clusters, common, decontam, linechunks, packing, prefixes, quality, secrets, simhash, suffixes, tokens,
               toxicity, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokens.token_files(table(spark, sf_dir, "documents"), common.tokenizer_path(), end_id=2, keep_ids=False)
    return files.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), common.tokenizer_path(), end_id=0, capacity=2048)


def op3_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=3, shingle=3, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_boilerplate", "base_failed", "kept")


def op5_nearest_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "neighbours")


def op6_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_chunks", "n_removed", "text")


def decontamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontam.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def secret_digest(docs: DataFrame) -> DataFrame:
    found = secrets.scan(docs)
    base = [r.kind for r in secrets.BASE_RULES]

    def text_of(spans: str):
        return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    listed = ", ".join(f"'{k}'" for k in base)
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(text_of(f"filter(spans, s -> s.kind in ({listed}))"), 256).alias("base_sha256"),
                        text_of("spans").alias("spans"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def removed_digest(found: DataFrame) -> DataFrame:
    left = F.make_valid_utf8(F.col("kept").cast("string"))  # a removed run may have cut a character
    n_removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.b - s.a)")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"), left.alias("text"), left.alias("kept"))


def op9_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_digest(suffixes.deduplicated(table(spark, sf_dir, "documents"), length=400))


def op10_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"), keep_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.tokenizer_path("word_bpe_49k.json")
    return buckets.pack(table(spark, sf_dir, "documents"), path, end_id=2, capacity=4096)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.k_means(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, salt="2:")


OP10_SQL = """
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN strlen(payload) >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(payload) >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))
"""


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
base AS (SELECT doc_id, host, text, lines, len(words) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines FROM w),
grams AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w) WHERE i + 2 <= len(words)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM twice, range(3) r(o) GROUP BY doc_id),
line AS (SELECT doc_id, host, text, unnest(lines) AS line FROM base),
keyed AS (SELECT doc_id, host, text, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    array_to_string(regexp_extract_all(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[^\x20\x09-\x0D]+'), ' ') AS k FROM line),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM d GROUP BY host),
bad AS (SELECT host, k FROM (SELECT host, k, count(DISTINCT text) AS holders FROM keyed GROUP BY host, k) JOIN hosts USING (host)
  WHERE holders > 2 AND holders > 0.05 * texts),
gone AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_boilerplate FROM keyed JOIN bad USING (host, k) GROUP BY doc_id),
m AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_boilerplate, 0) AS n_boilerplate FROM base LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT (n_boilerplate > 0 AND (n_words - n_boilerplate < 50 OR n_words - n_boilerplate < 0.5 * n_words)) AS kept
FROM v
"""

OP7_SQL = r"""
WITH t AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM t),
items AS (SELECT id, words, least(13, len(words)) AS span FROM w WHERE side = 'i' AND len(words) > 0),
spans AS (SELECT DISTINCT span FROM items),
item_windows AS (SELECT DISTINCT id AS item, span, array_to_string(words[i:i + span - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - span + 2)) AS i FROM items)),
doc_windows AS (SELECT id, span, i, array_to_string(words[i:i + span - 1], ' ') AS win
  FROM (SELECT id, words, span, unnest(range(1, greatest(len(words) - span + 2, 1))) AS i FROM w, spans WHERE side = 'd')),
hits AS (SELECT id, d.span, i, item FROM doc_windows d JOIN item_windows m ON d.span = m.span AND d.win = m.win),
places AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + span)) AS p FROM hits) GROUP BY id),
found AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY id)
SELECT w.id AS doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN places USING (id) LEFT JOIN found USING (id) WHERE side = 'd'
"""


OP12_SQL = """
WITH t AS (SELECT conv_id, turn, md5(length(r) || ':' || r || x) AS k, length(x) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS i FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS giver, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, i, k, chars FROM c JOIN n ON n.conv_id = giver WHERE i < h
  UNION ALL SELECT c.conv_id, 1, i, k, chars FROM c JOIN n ON n.conv_id = c.conv_id WHERE i >= h),
l AS (SELECT conv_id, list(k ORDER BY part, i) AS ks, list(chars ORDER BY part, i) AS cs FROM r GROUP BY conv_id),
p AS (SELECT *, unnest(range(len(ks) + 1)) AS d FROM (
  SELECT conv_id, coalesce(ks, []) AS ks, coalesce(cs, []) AS cs FROM c LEFT JOIN l USING (conv_id))),
q AS (SELECT conv_id, d, len(ks) AS turns, array_to_string(ks[1:d], '') AS node, array_to_string(ks[1:d - 1], '') AS up,
    CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars FROM p),
m AS (SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CASE WHEN turns = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM q GROUP BY node, d),
kids AS (SELECT up AS node, count(*) AS n_children FROM m WHERE d > 0 GROUP BY up),
s AS (SELECT q.node, CAST(sum((x.n_convs - 1) * x.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM m x JOIN q ON q.conv_id = x.conv_id AND q.d <= x.d LEFT JOIN kids k ON k.node = x.node GROUP BY q.node)
SELECT m.conv_id, m.d AS depth, a.conv_id AS parent_conv_id, m.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  m.ends_sha256
FROM m JOIN s USING (node) LEFT JOIN kids USING (node) LEFT JOIN m a ON m.d > 0 AND a.node = m.up
"""


def op13_sql(k: int = 40, rounds: int = 5) -> str:
    """Whole numbers as doubles, so list products are exact; a distance and a number make one sort key."""
    far = "list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y)"
    steps = [f"""
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x, row_number() OVER () AS rid FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY name, x) - 1 AS c, x AS y
  FROM (SELECT *, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS name FROM v ORDER BY name, x LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS (SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, min(({far}) * 1024 + c)::BIGINT AS best "
                     f"FROM v, c{r} GROUP BY rid)")
        steps.append(f"""s{r} AS (SELECT c, list(floor(total / n) ORDER BY i) AS y FROM (
  SELECT best % 1024 AS c, i, sum(x[i]) AS total, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY ALL) GROUP BY c),
c{r + 1} AS (SELECT c, coalesce(s{r}.y, c{r}.y) AS y FROM c{r} LEFT JOIN s{r} USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, (best % 1024)::INTEGER AS cluster, best // 1024 AS distance,
  sum(best // 1024) OVER (PARTITION BY best % 1024)::BIGINT AS cluster_inertia, sum(best // 1024) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(y, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best % 1024"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_simhash_near_dup": op3_simhash_near_dup,
        "op4_quality_rules": op4_quality_rules,
        "op5_nearest_toxicity": op5_nearest_toxicity,
        "op6_line_chunk_dedup": op6_line_chunk_dedup,
        "op7_winnowing_decontamination": op7_winnowing_decontamination,
        "op8_secret_scan": op8_secret_scan,
        "op9_run_length_dedup": op9_run_length_dedup,
        "op10_warc_capture_index": op10_warc_capture_index,
        "op11_power_of_two_packing": op11_power_of_two_packing,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_bit_plane_clusters": op13_bit_plane_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_rules": OP4_SQL,
        "op7_winnowing_decontamination": OP7_SQL,
        "op10_warc_capture_index": OP10_SQL,
        "op12_prefix_trie": OP12_SQL,
        "op13_bit_plane_clusters": op13_sql(),
    }
