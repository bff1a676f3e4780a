"""The operators over the driver's tables: one query each, with the SQL of the same
result where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.llm import (alignment, bpe, embedding, exact_dedup, html_extract, license_scan, packing, periodic_runs, quality, sharding,
                         simhash, substring, url_filter)
from kenning.llm.common import ready, table

SHARD_BYTES = 1 << 20


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie; the same on driver and executors."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of at most 1 MiB of text by extendible hashing of doc_id."""
    return sharding.extendible_shards(table(ready(spark), sf_dir, "documents"), SHARD_BYTES)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(ready(spark), sf_dir, "documents"), digest="text_sha256")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(ready(spark), sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    model = quality.train(docs, quality.not_held_out(table(spark, sf_dir, "labels")))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(ready(spark), sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring.substring_dedup(table(ready(spark), sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(ready(spark), sf_dir, "documents"), width=3, max_bits=2)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedding_groups(table(ready(spark), sf_dir, "embeddings"), threshold=0.9)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    return (bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"))
            .select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (html_extract.extract_main_text(table(ready(spark), sf_dir, "pages"))
            .select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")))


# Fixed by the query's contract: verdict, host, start of the path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_filter.judge_urls(table(ready(spark), sf_dir, "pages"), URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(ready(spark), sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                     tokenizer_path("piece_bpe_32k.model"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest_columns(periodic_runs.periodic_runs(table(ready(spark), sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_exact_dedup, op3_license_scan, op4_quality, op5_packing, op6_substring_dedup,
                                   op7_simhash, op8_embedding_dedup, op9_bpe, op10_html_extract, op11_url_filter, op12_alignment,
                                   op13_periodic_runs)}

_BITS = """string_agg(list_extract(['0000','0001','0010','0011','0100','0101','0110','0111',
 '1000','1001','1010','1011','1100','1101','1110','1111'], instr('0123456789abcdef', substr({h}, i, 1))), '' ORDER BY i)"""

_BARE = url_filter.HIDDEN.replace("'", "''")
_TAG = url_filter.LINK_TAG.replace("++", "+").replace("*+", "*").replace("'", "''")
_HOST = url_filter.LINK_HOST.replace("'", "''")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    # every prefix of every row's hash with its size; a row's bucket is the shortest one that fits
    "op1_sharding": f"""
WITH src AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes, md5(doc_id::VARCHAR) AS h FROM documents),
hashed AS (SELECT doc_id, n_bytes, {_BITS.format(h='h')} AS bits FROM src, range(1, 16) r(i) GROUP BY doc_id, n_bytes, h),
level AS (SELECT doc_id, n_bytes, d, substr(bits, 1, d) AS p FROM hashed, range(0, 61) g(d)),
size AS (SELECT d, p, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM level GROUP BY d, p)
SELECT doc_id, n_bytes, p AS shard_id, d::INTEGER AS depth, shard_bytes, shard_rows, shard_bytes > {SHARD_BYTES} AS oversize
FROM level JOIN size USING (d, p) WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1""",
    "op2_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
 row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY cp DESC, doc_id)""",
    "op6_substring_dedup": r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS k FROM
 (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50)),
low AS (SELECT k, min(doc_id) AS low FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN low USING (k) WHERE low < doc_id),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    # all pairs; of the ids that a vector reaches through larger ones the smallest is its component's
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
 WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
 ON a.vec_id <> b.vec_id AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 ELSE false END),
reach AS (SELECT vec_id AS id, vec_id AS low FROM embeddings UNION SELECT b, low FROM reach JOIN link ON a = id WHERE low < b),
component AS (SELECT id, min(low) AS low FROM reach GROUP BY id), degree AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low AS component_id, vec_id = low AS kept
FROM embeddings JOIN component c ON c.id = vec_id LEFT JOIN degree d ON d.id = vec_id""",
    # the same pushes along the edges, each step the sum of what the last one sent
    "op11_url_filter": rf"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
page AS (SELECT row_number() OVER () AS r, page_id, html,
 coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (SELECT r, max((length(rhost || rpath), rhost || rpath, verdict)) AS m FROM page JOIN rules
 ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY r),
judged AS (SELECT page.*, m[2] AS rule, m[3] AS verdict FROM page LEFT JOIN fit USING (r)),
tag AS (SELECT host AS src, unnest(regexp_extract_all(regexp_replace(coalesce(html, ''), '{_BARE}', ' ', 'g'), '{_TAG}')) AS tag FROM page),
link AS (SELECT src, translate(regexp_extract(tag, '{_HOST}', 1), '{_UPPER}', '{_LOWER}') AS dst, count(*) AS n FROM tag GROUP BY ALL),
both_ways AS (SELECT 'allow' AS kind, src AS host, dst AS target, n FROM link WHERE src <> '' AND dst <> '' AND src <> dst
 UNION ALL SELECT 'block', dst, src, n FROM link WHERE src <> '' AND dst <> '' AND src <> dst),
edge AS (SELECT kind, host, target, n / sum(n) OVER (PARTITION BY kind, host) AS share FROM both_ways),
mass AS (SELECT 0 AS step, verdict AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY verdict) AS mass
 FROM judged WHERE verdict IS NOT NULL GROUP BY verdict, host
 UNION ALL SELECT step + 1, kind, target, sum(mass * share) * {url_filter.DAMPING}
 FROM mass JOIN edge USING (kind, host) WHERE step < {url_filter.STEPS} GROUP BY step, kind, target),
standing AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'block'), 0) AS bad, sum(mass) AS whole FROM mass GROUP BY host)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad / whole > {url_filter.BLOCK_SHARE} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN standing USING (host)""",
}
