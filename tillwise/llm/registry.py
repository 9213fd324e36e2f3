"""The queries of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.llm import decontaminate, mixing, near_dup, pii, quality, repeats, secrets, sharding, spelling, tokens, topk, trie, url_filter
from tillwise.llm.common import span_digest

# The rules of the URL query.
RULES = [url_filter.Rule("com", "/", "allow"), url_filter.Rule("example.com", "/en/", "block"), url_filter.Rule("www.example.com", "/en/", "allow"),
         url_filter.Rule("net", "/es/", "block"), url_filter.Rule("net", "/fr/", "block")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return span_digest(pii.find_pii(_table(spark, folder, "documents")), {f"n_{k}": k for k in ("email", "ip", "card", "phone")})


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"), RULES)


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(_table(spark, folder, "embeddings"))


def op4_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.write_and_index(_table(spark, folder, "documents"), tokenizer_path())


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``bytes``; ``moved_shard`` is the shard after the map was edited for one more."""
    out = sharding.assign(_table(spark, folder, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                      "virtual_slot", "map_version", "moved_shard")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return span_digest(secrets.find_secrets(_table(spark, folder, "documents")), {f"n_{k}": k for k in ("assign", "access", "hex")})


def op10_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.classes(_table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, folder, "conversations"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(_table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_url_filter, op3_topk_search, op4_token_output, op5_mix_sources, op6_quality, op7_decontaminate,
                                    op8_sharding, op9_secrets, op10_near_dup, op11_prefix_trie, op12_spelling_variants, op13_substring_dedup)}


MIX_SQL = """
WITH size AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS bytes FROM documents GROUP BY source),
wanted AS (SELECT source, bytes, pow(bytes::DOUBLE, 0.5) AS w FROM size),
rates AS (SELECT source, round(w / (SELECT sum(w) FROM wanted) * 1.0 * (SELECT sum(bytes) FROM wanted) / bytes, 9) AS rate FROM wanted),
draws AS (
  SELECT d.doc_id, d.source, r.rate, CAST('0x' || md5('11:draw|' || coalesce(d.doc_id::VARCHAR, 'null') || '|1')[1:13] AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
cdf AS (
  SELECT rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY rate ORDER BY k) AS p
  FROM (SELECT DISTINCT rate FROM rates WHERE rate > 0), range(0, 161) t(k)),
counted AS (
  SELECT d.doc_id, d.source, d.rate, (SELECT count(*) FROM cdf c WHERE c.rate = d.rate AND c.p <= d.u)::INTEGER AS copies FROM draws d)
SELECT doc_id, source, rate, copies, copy::INTEGER AS copy,
       CAST('0x' || md5('11:place|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy)[1:13] AS BIGINT) / 4503599627370496.0 AS position
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)
"""

TOPK_SQL = """
WITH codes AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '')::BIT AS code FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, n.vec_id AS neighbour_id, bit_count(xor(q.code, n.code))::INTEGER AS distance
  FROM codes q JOIN codes n ON q.vec_id % 50 = 0 AND q.vec_id <> n.vec_id)
SELECT query_id, rank::INTEGER AS rank, neighbour_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs) WHERE rank <= 10
"""


# crc32 of UTF-8 text: ``crc32.t`` is the table of the usual reflected polynomial; a query folds it over the bytes.
CRC_TABLE_SQL = """crc32 AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i))"""
CRC_SQL = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({0})), lambda i: ('0x' || substr(hex({0}), 2 * i + 1, 2))::BIGINT)), "
           "lambda c, b: xor(c >> 8, crc32.t[(xor(c, b) & 255) + 1])), 4294967295)")

TRIE_SQL = f"""
WITH {CRC_TABLE_SQL},
turns AS (
  SELECT conv_id, text, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id, turn, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, {CRC_SQL.format("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc32),
moved AS (
  SELECT c.conv_id, t.pos, t.digest, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos, t.digest, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
rows AS (
  SELECT c.conv_id, coalesce(list(m.digest ORDER BY m.pos) FILTER (WHERE m.pos IS NOT NULL), []) AS seq,
         coalesce(list(len(regexp_extract_all(m.text, '[^\\x20\\x09-\\x0D]+')) ORDER BY m.pos) FILTER (WHERE m.pos IS NOT NULL), []) AS words
  FROM convs c LEFT JOIN moved m ON c.conv_id = m.conv_id GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, d, array_to_string(seq[1:d], '') AS prefix, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w, d = len(seq) AS ends
             FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM rows)),
nodes AS (SELECT coalesce(prefix, '') AS prefix, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(w) AS own,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM prefixes GROUP BY ALL),
children AS (SELECT left(prefix, 32 * (d - 1)) AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
under AS (
  SELECT left(n.prefix, 32 * n.up) AS prefix, sum(own) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM nodes) n LEFT JOIN children c ON n.prefix = c.prefix GROUP BY 1)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       u.leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN under u ON n.prefix = u.prefix LEFT JOIN children c ON n.prefix = c.prefix
LEFT JOIN nodes p ON n.d > 0 AND p.prefix = left(n.prefix, 32 * (n.d - 1))
"""

SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
         FROM documents),
counted AS (SELECT run, coalesce(doc_id::VARCHAR, 'null') || ':' || run AS hashed, count(*) AS n FROM runs GROUP BY ALL),
crcs AS (SELECT run, n, {CRC_SQL.format("hashed")} AS h FROM counted, crc32),
damaged AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM crcs),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM shorter a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, w.n, a.word, a.n FROM shorter a JOIN words w ON a.rest = w.word),
best AS (SELECT word, any_value(n) AS n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
                 CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word),
ends AS (SELECT word, word AS at, form AS next FROM forms
         UNION ALL SELECT e.word, f.word, f.form FROM ends e JOIN forms f ON e.next = f.word)
SELECT f.word, f.form, e.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON f.word = e.word WHERE e.next IS NULL
"""

REPEATS_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT r, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM docs),
windows AS (SELECT r, i AS j, array_to_string(ws[i:i + 34], ' ') AS seq FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM docs)),
repeats AS (SELECT r, j FROM windows WHERE seq IN (SELECT seq FROM windows GROUP BY seq HAVING count(*) > 1)),
marked AS (
  SELECT w.r, w.j, w.word, coalesce(max(CASE WHEN p.j IS NOT NULL THEN 1 END) OVER (PARTITION BY w.r ORDER BY w.j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM words w LEFT JOIN repeats p ON w.r = p.r AND w.j = p.j),
per AS (SELECT r, sum(gone) AS n_removed, list(word ORDER BY j) FILTER (WHERE gone = 0) AS kept FROM marked GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(p.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(p.kept, ' '), '')) AS kept_sha256
FROM docs d LEFT JOIN per p ON d.r = p.r
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_topk_search": TOPK_SQL, "op5_mix_sources": MIX_SQL, "op11_prefix_trie": TRIE_SQL, "op12_spelling_variants": SPELLING_SQL, "op13_substring_dedup": REPEATS_SQL}
