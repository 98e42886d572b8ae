"""Registered queries of the subpackage: opN_<name>(spark, sf_dir), each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.llm import (ann, bpe, decontaminate, fill_in_middle, html_extract, language_id, lm_scoring, prefix_trie, quality,
                         sharding, simhash, substring_dedup, warc)
from airwave.llm.common import table

REGISTRY: dict = {}
ORACLES: dict = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs, min_words=20).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.learn(docs.where(~out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), "lang_pred", "score").withColumn("held_out", out)


@register
def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = bpe.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op9_feistel_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents"), shards=8)


@register
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality.classify(docs, table(spark, sf, "labels"), lambda i: ~language_id.held_out(i, 5, 0))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "score").withColumns({
        "held_out": language_id.held_out(F.col("doc_id"), 5, 0),
        "predicted": F.when(F.col("score") >= 0.3, 1).otherwise(0)})


@register
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    files = warc.write(table(spark, sf, "pages"), warc.archive_folder(spark), min_bytes=0)
    return warc.read(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, table(spark, sf, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "item_id", "score", "question_overlap", "answer_overlap",
                        "first_word")


@register
def op3_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op3_ann"] = """
WITH part AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_aggregate([CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END FOR x IN embedding], 'sum') = 0
    AND list_aggregate([CASE WHEN x = 0 THEN 0 ELSE 1 END FOR x IN embedding], 'sum') > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(q.v, c.v)])) AS score
  FROM part q JOIN part c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@register
def op5_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    model = html_extract.train(html_extract.labelled_sample(pages, table(spark, sf, "documents")))
    return html_extract.extract(pages, model).select(
        F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text", "n_chars")


ORACLES["op1_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS g FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM again) GROUP BY 1
), cut AS (
  SELECT t.doc_id, len(t.w) AS n, coalesce(len(g.g), 0) AS r,
    CASE WHEN g.g IS NULL THEN t.w ELSE [x.w FOR x IN list_transform(t.w, lambda w, i: {'w': w, 'i': i})
      IF NOT list_contains(g.g, x.i)] END AS kept
  FROM words t LEFT JOIN gone g USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM cut
"""

ORACLES["op4_warc"] = """
WITH hashed AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages
), bits AS (
  SELECT *, array_to_string([lpad(bin(strpos('0123456789abcdef', x) - 1), 4, '0') FOR x IN string_split(h, '')], '') AS b
  FROM hashed
), named AS (
  SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(list_sum([CAST(substr(b, 5 * k + j + 1, 1) AS INTEGER) * (16 >> j) FOR j IN range(5)]) AS BIGINT) + 1, 1)
    FOR k IN range(32)], '') AS digest, min(page_id) OVER (PARTITION BY h) AS first FROM bits
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM named
"""


@register
def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = prefix_trie.numbered(prefix_trie.turn_rows(table(spark, sf, "conversations")))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    rebuilt, members = prefix_trie.with_shared_heads(turns, 5, head, 8)
    return prefix_trie.nodes(rebuilt, members).nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# CRC-32 bit by bit: DuckDB has no such function.
CRC32 = """4294967295 - list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda ch: CAST(ord(ch) AS BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b)] || CAST(range(8) AS BIGINT[]),
      lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))"""

ORACLES["op11_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), substr(coalesce(text, ''), 1, 64),
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS lender, ({CRC32.format("CAST(conv_id AS VARCHAR)")}) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS side, t.p, t.t, t.text FROM heads c JOIN turns t ON t.conv_id = c.lender AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.p, t.t, t.text FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h
), listed AS (
  SELECT c.conv_id, coalesce(l, []) AS l, coalesce(b, []) AS b FROM heads c LEFT JOIN (
    SELECT conv_id, list(t ORDER BY side, p) AS l, list(strlen(text) ORDER BY side, p) AS b FROM rebuilt GROUP BY 1) USING (conv_id)
), members AS (
  SELECT conv_id, d, len(l) AS n, sha256(array_to_string(l[1:d], ',')) AS node, CASE WHEN d = 0 THEN 0 ELSE b[d] END AS size,
    CASE WHEN d > 0 THEN sha256(array_to_string(l[1:d - 1], ',')) END AS above
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM listed)
), nodes AS (
  SELECT node, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(size) AS size, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends,
    count(*) FILTER (n = d) = count(*) AS leaf
  FROM members GROUP BY node
), below AS (
  SELECT m.node, count(*) FILTER (v.leaf) AS n_leaves, sum((v.n_convs - 1) * v.size) AS saved
  FROM nodes v JOIN members m ON m.conv_id = v.conv_id AND m.d <= v.depth GROUP BY 1
), kids AS (
  SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY 1
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v LEFT JOIN nodes u ON u.node = v.above LEFT JOIN kids k ON k.node = v.node JOIN below b ON b.node = v.node
"""


@register
def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    drawn = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(drawn, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    made = fill_in_middle.fill_in_middle(docs, h1, h2, plain=h3 % 100 >= 90, spm=h4 % 100 < 20)
    return made.select(F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLES["op12_fill_in_middle"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbers AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d FROM drawn
), cut AS (
  SELECT doc_id, t, n, least(a, b) AS x, greatest(a, b) AS y,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
         WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, x) || '<S>' || substr(t, y + 1) || '<M>' || substr(t, x + 1, y - x)
    ELSE '<S>' || substr(t, y + 1) || '<P>' || substr(t, 1, x) || '<M>' || substr(t, x + 1, y - x) END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM cut
"""


@register
def op13_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = language_id.held_out(F.col("doc_id"), 7, 2)
    scored = lm_scoring.score(docs, ~out, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return scored.select(F.col("row.doc_id").alias("doc_id"), (~F.col("learns")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score", "n_subwords")
