"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.llm.bit_search import top_k
from tasador.llm.byte_bpe import encode_decode
from tasador.llm.hard_negatives import hard_negatives
from tasador.llm.licenses import license_summary
from tasador.llm.line_quality import quality
from tasador.llm.ngram_join import near_duplicates
from tasador.llm.packing import pack_documents
from tasador.llm.permutation_search import nearest
from tasador.llm.pii import personal_data_summary
from tasador.llm.resampling import resample
from tasador.llm.scratch import table
from tasador.llm.sharding import shard_documents
from tasador.llm.suffix_dedup import repeat_summary
from tasador.llm.toxicity import toxicity


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("key")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows with the largest inner product of whole components for each query."""
    return top_k(table(spark, sf_dir, "embeddings"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they stand for."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = encode_decode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for each query."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return personal_data_summary(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that begin in an earlier one."""
    return repeat_summary(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return license_summary(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from the labels of its lines, learned from the document labels that are not held out."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; rows whose vec_id is divisible by 7 take the next of ten labels first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved)).drop("anchor")


OPERATORS = (op1_ngram_jaccard_join, op2_toxicity, op3_bit_sliced_top_k, op4_byte_bpe, op5_permutation_index, op6_best_fit_packing, op7_pii, op8_suffix_array_dedup, op9_license_scan, op10_sharding, op11_importance_resampling, op12_line_quality, op13_hard_negatives)
QUERIES = {f.__name__: f for f in OPERATORS}

SQL = {
    "op1_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))
                                      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS gram FROM w),
s AS (SELECT w.doc_id, count(gram) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id),
met AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM met JOIN s x ON x.doc_id = u JOIN s y ON y.doc_id = v WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach AS (SELECT doc_id, doc_id AS far FROM s UNION SELECT doc_id, v FROM reach JOIN links ON far = u)
SELECT s.doc_id, n AS n_shingles, min(far) AS component_id FROM s JOIN reach USING (doc_id) GROUP BY s.doc_id, n""",
    "op3_bit_sliced_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(c.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
QUALIFY rank <= 20""",
    "op11_importance_resampling": r"""
WITH tab AS (SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
v AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
own AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM w) GROUP BY ALL),
far AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM v) GROUP BY word),
spelled AS (SELECT word, hex(word) AS h FROM (SELECT word FROM own UNION SELECT word FROM far)),
hashed AS (
  SELECT word, xor(list_reduce(list_transform(range(1, len(h) // 2 + 1), lambda k: CAST('0x' || substr(h, 2 * k - 1, 2) AS BIGINT)),
                               lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket FROM spelled, tab),
s AS (SELECT bucket, sum(n)::DOUBLE AS s FROM own JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::DOUBLE AS t FROM far JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket)),
weighed AS (SELECT doc_id, sum(n) AS n, sum(n * g) AS weight FROM own JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || w.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN weighed USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_sum(list_transform(range(1, len(c.e) + 1), lambda i: a.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
}
