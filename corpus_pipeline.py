"""Documents from raw to packed: toxic ones go, near-duplicates go, repeated passages and personal data are cut, the rest is packed.

Each stage takes (spark, docs, sf_dir), works on all rows of docs, and its result is written before the next one reads it. All but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.llm.ngram_join import near_duplicates
from tasador.llm.packing import pack_documents
from tasador.llm.pii import sanitised_texts
from tasador.llm.scratch import stored, table
from tasador.llm.suffix_dedup import shortened_texts
from tasador.llm.toxicity import toxicity

#: Names of columns added for joins; no table has them.
ID, KEY, NEW = "tasador joined id", "tasador joined key", "tasador new text"


def _named(found: DataFrame, text: str | None = None) -> DataFrame:
    return found.select(F.col("doc_id").alias(ID), F.col("key").alias(KEY), *([F.col(text).alias(NEW)] if text else []))


def _same() -> Column:
    return (F.xxhash64("text") == F.col(f"`{KEY}`")) & F.col("doc_id").eqNullSafe(F.col(f"`{ID}`"))


def _own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _with_texts(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """docs with the new texts where there is one, and n_chars after them."""
    joined = docs.join(_named(found, text), _same(), "left")
    new = F.coalesce(F.col(f"`{NEW}`"), F.col("text"))
    changed = {"text": new, "n_chars": F.when(F.col(f"`{NEW}`").isNotNull(), F.length(new).cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return joined.select(*[changed[c].alias(c) if changed.get(c) is not None else F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scores do not reject. Texts and ids may be null; such rows are scored as well."""
    rejected = toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select("doc_id", "key").distinct()
    return docs.join(_named(rejected), _same(), "left_anti")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest doc_id, once; documents without words or doc_id stay, repeated rows of one once."""
    gone = near_duplicates(docs).where("doc_id <> component_id").select("doc_id", "key").distinct()
    left = docs.join(_named(gone), _same(), "left_anti").withColumn(KEY, F.xxhash64("text"))
    return left.dropDuplicates(["doc_id", KEY]).select(*_own(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that begin in a smaller doc_id; texts get shorter, no document goes."""
    return _with_texts(docs, shortened_texts(docs), "kept_text")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms generalised; no document goes."""
    return _with_texts(docs, sanitised_texts(docs), "clean_text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one),
    ("suffix_array_dedup", cut_repeats),
    ("pii", hide_personal_data),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on all documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: SQL has no tokenizer; the stages are tested against plain Python.
ORACLE_SQL = None
