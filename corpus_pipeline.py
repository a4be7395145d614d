"""Cleaning of a corpus: language, near-duplicates, benchmark passages, secrets, then packing.

Each stage takes (spark, docs, sf_dir), works on all rows the one before left, and is written to the
shared folder before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm import decontaminate, jaccard, language, packing, secrets
from cdclake.llm.tables import column, fresh, id_filter, passes, with_struct, written

#: Documents less like any language learned are rejected if they are long enough to tell.
LEAST_LIKE, LONG_ENOUGH = 0.05, 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in some language: those that have letters, and are like one that was learned if they are long."""
    told = fresh(docs, "language")
    found = language.predict(docs, language.learn(docs), told)
    like = (F.col(f"{told}.score") >= LEAST_LIKE) | (F.length("text") < LONG_ENOUGH)
    return found.filter((F.col(f"{told}.lang_pred") != language.UNKNOWN) & like).select(*[column(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest id, of each group of near-duplicates.

    Rows that repeat an id are one document. Rows without an id are kept. Documents are not shuffled,
    but for those that a bounded filter of ids cannot let pass.
    """
    found = jaccard.ngram_join(docs).filter("doc_id IS NOT NULL")
    found = found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n"))
    told = written(found.filter("NOT kept OR n > 1").select(F.col("doc_id").alias("id"), "kept"), "decided")
    bits = id_filter(told, "id")
    marked = fresh(docs, "decided")

    def look(texts: pa.Array, rows: pa.StructArray) -> list[pa.Array]:
        ids = rows.field("doc_id").cast(pa.int64())
        there = ids.is_valid().to_numpy(zero_copy_only=False)
        return [pa.array(passes(ids.fill_null(0).to_numpy(zero_copy_only=False), bits) & there)]

    split = with_struct(docs, marked, "maybe boolean", lambda: look, "text")
    columns = [column(c) for c in docs.columns]
    rest = split.filter(~F.col(f"{marked}.maybe")).select(*columns)
    maybe = split.filter(F.col(f"{marked}.maybe")).select(*columns)
    gone = told.filter("NOT kept").select("id")
    left = maybe.join(gone, maybe["doc_id"] == gone["id"], "left_anti").dropDuplicates(["doc_id"])
    return rest.unionByName(left)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of which less than one word in twenty is in passages of the benchmark."""
    told = fresh(docs, "contamination")
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), told)
    return found.filter(~F.col(f"{told}.contaminated")).select(*[column(c) for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with secrets in their texts replaced, and lengths that follow."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
