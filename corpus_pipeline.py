"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what
it returns is written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.

1. language ID: documents without an identified language go.
2. line dedup: blocks of lines that an earlier document holds are cut; a document that
   loses all its lines goes.
3. n-gram Jaccard join: one document of each group of near duplicates stays.
4. benchmark decontamination: documents that hold a window of a benchmark item go.
5. packing: the documents as pieces of packed token sequences.

Rows may repeat; null ids and texts, empty texts and empty tables pass through every stage
by the rules of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import decontaminate, language, line_dedup, ngram_join, packing
from feedlens.llm.registered import tokenizer_path
from feedlens.llm.storage import fresh_names, scratch, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, unchanged."""
    rejected_id, rejected_key = fresh_names(docs, "rejected_id", "rejected_key")
    with scratch(spark):
        found = language.identify_documents(docs).where(~F.col("kept"))
        rejected = stored(found.select(F.col("doc_id").alias(rejected_id), F.col("text_key").alias(rejected_key)).distinct(), "rejected", keep=True)
    same = docs["doc_id"].eqNullSafe(rejected[rejected_id]) & (F.xxhash64(docs["text"]) == rejected[rejected_key])
    return docs.join(rejected, same, "left_anti")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that earlier documents hold; ``n_chars`` follows the text."""
    (removed,) = fresh_names(docs, "removed")
    cut = line_dedup.remove_repeats(docs, removed_col=removed)
    left = cut.where((F.size(removed) == 0) | (F.col("text") != ""))
    n_chars = F.when(F.size(removed) == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, unchanged."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", dedup_near),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("packing", pack),
]

#: connected components, alignment and tokenisation are beyond SQL; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns what the last one makes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = stored(out, name) if k + 1 < len(STAGES) else out
    return docs
