"""The queries of this folder: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import ann, burst_trie, chat_format, decontaminate, language, line_dedup, minmax, ngram_join, packing, permuterm, ppm, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The file of a public tokenizer as installed on every node."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to archives and read back."""
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables, each row with its ``doc_id`` or ``page_id``; pages have markup, address suffix, domain and host as evidence."""
    docs = language.identify_documents(_table(spark, sf_dir, "documents")).drop("text_key").withColumn("table", F.lit("documents"))
    pages = language.identify_pages(_table(spark, sf_dir, "pages")).drop("text_key").withColumn("table", F.lit("pages"))
    return docs.unionByName(pages, allowMissingColumns=True)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words and hits by the windows of all benchmark items."""
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(found)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and the smallest id its links reach."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by the clause grammar."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the word base and by prediction by partial matching."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return ppm.score_documents(_table(spark, sf_dir, "documents"), held_out)


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the formatted windows."""
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.read_chat(chat_format.format_chat(turns)))


def op9_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document without the blocks that earlier ones hold."""
    return line_dedup.digests(_table(spark, sf_dir, "documents"))


def op11_min_max_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size, the smallest id its links reach, and whether it is kept."""
    return minmax.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_burst_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return burst_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its near words' number, its form and the root its forms lead to."""
    return permuterm.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = (op1_warc_revisits, op2_language_id, op3_decontamination, op4_ngram_jaccard_join, op5_toxicity_grammar, op6_packing, op7_ppm_scoring, op8_chat_windows, op9_one_bit_codes, op10_line_alignment, op11_min_max_hashing, op12_burst_tries, op13_permuterm)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_revisits": warc.ORACLE,
        "op3_decontamination": decontaminate.ORACLE,
        "op4_ngram_jaccard_join": ngram_join.ORACLE,
        "op8_chat_windows": chat_format.ORACLE,
        "op9_one_bit_codes": ann.ORACLE,
        "op10_line_alignment": line_dedup.ORACLE,
        "op11_min_max_hashing": minmax.ORACLE,
        "op12_burst_tries": burst_trie.ORACLE,
        "op13_permuterm": permuterm.ORACLE,
    }
