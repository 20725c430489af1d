"""Benchmark decontamination by n-gram windows, with DataFrame functions only.

The windows of all benchmark items become one row per distinct window (64-bit hash, words,
items).  Their number is counted; up to ``max_broadcast`` windows they are broadcast as a
hash set, beyond that the same join is left to a shuffle.  Documents are scanned window by
window inside one generated loop: a position is exploded, its window hashed, looked up
and, on a hash match, compared word by word.  Only hits, and one marker row per document,
leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.storage import fresh_names, only

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what separates words once A-Z are lower case, and in the text as it is
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: distinct benchmark windows that are broadcast at most (about 200 bytes each)
MAX_BROADCAST = 400_000


def words_of(text: Column) -> Column:
    """The normalised words of a text; none for null."""
    split = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), _SEPARATORS)
    return F.array_remove(split, "")


def benchmark_windows(benchmark: DataFrame, *, id_col: str = "item_id", text_col: str = "text", width: int = 10) -> DataFrame:
    """(hash, win, items): the distinct windows of the items, each with the sorted ids of its items.

    An item of fewer words than ``width``, but not none, is one window.
    """
    words = only(benchmark, item=id_col, text=text_col).select("item", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(width))
    at = words.select("item", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
    wins = at.select("item", F.slice("words", F.col("at"), F.col("length")).alias("win"))
    return wins.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items")).select(F.xxhash64("win").alias("hash"), "win", "items")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, spans, contaminated.

    Words are lower-cased (A-Z) runs of ASCII letters, digits and any other characters
    outside ASCII.  A document word inside an occurrence of an item's window is hit.
    ``items`` are the sorted ids of the items with a window in the document; ``spans`` the
    hit runs as (first word from 0, number of words), apart and in order.  Null and empty
    texts have no words; repeated rows give equal rows; rows that share a doc_id but not
    the text are judged apart; a null item id counts as no item, its windows still hit.
    An empty benchmark hits nothing, empty ``docs`` give no rows.  Other columns play no part.
    """
    grams = benchmark_windows(benchmark, id_col=item_id_col, text_col=item_text_col, width=width)
    sizes = {r["length"]: r["n"] for r in grams.groupBy(F.size("win").alias("length")).agg(F.count("*").alias("n")).collect()}  # at most ``width`` rows
    grams = grams.withColumnRenamed("win", "item_win")
    if sum(sizes.values()) <= max_broadcast:
        grams = F.broadcast(grams)
    rows = only(docs, doc_id=id_col, text=text_col)
    scan = rows.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    lengths = sorted(sizes) or [width]
    # position -1 marks the document; a window starts at every other position
    if len(lengths) > 1:
        scan = scan.withColumn("length", F.explode(F.array(*[F.lit(x) for x in lengths])))
    else:
        scan = scan.withColumn("length", F.lit(lengths[0]))
    scan = scan.withColumn("at", F.explode(F.sequence(F.lit(-1), F.greatest(F.col("n") - F.col("length"), F.lit(-1)))))
    scan = scan.select("doc_id", "text_key", "n", "length", "at", F.when(F.col("at") >= 0, F.slice("words", F.greatest(F.col("at"), F.lit(0)) + 1, F.col("length"))).alias("win"))
    scan = scan.withColumn("hash", F.when(F.col("at") >= 0, F.xxhash64("win")))
    found = scan.join(grams, (scan["hash"] == grams["hash"]) & (F.col("win") == F.col("item_win")), "left").where("at = -1 OR items IS NOT NULL")
    hit = F.when(F.col("at") >= 0, F.struct(F.col("at").alias("first"), F.col("length").alias("length")))
    per = found.groupBy("doc_id", "text_key", "n").agg(
        F.count_if((F.col("at") == -1) & (F.col("length") == lengths[0])).alias("copies"),
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    runs = F.expr(
        """aggregate(hits, cast(array() as array<struct<first: int, length: int>>), (s, h) ->
             if(size(s) > 0 and h.first <= element_at(s, -1).first + element_at(s, -1).length,
                concat(slice(s, 1, size(s) - 1), array(struct(element_at(s, -1).first as first,
                  greatest(element_at(s, -1).length, h.first + h.length - element_at(s, -1).first) as length))),
                concat(s, array(struct(h.first as first, h.length as length)))))"""
    )
    covered = F.expr(
        """aggregate(hits, struct(0 as stop, 0L as total), (s, h) -> struct(greatest(s.stop, h.first + h.length) as stop,
             s.total + greatest(0, h.first + h.length - greatest(s.stop, h.first)) as total), s -> s.total)"""
    )
    per = per.withColumn("n_hit", covered).withColumn("spans", runs).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return per.select("doc_id", "text_key", F.col("n").cast("bigint").alias("n_words"), "n_hit", "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, without the contaminated documents, or without the hit words.

    ``remove="documents"`` drops every contaminated row; ``remove="spans"`` keeps all rows and cuts the
    hit words, with the separators before them, out of their texts.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    found = find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options).where("contaminated")
    hit_id, hit_key, spans = fresh_names(docs, "hit_id", "hit_key", "hit_spans")
    found = found.select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key), F.col("spans").alias(spans)).dropDuplicates([hit_id, hit_key])
    same = docs[id_col].eqNullSafe(found[hit_id]) & (F.xxhash64(docs[text_col]) == found[hit_key])
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    text = docs[text_col].cast("string")
    pieces = F.regexp_extract_all(text, F.lit(f"{_RAW_SEPARATORS}*{_RAW_WORD}"), F.lit(0))
    left = F.filter(pieces, lambda p, i: ~F.exists(found[spans], lambda s: (i >= s["first"]) & (i < s["first"] + s["length"])))
    tail = F.regexp_extract(text, f"{_RAW_SEPARATORS}*$", 0)
    cut = F.when(found[hit_key].isNull(), docs[text_col]).otherwise(F.concat(F.array_join(left, ""), tail))
    return docs.join(found, same, "left").select(*[cut.alias(c) if c == text_col else docs[c] for c in docs.columns])


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of the rows found."""
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


#: DuckDB SQL of the registered query, from the definition
ORACLE = r"""
WITH b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bl AS (SELECT item_id, w, least(len(w), 10) AS l FROM b WHERE len(w) > 0
), bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS win FROM bl, unnest(range(1, len(w) - l + 2)) AS t(i)
), d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), dw AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)
), h AS (SELECT DISTINCT doc_id, i, l, item_id FROM dw JOIN bw USING (l, win)
), p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM h, unnest(range(i, i + l)) AS t(q) GROUP BY doc_id
), it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN it USING (doc_id)
"""
