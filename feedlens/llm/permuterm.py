"""Spelling variants by permuterm rotations.

A word w is marked with a terminator and all rotations of the marked word are sorted.  For every
split w = x + c + y the rotation that starts behind c reads y $ x c: its last character is the one
edited, all before it, y $ x, is the range's prefix.  So words that share a prefix differ by one
replaced character, and the word x + y, whose rotation is that prefix as a whole, differs from each
of them by the deleted c.  Insertions are the same pairs seen from the other side.

Spark sorts the rotations by prefix (one shuffle by prefix, sorted with the most frequent words
first) and scans each group once.  A group has one member for a character at most and one word
without it, so its size is bounded by the alphabet, not by the corpus.  Every member emits one row:
how many neighbours it has there and the best of them; no pairs are made.  A replaced pair has one
split; a deleted character in a run of equal ones has several, of which the run's first counts.

Forms are followed to the root by pointer jumping; n at least doubles at each step, so a chain has
at most about log2 of the largest n words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedlens.llm.storage import only, scratch, stored

#: maximal runs of Latin letters
RUN = "[A-Za-z\\u00C0-\\u00FF]++"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: the terminator: a character no word has, before all letters
END = "$"


def damaged(run: Column, doc_id: Column, every: int) -> Column:
    """``run`` without one code point if crc32 of '<doc_id>:<run>' is a multiple of ``every`` (a null id is written as nothing)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """(word, n): the words of all whole texts with at least ``least_length`` code points and ``least_count`` occurrences."""
    rows = only(docs, doc_id=id_col, text=text_col).where(F.length(F.col("text")) >= least_length)
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))
    words = rows.select("doc_id", F.explode(F.filter(runs, lambda r: F.char_length(r) >= least_length)).alias("run"))
    words = words.select(damaged(F.translate("run", _UPPER, _LOWER), F.col("doc_id"), every).alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, whole, counted, word, n): each rotation of the marked words, once as a whole and once without its last character.

    ``whole``: the prefix is the word's whole rotation, nothing is skipped.  ``counted``: the split
    that stands for the deletion of the skipped character (the first of its run of equal ones).
    """
    length = F.char_length("word")
    split = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("at"))
    x, y = F.substring("word", F.lit(1), F.col("at")), F.substring("word", F.col("at") + 1, length)
    whole = split.select(F.concat(y, F.lit(END), x).alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("counted"), "word", "n")
    c, before = F.substring("word", F.col("at"), F.lit(1)), F.substring("word", F.col("at") - 1, F.lit(1))
    gap = split.where("at > 0").select(
        F.concat(y, F.lit(END), F.substring("word", F.lit(1), F.col("at") - 1)).alias("prefix"),
        F.lit(False).alias("whole"),
        ((F.col("at") == 1) | (c != before)).alias("counted"),
        "word",
        "n",
    )
    return whole.unionByName(gap)


def scan_groups(turned: DataFrame) -> DataFrame:
    """(word, n, n_near, best): per word and group of equal prefix its neighbours there and the best one, (-n, word)."""
    ordered = Window.partitionBy("prefix").orderBy(F.desc("n"), "word", "whole").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    this = F.struct((-F.col("n")).alias("minus"), F.col("word").alias("form"))
    gap, counted, whole = F.when(~F.col("whole"), this), F.when(F.col("counted"), this), F.when(F.col("whole"), this)
    seen = turned.select(
        "*",
        F.count(gap).over(ordered).alias("gaps"),
        F.count(counted).over(ordered).alias("counts"),
        F.nth_value(gap, 1, ignoreNulls=True).over(ordered).alias("gap_1"),
        F.nth_value(gap, 2, ignoreNulls=True).over(ordered).alias("gap_2"),
        F.nth_value(counted, 1, ignoreNulls=True).over(ordered).alias("counted_1"),
        F.nth_value(whole, 1, ignoreNulls=True).over(ordered).alias("whole_1"),
    )
    other = F.when(F.col("gap_1.form") != F.col("word"), F.col("gap_1")).otherwise(F.col("gap_2"))
    short = F.when(F.col("counted"), F.col("whole_1"))
    near = F.when(F.col("whole"), F.col("counts")).otherwise(F.col("gaps") - 1 + short.isNotNull().cast("int"))
    best = F.when(F.col("whole"), F.col("counted_1")).otherwise(F.least(other, short))
    return seen.select("word", "n", near.alias("n_near"), best.alias("best")).where("n_near > 0")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms followed to the last, by pointer jumping."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        moved = Observation()
        step = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        jumped = at.join(step, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moves"))
        at = stored(jumped.observe(moved, F.count_if("moves").alias("n")).drop("moves"), "roots", keep=True)
        if not moved.get["n"]:
            return at


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, ratio: int = 2, every: int = 97) -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n).

    Words are the maximal runs of Latin letters of whole texts, A-Z lower-cased, with the
    stated damage, of at least ``least_length`` code points and ``least_count`` occurrences.
    Near words differ by exactly one inserted, deleted or replaced code point.  ``form``: the
    near word of largest n (ties: the smallest in code-point order) if its n is at least
    ``ratio`` times the word's, else null; ``root``: forms followed to the last, the word
    itself if it has none.

    Null and empty texts have no words; a null id is written as nothing before the colon.
    Rows that repeat count each.  Other columns play no part.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("spelling_variants: ratio must be at least 2, so that forms cannot turn in a circle")
    with scratch(docs.sparkSession):
        words = stored(word_counts(docs, id_col=id_col, text_col=text_col, least_length=least_length, least_count=least_count, every=every), "words")
        emitted = scan_groups(rotations(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
        found = words.join(emitted, "word", "left")
        taken = -F.col("best.minus") >= ratio * F.col("n")
        found = found.select("word", F.when(taken, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(taken, -F.col("best.minus")).alias("form_n"))
        found = stored(found, "variants")
        with scratch(docs.sparkSession):
            roots = _roots(found.where("form IS NOT NULL"))
        return stored(found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "grouped", keep=True)


#: DuckDB SQL of the registered query: CRC-32 from its definition, near words by words with one place blanked or taken out
ORACLE = r"""
WITH byte AS (
  SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)::BIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256))::BIGINT AS b))
), run AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all("text", '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents) WHERE length(r) >= 5 GROUP BY ALL
), coded AS (
  SELECT doc_id, run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM run
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
    lambda c, b: xor(crc[xor(c, b) % 256 + 1], c // 256))) AS h
  FROM coded, byte
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, word[:i - 1] || '_' || word[i + 1:] AS blank, word[:i - 1] || word[i + 1:] AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.blank = b.blank AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({'minus': -n, 'other': other}) AS best FROM near GROUP BY word
), form AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.minus >= 2 * n THEN best.other END AS form, CASE WHEN -best.minus >= 2 * n THEN -best.minus END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  WITH RECURSIVE r AS (SELECT word, word AS root FROM words UNION ALL SELECT r.word, f.form FROM r JOIN form f ON r.root = f.word WHERE f.form IS NOT NULL)
  SELECT r.word, r.root FROM r JOIN form f ON r.root = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM form JOIN walk USING (word)
"""
