"""Line deduplication by pairwise alignment of overlapping documents.

A line is deleted if it lies in a block of at least ``min_block_words`` words, consecutive lines
of its document, that an earlier document holds as consecutive lines, anywhere and in any order.

1. Every non-blank line becomes a (document, line number, hash, words) row; one partial
   aggregate per hash keeps the lines held by several documents.
2. A document's shared lines form runs.  Only runs of at least ``min_block_words`` words
   can hold a block to delete, so short repeated lines that stand alone (a licence, a menu)
   lead to nothing, however frequent they are.
3. The least blocks of a run (``min_block_words`` reached, but not without the first or not
   without the last line) cover all blocks it holds.  Each document is paired with the first
   holder of each of its least blocks: never all pairs of the documents that share one.
4. Each pair, the document and the stretch of its holder that has their common blocks, is
   aligned by patience diff (lines unique on both sides, longest increasing subsequence, then the
   gaps between anchors).  Runs of aligned lines of at least ``min_block_words`` words are deleted
   from the later document.  Where shared lines are left (repeated or moved blocks), their least
   blocks are looked up in the other side.

A line deleted somewhere is held by an earlier document, and its first holder never
loses it, so every distinct line stays in at least one document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.bytetext import mix, releasing
from feedlens.llm.storage import fresh_names, only, scratch, stored

#: documents and lines in a broadcast list of lost lines (about 16 bytes each); a longer list is joined by a shuffle
MAX_BROADCAST = 1_000_000

BLANKS = " \t\r\f\x0b"


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: the aligned positions (i, j) of two sequences, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, first, last = todo.pop()
        while lo < hi and first < last and a[lo] == b[first]:
            out.append((lo, first))
            lo, first = lo + 1, first + 1
        while lo < hi and first < last and a[hi - 1] == b[last - 1]:
            hi, last = hi - 1, last - 1
            out.append((hi, last))
        if lo == hi or first == last:
            continue
        once_a, once_b = Counter(a[lo:hi]), Counter(b[first:last])
        place = {x: i for i, x in enumerate(a[lo:hi], lo) if once_a[x] == 1}
        common = [(place[x], j) for j, x in enumerate(b[first:last], first) if once_b[x] == 1 and x in place]
        # longest run increasing in a; ``back`` links each member to the one before it
        tails: list[int] = []
        ends: list[int] = []
        back: list[int] = []
        for k, (i, _) in enumerate(common):
            at = bisect_left(tails, i)
            if at == len(tails):
                tails.append(i)
                ends.append(k)
            else:
                tails[at], ends[at] = i, k
            back.append(ends[at - 1] if at else -1)
        anchors, k = [], ends[-1] if ends else -1
        while k >= 0:
            anchors.append(common[k])
            k = back[k]
        if not anchors:
            continue
        anchors.reverse()
        todo.append((lo, anchors[0][0], first, anchors[0][1]))
        for (i, j), (i2, j2) in zip(anchors, [*anchors[1:], (hi, last)], strict=True):
            out.append((i, j))
            todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def common_blocks(a: list[int], b: list[int], words: list[int], least: int) -> list[tuple[int, int]]:
    """(first, last) positions in ``b`` of blocks of at least ``least`` words that ``a`` holds; together all such lines."""
    blocks, start = [], 0
    pairs = align(a, b)
    for k in range(1, len(pairs) + 1):
        if k == len(pairs) or pairs[k] != (pairs[k - 1][0] + 1, pairs[k - 1][1] + 1):
            first, last = pairs[start][1], pairs[k - 1][1]
            if sum(words[first : last + 1]) >= least:
                blocks.append((first, last))
            start = k
    return blocks + _left_blocks(a, b, words, least, blocks)


def _left_blocks(a: list[int], b: list[int], words: list[int], least: int, blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The least blocks of ``b`` that ``a`` holds and that reach out of ``blocks``."""
    left = np.ones(len(b) + 1, np.int64)
    for first, last in blocks:
        left[first : last + 1] = 0
    left = np.cumsum(left) - left  # lines before each that no block has
    in_a, wanted = set(a), []
    for lo, hi in _runs([x in in_a for x in b]):
        if left[hi] > left[lo]:
            firsts, lasts = least_blocks(words[lo:hi], least)
            wanted += [(lo + i, lo + j) for i, j in zip(firsts.tolist(), lasts.tolist(), strict=True) if left[lo + j + 1] > left[lo + i]]
    if not wanted:
        return []
    size = {x: n for first, last in wanted for x, n in zip(b[first : last + 1], words[first : last + 1], strict=True)}
    held = set()
    for lo, hi in _runs([x in size for x in a]):
        firsts, lasts = least_blocks([size[x] for x in a[lo:hi]], least)
        held.update(tuple(a[lo + i : lo + j + 1]) for i, j in zip(firsts.tolist(), lasts.tolist(), strict=True))
    return [(first, last) for first, last in wanted if tuple(b[first : last + 1]) in held]


def _runs(flags: list[bool]) -> list[tuple[int, int]]:
    """(start, end) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.array(flags, np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def least_blocks(words: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the blocks of ``least`` words that have fewer without their first or without their last line.

    Every line of a run of ``least`` words is in one of them that lies in the run.
    """
    n, least = len(words), max(1, least)
    total = np.concatenate(([0], np.cumsum(np.array(words, np.int64))))
    first, last = np.arange(n), np.searchsorted(total, total[:-1] + least) - 1
    first, last = first[last < n], last[last < n]
    end, start = np.arange(n), np.searchsorted(total, total[1:] - least, side="right") - 1
    end, start = end[start >= 0], start[start >= 0]
    both = np.unique(np.concatenate((first * (n + 1) + last, start * (n + 1) + end)))
    return both // (n + 1), both % (n + 1)


def _block_hashes(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the lines of each block (order matters)."""
    width = last - first + 1
    out, factor = width.astype(np.uint64), np.ones(1, np.uint64)
    for k in range(int(width.max(initial=0))):
        factor = factor * np.uint64(0x9E3779B97F4A7C15)
        at = width > k
        out[at] += mix(h[first[at] + k]) * factor
    return mix(out)


_BLOCKS = "last boolean, id bigint, key bigint, block bigint, at int, to int"
_BLOCKS_ARROW = pa.schema([("last", pa.bool_()), ("id", pa.int64()), ("key", pa.int64()), ("block", pa.int64()), ("at", pa.int32()), ("to", pa.int32())])


def _least(least: int):
    """Of each run of shared lines: its least blocks, each with the lines of one occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for last, id_, key, line, h, words in zip(*(batch[c].to_pylist() for c in ("last", "id", "key", "line", "h", "words")), strict=True):
                first, final = least_blocks(words, least)
                found, one = np.unique(_block_hashes(np.array(h, np.int64).view(np.uint64), first, final), return_index=True)
                n = len(found)
                same = [pa.array([last] * n, pa.bool_()), pa.array([id_] * n, pa.int64()), pa.array([key] * n, pa.int64())]
                place = [pa.array((line + x[one]).astype(np.int32)) for x in (first, final)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(found.view(np.int64)), *place], schema=_BLOCKS_ARROW)

    return run


def _aligned(least: int):
    schema = pa.schema([("key", pa.int64()), ("line", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lines = [], []
            for key, a, b, words in zip(*(batch[c].to_pylist() for c in ("key", "a", "b", "words")), strict=True):
                for first, last in common_blocks(a, b, words, least):
                    keys += [key] * (last - first + 1)
                    lines += range(first, last + 1)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lines, pa.int32())], schema=schema)

    return run


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, age, line, pos, h, words): non-blank lines, numbered among themselves and among all lines."""
    rows = only(docs, doc_id=id_col, text=text_col).select(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("doc_id", "text").alias("key")).alias("age"), F.split(F.col("text").cast("string"), "\n").alias("lines"))
    filled = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.btrim(F.get("lines", i), F.lit(BLANKS)) != "")
    rows = rows.where("lines IS NOT NULL").select("age", "lines", F.posexplode(filled).alias("line", "pos"))
    text = F.btrim(F.get("lines", F.col("pos")), F.lit(BLANKS))
    rows = rows.select("age", "line", "pos", text.alias("t"))
    words = F.length("t") - F.length(F.replace("t", F.lit(" "), F.lit(""))) + 1
    return rows.select("age", "line", "pos", F.xxhash64("t").alias("h"), words.cast("int").alias("words"))


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_block_words: int = 30) -> DataFrame:
    """(key, removed): for each document that loses lines, their positions among all its lines, sorted.

    ``key`` is xxhash64 of the id and the text.  Earlier means a smaller id (null last), then a
    smaller key; rows equal in id and text are one document.  Lines are compared without the
    blanks around them; blank lines take no part; a line's words are its blanks plus one.
    Null and empty texts, and empty tables, have no lines.
    """
    lines = stored(_lines(docs, id_col, text_col), "lines")
    held = lines.groupBy("h").agg(F.min("age").alias("first"), F.max("age").alias("final")).where("first <> final").select("h")
    shared = lines.join(stored(held, "held"), "h", "left_semi").select(F.col("age.key").alias("key"), "age", "line", "h", "words")
    # gaps and islands: runs of lines that several documents hold
    shared = shared.repartition("key").dropDuplicates(["key", "line"])
    run = F.col("line") - F.row_number().over(Window.partitionBy("key").orderBy("line"))
    shared = shared.withColumn("run", run).withColumn("run_words", F.sum("words").over(Window.partitionBy("key", "run"))).where(F.col("run_words") >= min_block_words)
    runs = shared.groupBy("key", "run").agg(F.min("age").alias("age"), F.sort_array(F.collect_list(F.struct("line", "h", "words"))).alias("s"))
    runs = runs.select("age.last", "age.id", "key", F.array_min("s.line").alias("line"), F.col("s.h").alias("h"), F.col("s.words").alias("words"))
    blocks = stored(runs.mapInArrow(releasing(_least(min_block_words)), _BLOCKS), "blocks")
    age = F.struct("last", "id", "key", "at", "to")
    holders = blocks.groupBy("block").agg(F.min(age).alias("first"), F.max(age).alias("final")).where("first.key <> final.key").select("block", F.col("first.key").alias("holder"), "first.at", "first.to")
    # of the holder only the stretch that has the pair's blocks is sent to the other side
    pairs = blocks.select("key", "block").join(stored(holders, "holders"), "block").where("key <> holder").groupBy("key", "holder").agg(F.min("at").alias("at"), F.max("to").alias("to"))
    pairs = stored(pairs, "pairs")
    needed = pairs.select(F.explode(F.array("key", "holder")).alias("key")).distinct()
    whole = lines.select(F.col("age.key").alias("key"), "line", "pos", "h", "words").join(stored(needed, "needed"), "key", "left_semi")
    parts = whole.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("line", "pos", "h", "words"))).alias("s"))
    parts = stored(parts.select("key", F.col("s.h").alias("h"), F.col("s.pos").alias("pos"), F.col("s.words").alias("words")), "sequences")
    stretch = F.slice("a", F.col("at") + 1, F.col("to") - F.col("at") + 1)
    held_by = pairs.join(parts.select(F.col("key").alias("holder"), F.col("h").alias("a")), "holder").select("key", stretch.alias("a"))
    sides = held_by.join(parts.select("key", F.col("h").alias("b"), "words"), "key")
    lost = sides.select("key", "a", "b", "words").mapInArrow(releasing(_aligned(min_block_words)), "key bigint, line int")
    lost = lost.groupBy("key").agg(F.collect_set("line").alias("gone"))
    return lost.join(parts.select("key", "pos"), "key").select("key", F.sort_array(F.transform("gone", lambda i: F.get("pos", i))).alias("removed"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_block_words: int = 30, removed_col: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with the repeated blocks cut out of the texts.

    Texts that lose nothing are returned byte for byte, null texts as null; a text that loses
    all its lines becomes empty.  ``removed_col`` names an extra column with the positions of the lost lines
    (an empty array for none).
    """
    with scratch(docs.sparkSession):
        lost = stored(repeated_lines(docs, id_col=id_col, text_col=text_col, min_block_words=min_block_words), "lost", keep=True)
    size = lost.agg(F.count("*") + F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()[0]
    if size <= MAX_BROADCAST:  # else the texts are shuffled to the lost lines
        lost = F.broadcast(lost)
    lost_key, gone = fresh_names(docs, "lost_key", "gone")
    lost = lost.select(F.col("key").alias(lost_key), F.col("removed").alias(gone))
    joined = docs.join(lost, F.xxhash64(docs[id_col], docs[text_col]) == lost[lost_key], "left")
    kept = F.array_join(F.filter(F.split(docs[text_col].cast("string"), "\n"), lambda x, i: ~F.array_contains(lost[gone], i)), "\n")
    blank = F.btrim(kept, F.lit(BLANKS + "\n")) == ""
    text = F.when(lost[gone].isNull(), docs[text_col]).otherwise(F.when(blank, F.lit("")).otherwise(kept))
    out = [text.alias(c) if c == text_col else docs[c] for c in docs.columns]
    if removed_col:
        out.append(F.coalesce(lost[gone], F.array().cast("array<int>")).alias(removed_col))
    return joined.select(*out)


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_removed (lines), kept_chars, kept_sha256 of the remaining text."""
    out = remove_repeats(only(docs, doc_id="doc_id", text="text"), removed_col="removed")
    return out.select("doc_id", F.size("removed").cast("bigint").alias("n_removed"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: DuckDB SQL of the registered query, from the definition: least blocks of lines that an earlier document holds as well
ORACLE = r"""
WITH split AS (
  SELECT doc_id, "text", string_split("text", chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(range(len(lines))) AS pos, trim(unnest(lines), E' \t\r\f\x0b') AS line FROM split
), line AS (
  SELECT doc_id, pos, line, row_number() OVER w AS nth, sum(length(line) - length(replace(line, ' ', '')) + 1) OVER w AS total
  FROM numbered WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), listed AS (
  SELECT doc_id, list(line ORDER BY nth) AS lines, list(pos ORDER BY nth) AS places, list_prepend(0::HUGEINT, list(total ORDER BY nth)) AS total FROM line GROUP BY doc_id
), bounds AS (
  SELECT doc_id, i, len(list_filter(total, lambda t: t < total[i] + 30)) AS j FROM (SELECT doc_id, total, unnest(range(1, len(lines) + 1)) AS i FROM listed)
  UNION SELECT doc_id, len(list_filter(total, lambda t: t <= total[j + 1] - 30)) AS i, j FROM (SELECT doc_id, total, unnest(range(1, len(lines) + 1)) AS j FROM listed)
), block AS (
  SELECT b.doc_id, i, j, lines[i:j] AS block FROM bounds b JOIN listed USING (doc_id) WHERE i >= 1 AND j <= len(lines)
), lost AS (
  SELECT DISTINCT doc_id, unnest(places[i:j]) AS pos
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY block) AS first_id FROM block) JOIN listed USING (doc_id) WHERE first_id < doc_id
), gone AS (
  SELECT doc_id, list(pos) AS gone FROM lost GROUP BY doc_id
), kept AS (
  SELECT doc_id, coalesce(len(gone), 0) AS n_removed, CASE WHEN gone IS NULL THEN coalesce("text", '')
    ELSE array_to_string(list_transform(list_filter(range(len(lines)), lambda k: NOT list_contains(gone, k)), lambda k: lines[k + 1]), chr(10)) END AS kept
  FROM split LEFT JOIN gone USING (doc_id)
), result AS (
  SELECT doc_id, n_removed, CASE WHEN n_removed > 0 AND trim(kept, E' \t\r\f\x0b\n') = '' THEN '' ELSE kept END AS kept FROM kept
)
SELECT doc_id, CAST(n_removed AS BIGINT) AS n_removed, CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256 FROM result
"""
