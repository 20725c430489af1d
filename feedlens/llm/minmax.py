"""Near duplicates by min-max hashing.

A document's set is its distinct word shingles; documents with equal sets form one class (its
key is a 64-bit hash of the set), so copies meet once whatever their number.

1. One pass over the texts (NumPy over Arrow bytes) evaluates ``permutations`` hash permutations
   on each shingle and retains both the minimum and the maximum under each: two signature values
   an evaluation, each an unbiased estimate of the similarity, their mean of lower variance than
   as many minima.  ``rows`` minima (and likewise maxima) of different permutations make a band.
   With 48 permutations and 4 rows, 24 bands: a pair at 0.85 meets in none of them with
   probability 2e-8, at 0.9 with 8e-12.
2. Bands of one class alone cannot give a candidate; what is left is the index.  Classes of one
   band's bucket are candidates.  In place of all pairs of a bucket, each round compares its
   members with one pivot (linear in the bucket; the most connected member, which is nearest to
   all others) and merges what links; members of one component need no comparison.  What is left
   between different components of a bucket is compared at the end, so no candidate is dropped.
3. A pair passes the length filter and the parity sketches before its sets are met: bit i of a
   sketch is the parity of the shingles that hash to i, so the sketches of two sets differ in at
   most as many bits as the sets differ in shingles, and a pair they exclude cannot link.
4. Every pair left is confirmed once on its full sets.

Shingles are compared by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.bytetext import mix, shingle_sets, text_blocks
from feedlens.llm.components import components
from feedlens.llm.sketches import apart, parity_sketches
from feedlens.llm.storage import only, scratch, stored, stored_rows

#: rounds of pivots before what is left is compared
ROUNDS = 2

_ROWS = "doc_id bigint, ref bigint, key bigint, n int, bands array<bigint>, sketch array<bigint>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("ref", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])


def permuted(permutations: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, odd multipliers): x -> (x xor offset) * multiplier permutes the 64-bit numbers."""
    r = np.random.default_rng(seed)
    return r.integers(0, 2**64, permutations, np.uint64), r.integers(0, 2**63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)


def min_max(h: np.ndarray, starts: np.ndarray, permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """(minima, maxima), one row per permutation, one column per set; the sets are the runs of ``h`` from ``starts``."""
    low, high = np.empty((permutations, len(starts)), np.uint64), np.empty((permutations, len(starts)), np.uint64)
    for i, (offset, factor) in enumerate(zip(*permuted(permutations), strict=True)):
        value = (h ^ offset) * factor
        low[i], high[i] = np.minimum.reduceat(value, starts), np.maximum.reduceat(value, starts)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """One row per set: the hash of each band of ``rows`` minima, then of each band of maxima."""
    factors = permuted(rows, 13)[1][:, None]
    bands = [x[i : i + rows] for x in (low, high) for i in range(0, len(low), rows)]
    return np.stack([mix((mix(b) * factors).sum(axis=0) + np.uint64(k)) for k, b in enumerate(bands)], axis=1)


def _lists(values: np.ndarray, lengths: np.ndarray, present: np.ndarray) -> pa.Array:
    """Lists of the present rows, null for the others."""
    ends = np.cumsum(np.where(present, lengths, 0))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values.view(np.int64)), mask=pa.array(~present))


def _signed(width: int, permutations: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(2)):
                doc, h, sizes = shingle_sets(data, offsets, width)
                some = np.flatnonzero(sizes)
                keys = np.zeros(len(sizes), np.uint64)  # 0 is kept for the empty set
                if len(some):
                    starts = (np.cumsum(sizes) - sizes)[some]
                    keys[some] = mix(np.add.reduceat(mix(h ^ np.uint64(0x9E3779B97F4A7C15)), starts) + sizes[some].astype(np.uint64))
                # a task gives each class's bands once
                new = np.zeros(len(sizes), dtype=bool)
                for d in some.tolist():
                    k = int(keys[d])
                    if k not in seen:
                        seen.add(k)
                        new[d] = True
                h, lengths = h[new[doc]], sizes[new]
                starts = np.cumsum(lengths) - lengths
                if len(h):
                    bands, sketch = band_keys(*min_max(h, starts, permutations), rows), parity_sketches(h, starts)
                else:
                    bands, sketch = np.zeros((0, 1), np.uint64), np.zeros((0, 1), np.uint64)
                m = len(sizes)
                columns = [
                    batch.column(0).slice(first, m),
                    batch.column(1).slice(first, m),
                    pa.array(keys.view(np.int64)),
                    pa.array(sizes.astype(np.int32)),
                    _lists(bands.ravel(), np.full(m, bands.shape[1]), new),
                    _lists(sketch.ravel(), np.full(m, sketch.shape[1]), new),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return run


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, permutations: int = 48, rows: int = 4) -> DataFrame:
    """(doc_id, ref, key, n, bands, sketch) per row; ``ref`` is xxhash64 of the text, ``key`` its class (0: no shingles).

    bands and sketch are null where the same task has already given them for the class.
    """
    if permutations % rows:
        raise ValueError("signatures: permutations must be a multiple of rows")
    texts = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("ref"), F.col("text").cast("string"))
    return texts.mapInArrow(_signed(width, permutations, rows), _ROWS)


def _full_sets(width: int):
    schema = pa.schema([("key", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(1)):
                _, h, sizes = shingle_sets(data, offsets, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sizes)), _lists(h, sizes, np.ones(len(sizes), dtype=bool))], schema=schema)

    return run


def _may_link(num: int, den: int) -> Column:
    """Length filter and sketches of two classes (n, sketch and n_2, sketch_2)."""
    most = F.col("n") + F.col("n_2") - 2 * F.ceil(num * (F.col("n") + F.col("n_2")) / F.lit(num + den))
    return (den * F.least("n", "n_2") >= num * F.greatest("n", "n_2")) & (apart("sketch", "sketch_2") <= most)


def _other(members: DataFrame) -> DataFrame:
    return members.select(*[F.col(c).alias(f"{c}_2") for c in members.columns])


def _met(members: DataFrame, others: DataFrame, *also: Column) -> DataFrame:
    """Distinct (a, b) of members and others (columns with _2) of one bucket and of different components."""
    same = (F.col("token") == F.col("token_2")) & (F.col("comp") != F.col("comp_2"))
    for condition in also:
        same = same & condition
    return members.join(others, same).select(F.least("key", "key_2").alias("a"), F.greatest("key", "key_2").alias("b")).distinct()


def _filtered(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    side = classes.select("key", "n", "sketch")
    return pairs.join(side.withColumnRenamed("key", "a"), "a").join(_other(side).withColumnRenamed("key_2", "b"), "b").where(_may_link(num, den)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets link."""
    side = lambda s: sets.select(F.col("key").alias(s), F.col("shingles").alias(f"set_{s}"))
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    both = (F.size("set_a") + F.size("set_b")).cast("long")
    return pairs.join(side("a"), "a").join(side("b"), "b").where(common * (num + den) >= num * both).select("a", "b")


def link_classes(index: DataFrame, classes: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of the classes that link: ``index`` (token, key), ``classes`` (key, n, sketch, score), ``sets`` (key, shingles)."""
    now = index.join(classes.select("key", "score"), "key").withColumn("comp", F.col("key"))
    links = None
    for r in range(ROUNDS + 1):
        if links is not None:  # buckets of one component are done
            labels = components(links).withColumnRenamed("node", "key")
            now = now.drop("comp").join(labels, "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component")
        now = stored(now, "members")
        # of each bucket with several components the largest one; the members outside it are left to compare
        sizes = now.groupBy("token", "comp").agg(F.count("*").alias("c")).groupBy("token").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps"))
        mains, left = stored_rows(sizes.where("comps > 1").select("token", F.col("m.comp").alias("main")), "mains")
        if not left:
            break
        now = stored(now.join(mains, "token"), "open")
        outside = now.where("comp <> main")
        if r < ROUNDS:  # at first the pivot of all, then of those outside
            pivot = (now if r == 0 else outside).groupBy("token").agg(F.min(F.struct((-F.col("score")).alias("minus"), "key", "comp")).alias("p"))
            pivot = stored(pivot.select(F.col("token").alias("token_2"), F.col("p.key").alias("key_2"), F.col("p.comp").alias("comp_2")), "pivots")
            pairs = _filtered(stored(_met(now, pivot), "met"), classes, num, den)
        else:
            full = classes.select("key", "n", "sketch")
            pairs = _met(now.join(full, "key"), _other(outside.select("token", "key", "comp").join(full, "key")), _may_link(num, den))
        now = now.drop("main")
        found = stored(_confirmed(stored(pairs, "pairs"), sets, num, den), "links")
        links = found if links is None else links.unionByName(found)
    return components(links if links is not None else index.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (85, 100), permutations: int = 48, rows: int = 4) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Words are runs of anything but ASCII white space, after lower-casing A-Z; a set holds the
    distinct ``width``-word shingles, or the whole sequence of a shorter text.  Documents link
    when intersection / union >= threshold; component_id is the smallest doc_id reachable by
    links; ``kept`` marks the rows whose id it is.

    Null, empty and blank texts have 0 shingles, link with nothing and are their own component.
    Rows that repeat a doc_id are separate documents with one row each; a null doc_id takes part
    and is never the smallest id (rows of a component of null ids only have a null id and are
    all kept).  Other columns play no part.  An empty table gives no rows.
    """
    num, den = threshold
    spark = docs.sparkSession
    with scratch(spark):
        signed = stored(signatures(docs, id_col=id_col, text_col=text_col, width=width, permutations=permutations, rows=rows), "signatures")
        once = signed.where("bands IS NOT NULL")
        banded = once.select("key", F.explode("bands").alias("token"))
        shared = banded.groupBy("token").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").select("token")
        index = stored(banded.join(shared.hint("merge"), "token").distinct(), "index")
        weight = index.groupBy("token").agg(F.count("*").alias("g"))
        scores = index.join(weight, "token").groupBy("key").agg(F.sum("g").alias("score"))
        first = F.min(F.struct("ref", "doc_id", "n", "sketch")).alias("f")
        classes = stored(once.join(scores, "key").groupBy("key").agg(first, F.max("score").alias("score")).select("key", "f.*", "score"), "classes")
        # full sets of the classes that meet another: the text of one document each is read again
        texts = only(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint"), F.xxhash64("text").alias("h"), F.col("text").cast("string"))
        same = (F.col("h") == F.col("ref")) & F.col("id").eqNullSafe(F.col("doc_id"))
        read = texts.join(classes.select("key", "ref", "doc_id").hint("merge"), same).select("key", "text").mapInArrow(_full_sets(width), "key bigint, shingles array<bigint>")
        sets = stored(read.dropDuplicates(["key"]), "sets")
        linked = stored(link_classes(index, classes, sets, num, den), "linked")

        least = signed.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
        grouped = stored(least.join(linked.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("component", "key").alias("component")), "grouped")
        ids = grouped.groupBy("component").agg(F.min("least").alias("id"))
        named = grouped.join(ids, "component").select("key", "id")
        component = F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("doc_id"))
        found = signed.select("doc_id", "key", "n").join(named, "key", "left").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"))
        return stored(found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near", keep=True)


#: DuckDB SQL of the registered query, from the definition (for small tables: it compares all pairs that share a shingle)
ORACLE = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, words[i:i + 4] AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM word WHERE words <> [])
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN link ON other = a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""
