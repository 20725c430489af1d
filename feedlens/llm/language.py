"""Language identification by Bayesian fusion of evidence.

Text: byte-trigram likelihoods of each language, learned from a bounded sample of each
declared language, and of a uniform background (``und``) for what is no language at all.  As
neighbouring trigrams are not independent, a text counts as at most ``max_trigrams`` of them.

Declared language (markup), address suffix and host are evidence whose worth is measured on
the corpus: grouped aggregation sums the texts' posterior shares per declared value, per
suffix, per domain and per host.  Declared values and suffixes enter as P(value | language); the
host enters as prior, smoothed towards its domain, that towards all documents, and without the
document's own share.  Texts are read once; everything else works on narrow rows.

Shares travel as sparse lists (language, share), so plans, rows and sums do not widen with the
number of languages; a share under ``LEAST_SHARE`` is none.  A declared language is a well-formed
tag's primary subtag; whatever else is declared says nothing.  Every declared language is learned,
however few its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.llm.bytetext import releasing, text_blocks
from feedlens.llm.storage import stored, text_batches

UNKNOWN = "und"
#: distinct texts that a language's sample may have at least
LEAST_SAMPLE = 100
#: smaller posterior shares of a text count as none
LEAST_SHARE = 1e-9
#: letters and blank as small codes; every other ASCII byte is a blank
_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)
_BASE = 155


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, code) of the trigrams that lie in one text and hold at most one blank."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = _CODE[data]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    blank = (c == 0).astype(np.int8)
    keep = (doc[:-2] == doc[2:]) & (blank[:-2] + blank[1:-1] + blank[2:] <= 1)
    return doc[:-2][keep], ((c[:-2] * _BASE + c[1:-1]) * _BASE + c[2:])[keep]


def declared_language(tag: Column) -> Column:
    """The primary subtag of a well-formed language tag, lower case; null for anything else and for ``und``."""
    found = F.regexp_extract(F.lower(F.btrim(tag.cast("string"))), r"^([a-z]{2,8})([-_][a-z0-9]{1,8})*$", 1)
    return F.when((found != "") & (found != UNKNOWN), found)


def _count(languages: list[str]):
    schema = pa.schema([("language", pa.int32()), ("gram", pa.int32()), ("n", pa.int64())])
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, data, offsets in text_blocks(batch.column(1)):
                doc, gram = _trigrams(data, offsets)
                both, n = np.unique(own[first + doc] * _BASE**3 + gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((both // _BASE**3).astype(np.int32)), pa.array((both % _BASE**3).astype(np.int32)), pa.array(n)], schema=schema)

    return run


class TextModel:
    """Smoothed log likelihoods of trigrams per language, by what a trigram adds to an unseen one."""

    def __init__(self, languages: list[str], counts: pa.Table, smoothing: float = 0.1) -> None:
        self.languages = languages
        gram, language, n = (counts[c].to_numpy() for c in ("gram", "language", "n"))
        order = np.lexsort((language, gram))
        gram, self.language, n = gram[order], language[order].astype(np.int64), n[order]
        self.grams, self.start = np.unique(gram, return_index=True)
        self.size = np.diff(np.concatenate((self.start, [len(gram)])))
        total = np.bincount(self.language, weights=n, minlength=len(languages)) + smoothing * (len(self.grams) + 1)
        self.unseen = np.log(smoothing / total)
        self.adds = np.log((n + smoothing) / total[self.language]) - self.unseen[self.language]
        # the background spreads itself over all letter pairs with a blank or letter: 27 ASCII codes at least
        self.background = -np.log(max(len(self.grams) + 1, 27.0**3))

    def index(self) -> np.ndarray:
        """Per code of a trigram its place among the grams, or one behind the last."""
        out = np.full(_BASE**3, len(self.grams), np.int32)
        out[self.grams] = np.arange(len(self.grams))
        return out

    def sums(self, data: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of trigrams, log likelihood per language, the background last) of each text."""
        n_docs, m = len(offsets) - 1, len(self.languages)
        doc, gram = _trigrams(data, offsets)
        n = np.bincount(doc, minlength=n_docs)
        at = index[gram]
        seen = at < len(self.grams)
        at, doc = at[seen], doc[seen]
        size = self.size[at]
        ends = np.cumsum(size)
        entry = np.repeat(self.start[at] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        out = np.empty((n_docs, m + 1))
        out[:, :m] = np.bincount(np.repeat(doc, size) * m + self.language[entry], weights=self.adds[entry], minlength=n_docs * m).reshape(n_docs, m)
        out[:, :m] += n[:, None] * self.unseen
        out[:, m] = n * self.background
        return n, out


def learn_text_model(labelled: DataFrame, *, text_col: str = "text", language_col: str = "lang", sample_rows: int = 8000) -> TextModel:
    """Trigram model from distinct texts with a declared language: of each language those of smallest hash.

    Every language that a text declares is learned.  Each has a sample of its own, of ``sample_rows``
    divided by the languages, but ``LEAST_SAMPLE`` texts at least, if it has them.
    """
    rows = labelled.select(declared_language(F.col(f"`{language_col}`")).alias("language"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text <> '' AND language IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    sizes = {r["language"]: r["texts"] for r in rows.groupBy("language").agg(F.approx_count_distinct("h").alias("texts")).collect()}  # one row per language
    languages = sorted(sizes)
    each = max(LEAST_SAMPLE, sample_rows // max(1, len(languages)))

    def under(frame: DataFrame, cuts: dict[str, int]) -> DataFrame:
        cut = labelled.sparkSession.createDataFrame(list(cuts.items()), "language string, cut bigint")
        return frame.join(F.broadcast(cut), "language").where("h <= cut").drop("cut")

    # about twice the texts wanted, from the numbers of texts; then exactly those of smallest hash
    near = under(rows, {x: min((1 << 63) - 1, (2 * each << 64) // max(1, n) - (1 << 63)) for x, n in sizes.items()})
    near = stored(near.groupBy("language", "h").agg(F.min("text").alias("text")), "near")
    ranked: dict[str, list[int]] = {}
    held = near.select("language", "h").toArrow()  # bounded by the samples
    for x, h in zip(held["language"].to_pylist(), held["h"].to_pylist(), strict=True):
        ranked.setdefault(x, []).append(h)
    sample = under(near, {x: sorted(h)[:each][-1] for x, h in ranked.items()})
    counted = sample.select("language", "text").mapInArrow(releasing(_count(languages)), "language int, gram int, n bigint") if languages else None
    empty = pa.table({"language": pa.array([], pa.int32()), "gram": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    counts = counted.groupBy("language", "gram").agg(F.sum("n").alias("n")).toArrow() if languages else empty  # bounded by the sample
    return TextModel(languages, counts)


def _sparse(shares: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Lists of the languages with a share, and of the shares, of each row."""
    row, language = np.nonzero(shares)
    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(shares))))), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(language.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(shares[row, language]))


def _dense(languages: pa.Array, shares: pa.Array, m: int) -> np.ndarray:
    """The rows of two list columns as a matrix; null lists are zeros."""
    out = np.zeros((len(languages), m))
    size = pc.list_value_length(languages).fill_null(0).to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(out)), size), languages.flatten().to_numpy(zero_copy_only=False)] = shares.flatten().to_numpy(zero_copy_only=False)
    return out


def text_shares(n: np.ndarray, ll: np.ndarray, max_trigrams: int, background_prior: float) -> np.ndarray:
    """Posterior of each language, the background last, from a text's own trigrams; all alike for a text without."""
    m = ll.shape[1] - 1
    temper = np.minimum(1.0, max_trigrams / np.maximum(n, 1))
    prior = np.append(np.full(m, (1 - background_prior) / max(1, m)), background_prior)
    w = np.where(n[:, None] > 0, np.exp((ll - ll.max(axis=1, keepdims=True)) * temper[:, None]) * prior, 1.0)
    return w / w.sum(axis=1, keepdims=True)


def _read_texts(model: TextModel, fields: list[pa.Field], max_trigrams: int, background_prior: float):
    lists = [("n_trigrams", pa.int64()), ("languages", pa.list_(pa.int32())), ("shares", pa.list_(pa.float64())), ("background", pa.float64())]
    schema = pa.schema([*fields, *[pa.field(*x) for x in lists]])
    m = len(model.languages)
    block_bytes = max(1 << 15, (1 << 20) // max(4, m))  # a block's matrix and entries widen with the languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = model.index()
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(len(fields)), block_bytes):
                n, ll = model.sums(data, offsets, index)
                t = text_shares(n, ll, max_trigrams, background_prior)
                shares = np.where((n[:, None] > 0) & (t[:, :m] >= LEAST_SHARE), t[:, :m], 0.0)
                own = [c.slice(first, len(n)) for c in batch.columns[: len(fields)]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n.astype(np.int64)), *_sparse(shares), pa.array(t[:, m])], schema=schema)

    return run


def fuse(
    shares: np.ndarray,
    background: np.ndarray,
    letters: np.ndarray,
    everywhere: np.ndarray,
    priors: list[tuple[np.ndarray, np.ndarray]],
    evidence: list[np.ndarray],
    smoothing: float,
) -> tuple[np.ndarray, np.ndarray]:
    """(place of the best language, its posterior) of each row.

    ``priors``: per level, from the widest, (summed shares of the row's value, whether it is known);
    ``evidence``: log likelihoods to add.
    """
    own = np.where(letters[:, None], shares, 0.0)
    p = np.broadcast_to(everywhere, shares.shape)
    for summed, known in priors:
        others = np.where(known[:, None], summed - own, 0.0)
        p = (np.maximum(others, 0.0) + smoothing * p) / (np.maximum(others.sum(axis=1), 0.0) + smoothing)[:, None]
    logs = np.log(np.maximum(shares, 1e-300)) + np.log(p) + sum(evidence)
    best = logs.argmax(axis=1)
    mass = np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    return best, (1 - background) / mass


def _fused(model: TextModel, fields: list[pa.Field], everywhere: np.ndarray, totals: np.ndarray, kinds: dict[str, int], levels: list[str], smoothing: float, min_confidence: float):
    names = list(model.languages)
    m = len(names)
    added = [("text_key", pa.int64()), ("n_trigrams", pa.int64()), ("language", pa.string()), ("confidence", pa.float64()), ("text_language", pa.string()), ("kept", pa.bool_())]
    schema = pa.schema([*fields, *[pa.field(*x) for x in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.array(names, object)
        rows = max(1, (1 << 20) // m)
        for whole in batches:
            for first in range(0, whole.num_rows, rows):
                batch = whole.slice(first, rows)
                n, background = batch["n_trigrams"].to_numpy(), batch["background"].to_numpy()
                letters = n > 0
                t = np.where(letters[:, None], _dense(batch["languages"], batch["shares"], m), 1.0 / (m + 1))
                summed = {v: (_dense(batch[f"{v}_languages"], batch[f"{v}_shares"], m), batch[f"{v}_languages"].is_valid().to_numpy(zero_copy_only=False)) for v in [*levels, *kinds]}
                evidence = [np.where(summed[v][1][:, None], np.log((summed[v][0] + 1.0 / k) / (totals + 1.0)), 0.0) for v, k in kinds.items()]
                best, confidence = fuse(t, background, letters, everywhere, [summed[v] for v in levels], evidence, smoothing)
                sure = (background < 0.5) & (confidence >= min_confidence)
                declared = np.array(batch["declared"].to_pylist(), object)
                unlearned = np.array([x is not None and x not in names for x in declared], dtype=bool)
                language = np.where(letters & unlearned & ~sure, declared, place[best])
                text = np.where(letters & (background < t.max(axis=1)), place[t.argmax(axis=1)], UNKNOWN)
                own = [batch[f.name] for f in fields]
                out = [batch["text_key"], batch["n_trigrams"], pa.array(language, pa.string()), pa.array(confidence), pa.array(text, pa.string()), pa.array(letters & (sure | unlearned))]
                yield pa.RecordBatch.from_arrays([*own, *out], schema=schema)

    return run


def markup_language(html: Column) -> Column:
    """The primary subtag of the language an HTML page declares for itself, or null."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-zA-Z]{2,8})", 1)
    return F.when(found != "", F.lower(found))


def address_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of an address, lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(host != "", host)
    return host, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.regexp_extract(host, r"([^.]+)$", 1)


def identify(
    docs: DataFrame,
    model: TextModel,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: Column,
    declared: Column | None = None,
    suffix: Column | None = None,
    domain: Column | None = None,
    host: Column | None = None,
    max_trigrams: int = 60,
    smoothing: float = 5.0,
    background_prior: float = 1e-3,
    min_confidence: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, text_key, n_trigrams, language, confidence, text_language, kept.

    ``language`` has the largest posterior (ties: the first by name), ``confidence`` is that posterior,
    ``text_language`` goes by the text alone.  A document is rejected (kept = false) if it has no
    trigram of letters (null, empty, digits only), if the background explains it best, or if the
    confidence is under ``min_confidence``.  The last two never reject a document whose declared
    language is not in the model (none of its texts was there to learn from): it keeps the declared
    one.  Absent, null or ill-formed evidence says nothing; a null or unseen host has its domain's,
    else the global prior.  Repeated rows are judged each, and each counts for its host.  A model
    without languages rejects everything; an empty table gives no rows.  ``keep`` may name any column
    but those added here.
    """
    added = {"text_key", "n_trigrams", "language", "confidence", "text_language", "kept"}
    if added & {c.lower() for c in keep}:
        raise ValueError(f"identify: the columns {sorted(added)} are added, keep cannot hold them")
    none = F.lit(None).cast("string")
    trimmed = lambda c: F.lower(F.btrim((none if c is None else c).cast("string")))
    evidence = {"declared": declared, "suffix": suffix, "domain": domain, "host": host}
    values = [declared_language(none if c is None else c) if k == "declared" else trimmed(c) for k, c in evidence.items()]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("keep"), F.xxhash64(text).alias("text_key"), *[v.alias(k) for v, k in zip(values, evidence, strict=True)], text.cast("string").alias("text"))
    narrow = rows.drop("text").schema
    fields = [pa.field(f.name, f.type) for f in to_arrow_schema(narrow)]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow)
    read = rows.mapInArrow(releasing(_read_texts(model, fields, max_trigrams, background_prior)), ddl + ", n_trigrams bigint, languages array<int>, shares array<double>, background double")
    with text_batches(docs.sparkSession):
        read = stored(read, "likelihoods")
    if not model.languages:
        unknown = [F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("confidence"), F.lit(UNKNOWN).alias("text_language"), F.lit(False).alias("kept")]
        return read.select("keep.*", "text_key", "n_trigrams", *unknown)

    m = len(model.languages)
    letters = read.where("n_trigrams > 0")
    each = letters.select(*evidence, F.explode(F.arrays_zip("languages", "shares")).alias("s")).select(*evidence, F.col("s.languages").alias("of"), F.col("s.shares").alias("share"))
    totals = np.zeros(m)
    for r in each.groupBy("of").agg(F.sum("share").alias("n")).collect():  # one row per language
        totals[r["of"]] = r["n"]
    everywhere = (totals + smoothing / m) / (totals.sum() + smoothing)
    counted = letters.agg(*[F.approx_count_distinct(k).alias(k) for k in ("declared", "suffix")]).first()
    kinds = {k: int(counted[k]) + 1 for k in ("declared", "suffix") if evidence[k] is not None}
    levels = [k for k in ("domain", "host") if evidence[k] is not None]
    scored = read
    for value in [*levels, *kinds]:
        # summed shares of each value (partial aggregates, so a hot value is few rows per task)
        sums = each.where(F.col(value).isNotNull()).groupBy(value, "of").agg(F.sum("share").alias("n"))
        lists = sums.groupBy(value).agg(F.sort_array(F.collect_list(F.struct("of", "n"))).alias("s"))  # one entry per language at most
        table = stored(lists.select(F.col(value).alias("value"), F.col("s.of").alias(f"{value}_languages"), F.col("s.n").alias(f"{value}_shares")), value)
        spread = F.coalesce(F.col(value), F.concat(F.lit("\x00"), F.pmod("text_key", F.lit(4096)).cast("string")))  # nulls match nothing, in no one task
        scored = scored.withColumn("at", spread).join(table, F.col("at") == F.col("value"), "left").drop("at", "value")
    out = scored.drop("suffix", "domain", "host").mapInArrow(
        releasing(_fused(model, fields[:1], everywhere, totals, kinds, levels, smoothing, min_confidence)),
        f"keep {narrow['keep'].dataType.simpleString()}, text_key bigint, n_trigrams bigint, language string, confidence double, text_language string, kept boolean",
    )
    return out.select("keep.*", "text_key", "n_trigrams", "language", "confidence", "text_language", "kept")


def identify_documents(docs: DataFrame, **options) -> DataFrame:
    """The languages of a ``documents`` table: ``lang`` is the declared language, ``source`` the host.

    One row per row, by the rules of ``identify``.  Other columns play no part.
    """
    model = learn_text_model(docs)
    return identify(docs, model, text=F.col("text"), declared=F.col("lang"), host=F.col("source"), **options)


def identify_pages(pages: DataFrame, **options) -> DataFrame:
    """The languages of a ``pages`` table, by body text, ``<html lang>``, address suffix, domain and host.

    One row per row, by the rules of ``identify``.  The text is the page without scripts, styles, comments,
    tags and entities; a null or empty page has none and is rejected.  A page that declares no
    language, or no well-formed one, and a null, empty or hostless address are no evidence.
    Rows that repeat count each; a null page_id is kept as null.  Other columns play no part.
    An empty table gives no rows.
    """
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"(?s)<[^>]*>|&[a-zA-Z#0-9]+;", " ")
    host, domain, suffix = address_parts(F.col("url"))
    rows = pages.select(F.col("page_id"), body.alias("text"), markup_language(F.col("html")).alias("lang"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix"))
    model = learn_text_model(rows)
    return identify(rows, model, keep=("page_id",), text=F.col("text"), declared=F.col("lang"), suffix=F.col("suffix"), domain=F.col("domain"), host=F.col("host"), **options)
