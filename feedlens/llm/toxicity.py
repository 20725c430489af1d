"""Toxicity by a weighted finite-state grammar over clauses.

A clause is a run of words between sentence marks or line ends.  Its words become symbols:
insult, opening and closing word of an insult of two words (with weights), threat verb, modal,
target, negation, report, or other.  Five transducers read the symbols:

* insult gives the weight of an insult word, or of an opening word followed by its closing one;
* threat gives a weight where a threat verb meets its target, more if a modal announced it;
* target marks the clause from both sides;
* negation opens a scope of a few words;
* report: a reporting verb frames the rest of its clause.

Their composition, one machine, tags every insult and threat with the state it is met in.  A
document is scored by what its matched clauses amount to per tag, so "not an idiot", "she called
it trash" and "you idiot" can weigh differently; how differently is learned.

Learned from a bounded, documented sample of labelled rows: the insults (whole words, word
beginnings and pairs of words whose document counts differ between the labels beyond chance)
with their log-odds as weights, and a logistic regression on the clause features.  The
function-word classes and threat verbs are fixed lists in four languages.  Everything is matched
by 64-bit hashes over Arrow bytes, whole texts, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm import bytetext
from feedlens.llm.bytetext import mix, text_blocks
from feedlens.llm.ppm import Table
from feedlens.llm.storage import only, stored

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, MODAL, OPEN, CLOSE = SYMBOLS = range(9)
#: fixed word classes
CLASSES = {
    TARGET: "you your yours he she they him them her du dich dir ihr euch er sie tu te toi vous il elle ils elles tú usted ustedes él ella ellos".split(),
    NEGATION: "not no never none nicht kein keine nie ne pas jamais non nunca".split(),
    REPORT: "said says say called calls quoted wrote told sagte sagt nannte schrieb dit disait écrit dijo dice llamó escribió".split(),
    MODAL: "will ll gonna going shall must should want hope werde wird werden soll muss vais va allons veux doit voy vamos quiero debe".split(),
    THREAT: """kill kills killed killing hurt hurts hurting destroy destroys destroyed destroying beat beats beaten beating shoot shoots shot shooting
        töten töte tötet getötet schlagen schlage schlägt geschlagen tuer tue tues tuerai tué frapper frappe frapperai frappé
        matar mato mata mataré matado golpear golpeo golpea golpearé""".split(),
}
#: weight of a threat that a modal announces; without one it is half
THREAT_WEIGHT = 4.0
#: words from a modal to its verb, and between a verb and its target
THREAT_REACH = 3
#: word beginnings of these many bytes are stems
STEM_BYTES = (4, 5, 6, 7)
#: words a negation reaches
NEGATION_SCOPE = 3
FEATURES = ("plain", "targeted", "negated", "reported", "threat")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[65:91] = True
_LETTER[128:] = True
_CLAUSE_END = np.zeros(256, dtype=bool)
_CLAUSE_END[[10, 13, 33, 46, 58, 59, 63]] = True


class Transducer:
    """Deterministic: from ``state`` a symbol leads to arcs[state][symbol] and writes out[state][symbol]."""

    def __init__(self, arcs: list[list[int]], out: list[list[tuple]]) -> None:
        self.arcs, self.out = arcs, out

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same symbols, what they write is put together; of the product the states reached from the start."""
        place, arcs, out = {(0, 0): 0}, [], []
        for a, b in iter_growing(place):
            row = [(self.arcs[a][s], other.arcs[b][s]) for s in SYMBOLS]
            arcs.append([place.setdefault(pair, len(place)) for pair in row])
            out.append([self.out[a][s] + other.out[b][s] for s in SYMBOLS])
        return Transducer(arcs, out)

    def run(self, symbols: list[int]) -> list[tuple]:
        """What each symbol writes."""
        state, out = 0, []
        for s in symbols:
            out.append(self.out[state][s])
            state = self.arcs[state][s]
        return out


def iter_growing(states: dict[tuple, int]) -> Iterator[tuple]:
    """The keys in order, those added meanwhile too."""
    done = 0
    while done < len(states):
        yield list(states)[done]
        done += 1


def machine(start: tuple, step) -> Transducer:
    """The transducer of ``step(state, symbol) -> (next state, what is written)`` from ``start`` on."""
    place, arcs, out = {start: 0}, [], []
    for state in iter_growing(place):
        row = [step(state, s) for s in SYMBOLS]
        arcs.append([place.setdefault(after, len(place)) for after, _ in row])
        out.append([written for _, written in row])
    return Transducer(arcs, out)


def negation(scope: int = NEGATION_SCOPE) -> Transducer:
    """Writes whether a negation lies at most ``scope`` words before."""
    return machine((0,), lambda state, s: ((scope if s == NEGATION else max(0, state[0] - 1),), (state[0] > 0,)))


def seen(symbol: int) -> Transducer:
    """Writes whether ``symbol`` came before in the clause."""
    return machine((False,), lambda state, s: ((state[0] or s == symbol,), state))


def insult() -> Transducer:
    """Writes whether an insult ends here: an insult word, or a closing word right behind its opening one."""
    return machine((False,), lambda state, s: ((s in (OPEN, CLOSE),), (s == INSULT or (s == CLOSE and state[0]),)))


def threat(reach: int = THREAT_REACH) -> Transducer:
    """Writes the weight of a threat that ends here.

    A threat is a threat verb and a target at most ``reach`` words behind it, or a modal, a target and a verb, each at
    most ``reach`` words behind the one before; a modal at most ``reach`` words before the verb makes it announced.
    """

    def step(state: tuple, s: int) -> tuple:
        modal, aimed, verb, announced = state  # words left of each reach
        weight = 0.0
        after = (max(0, modal - 1), max(0, aimed - 1), max(0, verb - 1), announced and verb > 1)
        if s == MODAL:
            after = (reach, 0, *after[2:])
        elif s == TARGET:
            if verb:
                weight = THREAT_WEIGHT if announced else THREAT_WEIGHT / 2
                after = (after[0], after[1], 0, False)
            if modal:
                after = (after[0], reach, *after[2:])
        elif s == THREAT:
            if aimed:
                weight = THREAT_WEIGHT
                after = (0, 0, 0, False)
            else:
                after = (0, 0, reach, modal > 0)
        return after, (weight,)

    return machine((0, 0, 0, False), step)


GRAMMAR = negation().compose(seen(REPORT)).compose(seen(TARGET)).compose(insult()).compose(threat())
_BACKWARD = seen(TARGET)


def clause_features(symbols: list[int], weights: list[float]) -> list[float]:
    """What the matches of one clause amount to: (plain, targeted, negated, reported, threat)."""
    out = [0.0] * len(FEATURES)
    behind = _BACKWARD.run(symbols[::-1])[::-1]
    for w, (negated, reported, ahead, insulting, threatening), (after,) in zip(weights, GRAMMAR.run(symbols), behind, strict=True):
        if insulting:
            tag = 3 if reported else 2 if negated else 1 if ahead or after else 0
            out[tag] += w
        if threatening and not negated and not reported:
            out[4] += threatening
    return out


class _Block:
    """Letter runs of a block of texts with their clause, hash, stem hashes and the hashes of neighbours in a clause."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.n_docs = len(offsets) - 1
        low = bytetext._LOWER[data]
        letter = _LETTER[data]
        before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        if len(data):
            before[1:], after[:-1] = letter[:-1], letter[1:]
            inner = offsets[(offsets > 0) & (offsets < len(data))]
            before[inner] = False
            after[inner - 1] = False
        self.starts = np.flatnonzero(letter & ~before)
        ends = np.flatnonzero(letter & ~after) + 1
        self.lens = ends - self.starts
        bounds = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(bounds))
        stops = np.cumsum(_CLAUSE_END[data]) if len(data) else np.zeros(0, np.int64)
        self.clause = stops[self.starts] + self.doc if len(self.starts) else self.starts
        firsts = np.cumsum(self.lens) - self.lens
        position = np.arange(int(self.lens.sum()), dtype=np.int64) - np.repeat(firsts, self.lens)
        letters = low[position + np.repeat(self.starts, self.lens)]
        sums = np.concatenate(([np.uint64(0)], np.cumsum(bytetext._ZOBRIST[((position & 63) << 8) | letters], dtype=np.uint64)))
        self.word = mix(sums[firsts + self.lens] - sums[firsts] + self.lens.astype(np.uint64))
        # a stem is shorter than its word
        self.stems = []
        for size in STEM_BYTES:
            at = np.flatnonzero(self.lens > size)
            self.stems.append((at, mix(sums[firsts[at] + size] - sums[firsts[at]] + np.uint64(1000 + size))))
        at = np.flatnonzero(self.clause[1:] == self.clause[:-1]) + 1
        self.pairs = at, mix(self.word[at - 1] * np.uint64(0x9E3779B97F4A7C15) + self.word[at])


def _hash(words: list[str]) -> np.ndarray:
    data = " ".join(words).encode()
    return _Block(np.frombuffer(data, np.uint8), np.array([0, len(data)])).word


def _count(width: int):
    schema = pa.schema([("h", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        classes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h, label = np.concatenate(held), np.concatenate(classes)
            keys, at = np.unique(h, return_inverse=True)
            n, t = np.bincount(at), np.bincount(at, weights=label).astype(np.int64)
            held.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(t), pa.array(n - t)], schema=schema)

        for batch in batches:
            labels = batch.column(0).to_numpy()
            for first, data, offsets in text_blocks(batch.column(1)):
                b = _Block(data, offsets)
                h = np.concatenate([b.word, *[x for _, x in (*b.stems, b.pairs)]])
                doc = np.concatenate([b.doc, *[b.doc[at] for at, _ in (*b.stems, b.pairs)]])
                order = np.argsort(h)
                order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
                h, doc = h[order], doc[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                held.append(h[new])
                classes.append(labels[first + doc[new]].astype(np.float64))
                if sum(map(len, held)) > width:
                    yield flush()
        if held:
            yield flush()

    return run


def _featured(lexicon: tuple[np.ndarray, np.ndarray], columns: int, names: list[str]):
    """Adds the five clause features to the rows' first ``columns`` columns."""
    hashes, weights = lexicon
    fixed = [(c, h) for c, words in CLASSES.items() for h in _hash(words)]
    class_keys, class_of = np.array([h for _, h in fixed], np.uint64), np.array([c for c, _ in fixed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, classes = Table(hashes), Table(class_keys)
        for batch in batches:
            out = np.zeros((batch.num_rows, len(FEATURES)))
            for first, data, offsets in text_blocks(batch.column(columns)):
                b = _Block(data, offsets)
                weight = np.zeros(len(b.word))
                for at, h in [(np.arange(len(b.word)), b.word), *b.stems]:
                    found = table.find(h)
                    hit = found >= 0
                    weight[at[hit]] = np.maximum(weight[at[hit]], weights[found[hit]])
                kind = classes.find(b.word)
                symbol = np.where(weight > 0, INSULT, np.where(kind >= 0, class_of[kind], OTHER))
                at, h = b.pairs
                found = table.find(h)
                both = np.where(found >= 0, weights[found] if len(weights) else 0.0, 0.0)
                closes = both > weight[at]
                at = at[closes]
                weight[at], symbol[at] = both[closes], CLOSE
                opens = at[symbol[at - 1] == OTHER] - 1
                symbol[opens] = OPEN
                closes = at[~np.isin(symbol[at - 1], (OPEN, CLOSE))]  # its first word is a symbol of its own
                symbol[closes] = INSULT
                matched = np.unique(b.clause[np.isin(symbol, (INSULT, CLOSE, THREAT))])
                lo, hi = np.searchsorted(b.clause, matched), np.searchsorted(b.clause, matched, side="right")
                for a, z in zip(lo.tolist(), hi.tolist(), strict=True):
                    out[first + b.doc[a]] += clause_features(symbol[a:z].tolist(), weight[a:z].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:columns], *[pa.array(out[:, i]) for i in range(len(FEATURES))]], names=names)

    return run


def clause_scores(docs: DataFrame, lexicon: tuple[np.ndarray, np.ndarray], keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` with what its matched clauses amount to per tag (whole texts)."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(_featured(lexicon, len(keep), [*keep, *FEATURES]), schema + "".join(f", {x} double" for x in FEATURES))


def learn_lexicon(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, weights) of words, stems and pairs of words held by more toxic documents than chance explains.

    ``labelled``: (label 0/1, text).  Kept: G-squared of the document counts over 2 ln(10 m) for m
    distinct words, stems and pairs, at least 1 in log-odds less one standard error.
    """
    counts = labelled.select(F.col("label").cast("int"), F.col("text").cast("string")).mapInArrow(_count(2_000_000), "h bigint, toxic bigint, clean bigint")
    counts = stored(counts.groupBy("h").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")), "stems")
    sizes = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)).cast("double"), F.count("*").cast("double")).first()
    n1, n0 = float(sizes[0]), float(sizes[1]) - float(sizes[0])
    if not n1 or not n0:
        return np.zeros(0, np.uint64), np.zeros(0)
    m = counts.count()
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(F.lit(0.0))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = n1 / (n1 + n0)
    both = a + b
    g2 = 2 * (part(a, both * share) + part(b, both * (1 - share)))
    weight = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1)) - F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    top = counts.where((a > both * share) & (g2 >= float(2 * np.log(10.0 * max(1, m))))).select("h", weight.alias("w")).where("w >= 1").orderBy("h").toArrow()  # bounded by the sample
    return top["h"].to_numpy().view(np.uint64), top["w"].to_numpy()


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 1.5))
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        keep = np.append(np.full(len(w) - 1, ridge), 1e-6)
        grad = x.T @ (y - p) - keep * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = 20_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, and the five clause features.

    Learns from at most ``sample_rows`` rows of ``labels`` (those with the smallest hash of the id among
    the rows with a 0/1 label, an id and ``held_out``, an expression on the id, not true; a repeated id counts once,
    with its largest label).  Scores depend on the text alone.  Null, empty and wordless texts have
    no matches and get the score of the intercept.  Without usable labels of both kinds the lexicon is empty
    and all scores are equal.  Repeated rows are scored each; a null id is kept.  Other columns play no part;
    an empty ``docs`` gives no rows.
    """
    known = labels.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{label_col}`").cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col(id_col).isNotNull() & ~F.coalesce(held_out, F.lit(False)))
    sample = known.groupBy(id_col).agg(F.max("label").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(sample_rows)
    rows = only(docs, **{id_col: id_col, "text": text_col})
    labelled = stored(rows.join(F.broadcast(sample), id_col).select("label", "text"), "labelled")  # sample_rows bounds the broadcast
    lexicon = learn_lexicon(labelled)
    fit = clause_scores(labelled, lexicon, ["label"]).toArrow()  # sample_rows bounds it
    y = fit["label"].to_numpy().astype(float)
    x = np.log1p(np.column_stack([fit[f].to_numpy() for f in FEATURES])) if len(y) else np.zeros((0, len(FEATURES)))
    w = fit_logistic(x, y)
    found = clause_scores(rows, lexicon, [id_col])
    logit = F.lit(float(w[-1]))
    for f, c in zip(FEATURES, w[:-1], strict=True):
        logit = logit + F.log1p(f) * F.lit(float(c))
    score = 1 / (1 + F.exp(-logit))
    return found.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), *FEATURES)
