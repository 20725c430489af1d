"""What the n-gram join takes beside the heap: batches of texts, a worker's arrays, memory given back."""

import tracemalloc
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from feedlens.llm import bytetext, language, ngram_join, packing
from feedlens.llm.registered import tokenizer_path
from feedlens.llm.storage import stored, text_batches

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def texts(n, words=300, seed=0):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{x}" for x in row) for row in rng.integers(0, 50_000, (n, words)).tolist()]


def largest_batch(df):
    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(b)])], names=["n"])

    return max(r["n"] for r in df.mapInArrow(rows, "n bigint").collect())


def test_texts_go_to_python_in_small_batches(spark):
    before = spark.conf.get(BATCH_ROWS)
    df = spark.range(0, 3000, 1, 1)
    assert largest_batch(df) > 500
    with text_batches(spark), text_batches(spark):
        assert largest_batch(df) <= 500
    with pytest.raises(ValueError), text_batches(spark):
        raise ValueError
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: enter(spark), range(40)))
    assert spark.conf.get(BATCH_ROWS) == before
    spark.conf.set(BATCH_ROWS, "100")
    try:
        with text_batches(spark):
            assert largest_batch(df) <= 100
        assert spark.conf.get(BATCH_ROWS) == "100"
    finally:
        spark.conf.set(BATCH_ROWS, before)


def enter(spark):
    with text_batches(spark):
        assert int(spark.conf.get(BATCH_ROWS)) <= 500


def test_text_passes_of_the_pipeline_use_them(spark, monkeypatch):
    seen = {}

    def spy(module, name):
        real = getattr(module, name)

        def watched(df, label, *args, **options):
            seen[module.__name__.split(".")[-1], label] = int(spark.conf.get(BATCH_ROWS))
            return real(df, label, *args, **options)

        monkeypatch.setattr(module, name, watched)

    for module, name in ((ngram_join, "stored"), (ngram_join, "stored_rows"), (language, "stored"), (packing, "stored")):
        spy(module, name)
    docs = stored(spark.createDataFrame([(k, t, "en", "a.org") for k, t in enumerate(texts(20))], "doc_id bigint, text string, lang string, source string"), "docs")
    assert ngram_join.near_duplicates(docs).count() == 20
    language.identify_documents(docs).count()
    packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path()).count()
    for step in (("ngram_join", "frequent"), ("ngram_join", "sets"), ("language", "likelihoods"), ("packing", "pieces")):
        assert seen[step] <= 500, step


def test_a_worker_of_the_shingle_pass_takes_little():
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(6000)), pa.array(np.arange(6000)), pa.array(texts(6000))], names=["doc_id", "ref", "text"])
    run = ngram_join._shingle_runs(5, 16, np.zeros(0, np.uint64))
    tracemalloc.start()
    try:
        shingles = sum(int(sum(c)) for out in run(iter([batch])) for c, h in zip(out["counts"].to_pylist(), out["docs"].to_pylist(), strict=True) if h is None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert shingles == 6000 * 296
    assert peak < 60 << 20


def test_groups_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(bytetext, "release_memory", lambda: calls.append(1))
    monkeypatch.setattr(ngram_join, "release_memory", lambda: None)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array(["a b c d e f", "a b c d e g"])], names=["doc_id", "ref", "text"])
    runs = pa.Table.from_batches(ngram_join._shingle_runs(5, 1, np.zeros(0, np.uint64))(iter([batch])))
    shared = ngram_join._share(1)((pa.scalar(0),), runs.filter(pc.equal(runs["part"], 0)))
    assert len(calls) == 1
    heads = ngram_join._share(1)((pa.scalar(1),), runs.filter(pc.equal(runs["part"], 1)))
    sets = ngram_join._order(80, 100)((pa.scalar(0),), pa.concat_tables([shared, heads]))
    assert len(calls) == 3
    assert sorted(sets.filter(pc.equal(sets["kind"], 0))["doc_id"].to_pylist()) == [1, 2]
