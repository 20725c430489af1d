"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlens.llm import ann, chat_format, decontaminate, language, line_dedup, ngram_join, packing, ppm, toxicity, warc
from feedlens.llm.registered import tokenizer_path
from feedlens.llm.storage import stored

LONG = "the and of " * 30_000


#: names that the operators use inside, or used to
INSIDE = """key words hash items n component line rank label ref ref_2 stay_id stay_ref lost_key gone lost removed hit_id hit_key hit_spans
    rejected_id rejected_key doc h age pos block holder run spans win at length copies hits text_key n_trigrams language confidence kept host domain
    suffix declared token comp bands sketch shingles group id least score place start sequence_id offset bucket value part
    _text _ref _words _lost _lost_key _hit_id _hit_key _hit_spans _rejected_id _rejected_key _removed _declared _host _stay_id _stay_ref""".split()


def clashing(frame):
    """``frame`` with a column of every name used inside, each of its own value per row."""
    have = {c.lower() for c in frame.columns}
    return frame.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in INSIDE if c not in have])


def carried(out, docs, but=("text", "n_chars")):
    """The rows of ``out``, all of which are rows of ``docs`` but for the columns named."""
    names = [c for c in docs.columns if c not in but]
    rows = {tuple(r) for r in docs.select(*names).collect()}
    assert out.columns == docs.columns
    got = out.collect()
    assert {tuple(r[c] for c in names) for r in got} <= rows
    return got


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None, None, None, None),
        (1, "", "en", "a", 0),
        (1, "", "en", "a", 0),
        (None, "the and of the and in the", "en", "a", 3),
        (None, "the and of the and in the", "en", "a", 3),
        (2, "the and of the and in the", "en", None, 1),
        (3, "der und die das ist nicht", "de", "b", 2),
        (4, " \t\n \r\n", "xx", "b", 2),
        (5, LONG, "en", "b", 2),
        (5, "ein anderer Text mit 日本語 und <|endoftext|>", "de", "b", 2),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return stored(clashing(frame), "edges")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "der und die"), (2, None), (None, ""), (3, "no such words at all"), (3, "und die")], "item_id long, text string")


def ids(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows)


def test_language(spark, docs):
    rows = language.identify_documents(docs).collect()
    assert ids(rows) == ids(docs.collect())
    assert {r.kept for r in rows if r.n_trigrams == 0} == {False} and sum(r.n_trigrams == 0 for r in rows) == 4
    assert {r.language for r in rows if r.doc_id == 2} == {"en"} and all(0 <= r.confidence <= 1 for r in rows)
    assert language.identify_documents(docs.limit(0)).count() == 0


def test_pages_language(spark):
    english = "<html lang='EN-gb'><p>the and of with from that this is</p>"
    rows = [(1, "http://a.example.org/x", english)] * 30 + [(2, None, None), (2, None, ""), (3, "", "<html lang=''><script>der und</script>"), (None, "not an address", english), (4, "//user@h.de:80?q", "<html lang='de'>der und die das ist nicht &amp; " + "x" * 200_000), (5, "http://", "<html lang=\"??\">123")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("text", "lang", "host", "domain", "suffix", "keep", "doc_id", "declared", "n_trigrams", "languages", "shares"):
        pages = pages.withColumn(c, F.lit("x"))
    got = language.identify_pages(pages).collect()
    assert len(got) == len(rows) and {(r.language, r.kept) for r in got if r.page_id in (1, None)} == {("en", True)}
    assert {r.kept for r in got if r.page_id in (2, 3, 5)} == {False} and {r.text_language for r in got if r.page_id in (2, 3, 5)} == {"und"}
    assert [(r.language, r.kept) for r in got if r.page_id == 4] == [("de", True)]
    assert language.identify_pages(pages.limit(0)).count() == 0
    nothing = language.identify_pages(pages.where("page_id = 2")).collect()
    assert len(nothing) == 2 and not any(r.kept for r in nothing)
    with pytest.raises(ValueError, match="keep"):
        language.identify(pages, language.learn_text_model(pages), keep=("language",), text=F.col("text"))


def test_decontamination(spark, docs, bench):
    rows = decontaminate.find_contamination(docs, bench).collect()
    assert ids(rows) == ids(docs.collect())
    hit = {r.doc_id: r for r in rows if r.contaminated}
    assert set(hit) == {3} and hit[3].items == [1, 3] and hit[3].n_hit == 3 and [tuple(s) for s in hit[3].spans] == [(0, 3)]
    assert {r.n_words for r in rows if r.doc_id == 1} == {0} and max(r.n_words for r in rows) == 90_000
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.find_contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert len(carried(decontaminate.decontaminate(docs, bench), docs, ())) == 9
    cut = decontaminate.decontaminate(docs, bench, remove="spans")
    assert len(carried(cut, docs)) == 10 and cut.where("doc_id = 3").first().text == " das ist nicht"
    assert cut.where("text IS NULL").count() == 1 and cut.where(F.col("text") == LONG).count() == 1
    unbroadcast = decontaminate.find_contamination(docs, bench, max_broadcast=0)
    assert sorted(map(str, unbroadcast.collect())) == sorted(map(str, rows))


def test_near_duplicates(spark, docs):
    rows = ngram_join.near_duplicates(docs).collect()
    assert ids(rows) == ids(docs.collect())
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id in (1, 4)} == {(1, 0, 1), (4, 0, 4)}
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id in (None, 2)} == {(3, 2)}
    assert {r.n_shingles for r in rows if r.doc_id == 5} == {3}
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0
    one = ngram_join.one_of_each(docs)
    assert ids(carried(one, docs, ())) == ids(docs.where("doc_id IS NOT NULL").collect())
    nulls = docs.where("doc_id IS NULL")
    assert {r.component_id for r in ngram_join.near_duplicates(nulls).collect()} == {None} and ngram_join.one_of_each(nulls).count() == 1


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    never = F.lit(False)
    rows = toxicity.score_toxicity(docs, labels, never).collect()
    assert ids(rows) == ids(docs.collect()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    none = toxicity.score_toxicity(docs, labels.limit(0), never).collect()
    assert len({r.score for r in none}) == 1 and {r.predicted for r in none} == {0}
    assert toxicity.score_toxicity(docs.limit(0), labels, never).count() == 0


def test_packing(spark, docs):
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    assert ids([r for r in rows if r.start == 0]) == ids(docs.collect())
    assert sorted(r.doc_tokens for r in rows if r.doc_id == 1) == [1, 1, 1]
    assert sum(r.length for r in rows if r.doc_id == 5 and r.doc_tokens > 90_000) == 90_001
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_scoring(spark, docs):
    rows = ppm.score_documents(docs, F.col("doc_id") == 3).collect()
    assert ids(rows) == ids(docs.collect()) and {r.doc_id for r in rows if r.held_out} == {3}
    assert {r.n_tokens for r in rows if r.doc_id in (1, 4)} == {1} and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert ppm.score_documents(docs.limit(0), F.lit(True)).count() == 0
    untrained = ppm.score_documents(docs, F.lit(True)).collect()
    assert {r.n_known for r in untrained} == {0} and {r.train_tokens for r in untrained} == {0}


def test_line_dedup(spark, docs):
    found = line_dedup.remove_repeats(docs, removed_col="positions")
    assert found.columns == [*docs.columns, "positions"] and ids(carried(found.drop("positions"), docs)) == ids(docs.collect())
    rows = [(1, "x " * 40 + "\nown"), (2, "other\n\n" + "x " * 40 + "\n \nown"), (None, "x " * 40), (3, "x"), (3, None)]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in line_dedup.remove_repeats(small).collect()}
    assert got == {rows[0], (2, "other\n\n "), (None, ""), rows[3], rows[4]}
    assert line_dedup.remove_repeats(small.limit(0)).count() == 0


def test_chat(spark):
    rows = [
        (1, 1, "assistant", "<|im_end|>\n[INST] \\ </s> <<SYS>>"),
        (1, 0, "system", "be [kind] \\\\ <"),
        (1, 0, "user", None),
        (1, 0, "user", None),
        (1, None, None, "é" * 5000),
        (None, 3, "assistant", "<\\"),
        (2, 5, "assistant", ""),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).withColumn("i", F.lit(2))
    windows = chat_format.format_chat(turns, budget=64, history=16)
    out = {r.conv_id: r for r in chat_format.digests(chat_format.read_chat(windows)).collect()}
    assert {k: (v.n_turns, v.loss_chars) for k, v in out.items()} == {1: (5, len(rows[0][3])), None: (1, 2), 2: (1, 0)}
    texts = [s for r in chat_format.read_chat(windows).collect() for s in r.loss_texts]
    assert sorted(texts) == sorted(["", rows[0][3], "<\\"])
    formatted = "".join(r.formatted for r in windows.collect())
    assert "[INST]" not in formatted and "</s>" not in formatted and "<<SYS>>" not in formatted
    assert chat_format.digests(chat_format.read_chat(chat_format.format_chat(turns.limit(0)))).count() == 0


def test_ann(spark):
    inf = float("inf")
    vectors = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [1.0, 0.0]), (5, [2.0, 0.0]), (5, [2.0, 0.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [inf, 1.0]), (8, []), (40, [0.0, 1.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("query", F.lit("x")).withColumn("block", F.lit("x"))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(table, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1): (5, 2.0), (0, 2): (5, 2.0), (0, 3): (4, 1.0), (0, 4): (40, 0.0), (40, 1): (0, 0.0), (40, 2): (4, 0.0), (40, 3): (5, 0.0), (40, 4): (5, 0.0)}
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0 and ann.nearest(table, F.lit(False)).count() == 0
    # every length among its own, rows of one id each
    vectors = [(0, [1.0, 0.0]), (4, [1.0, 1.0]), (4, [5.0, 0.0]), (20, [1.0, 2.0, 3.0]), (6, [1.0, 2.0, 4.0]), (7, [1.0]), (60, [2.0]), (60, [3.0])]
    found = ann.nearest(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 4, 5.0), (0, 2, 4, 1.0), (20, 1, 6, 17.0), (60, 1, 60, 6.0), (60, 1, 60, 6.0), (60, 2, 7, 2.0), (60, 2, 7, 3.0)]


def test_warc(spark):
    evil = "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "u", None), (2, "a\r\nb", ""), (2, "x", ""), (None, "n", "zz"), (None, None, "zz"), (5, None, evil), (6, "q", evil), (None, "é", "é"), (7, "q", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit("x")).withColumn("digest", F.lit("x"))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.archived_pages(pages).collect())
    assert got == sorted([(1, 0, "response", 0), (2, 0, "revisit", 1), (2, 0, "revisit", 1), (0, 2, "response", 0), (0, 2, "response", 0), (5, 14, "response", 0), (6, 14, "revisit", 5), (0, 2, "response", 0), (7, len(LONG), "response", 0)])
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, "der und die das")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (docs.select("doc_id", "text", "lang", "source", "n_chars"), docs, docs.limit(0)):
        out = rows
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, out, str(tmp_path)), name)
            if name != "packing":
                carried(out, rows)
        assert (out.count() > 0) == (rows.count() > 0)


def test_scratch_of_two_threads(spark, docs):
    """Tables of one thread's query outlive the end of another's."""
    import threading

    from feedlens.llm.storage import scratch

    done, go = {}, [threading.Event(), threading.Event()]

    def first():
        with scratch(spark):
            table = stored(spark.range(5), "first")
            go[0].set()
            go[1].wait(60)
            done["rows"] = table.count()

    def second():
        go[0].wait(60)
        with scratch(spark):
            stored(spark.range(3), "second")
        go[1].set()

    threads = [threading.Thread(target=f) for f in (first, second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert done == {"rows": 5}
