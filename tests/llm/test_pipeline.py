"""The stages, each held against a plain version on its own input."""

import os
import re

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import quality
from millrace.llm.common import remainder
from tests.llm.test_decontaminate import words
from tests.llm.test_lines import SPACE
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_near import brute as brute_near

SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted([tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()])


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, on the smallest tables."""
    out, docs = {}, spark.read.parquet(f"{SMALL}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        got = spark.read.parquet(path)
        out[name] = (docs, got)
        docs = got
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    for name, (before, after) in stages.items():
        if name != "best-fit packing":
            assert after.columns == before.columns


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    before, after = stages["quality classifier"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.fit(before, labels, remainder(labels["doc_id"], 4) != 2)
    good = {r.doc_id for r in quality.score(before, model).where(F.col("score") >= 0.7).collect()}
    assert {r.doc_id for r in after.collect()} == good
    known = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in after.collect()}
    clean = [i for i, q in known.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_lines(stages):
    before, after = stages["line dedup"]
    rows = [(r[0], r[1], r[3]) for r in rows_of(before)]
    want = {}
    for doc_id, n, gone, text in brute_lines(rows, 10):
        if not gone or any(x.strip(SPACE) for x in text.split("\n")):
            want[doc_id] = text
    assert {r[0]: r[1] for r in rows_of(after)} == want
    assert all(r[4] == len(r[1]) for r in rows_of(after))


def test_one_of_each_group(stages):
    before, after = stages["n-gram Jaccard join"]
    rows = [(r[0], r[1]) for r in rows_of(before)]
    want = [r[0] for r in brute_near(rows, 5, 80) if r[2] == r[0]]
    assert [r[0] for r in rows_of(after)] == sorted(want)


def test_no_benchmark_window_stays_and_clean_documents_do(stages):
    before, after = stages["benchmark decontamination"]
    windows = set()
    for item in ds.dataset(f"{SMALL}/benchmark.parquet").to_table().to_pylist():
        w = words(item["text"])
        m = min(10, len(w))
        windows |= {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
    sizes = {len(w) for w in windows}
    want = []
    for r in rows_of(before):
        w = words(r[1])
        if not any(tuple(w[i : i + m]) in windows for m in sizes for i in range(len(w) - m + 1)):
            want.append(r)
    assert rows_of(after) == want


def test_packing_has_every_document_once(stages):
    before, after = stages["best-fit packing"]
    got = after.collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows_of(before)}
    assert len({(r.doc_id, r.piece) for r in got}) == len(got)
    filled = {}
    for r in got:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 1024


def test_run_equals_the_stages(spark, stages):
    _, last = stages["best-fit packing"]
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL).select(*pieces).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, last.select(*pieces).collect()))


def test_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some text\nhere", "en", None, 14), (3, "some text\nhere", "en", "b", 14)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SMALL).count() <= max(len(data), 1) + 2
    assert re.match("quality", corpus_pipeline.STAGES[0][0])


def test_run_deletes_what_the_next_stage_has_read(spark, monkeypatch):
    there = []

    def noted(spark, docs, sf_dir):
        there.append(docs.inputFiles()[0].removeprefix("file://"))
        return docs.where("doc_id IS NOT NULL")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(k), noted) for k in range(4)])
    got = corpus_pipeline.run(spark, SMALL)
    assert [os.path.exists(x) for x in there] == [True, False, False, True]
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
