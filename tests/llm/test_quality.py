import numpy as np
import pyarrow.dataset as ds
import pytest

from millrace.llm import quality
from millrace.llm.common import remainder
from millrace.llm.queries import op5_quality

SMALL = "/root/testdata/sf0.01"


def test_trees_learn_an_interaction_and_walk_as_one_by_one():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit_trees(x[:2000], y[:2000], rounds=40, depth=3)
    p = trees.score(x[2000:])
    assert ((p >= 0.5) == y[2000:]).mean() > 0.95
    for row, got in zip(x[2000:2020], p, strict=False):
        raw = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.threshold[t, node])
            raw += trees.leaf[t, node - trees.feature.shape[1]]
        assert got == pytest.approx(1 / (1 + np.exp(-raw)))


def test_one_kind_or_no_labels():
    one = quality.fit_trees(np.zeros((50, 3)), np.ones(50))
    assert (one.score(np.zeros((2, 3))) > 0.99).all()
    none = quality.fit_trees(np.zeros((0, 3)), np.zeros(0))
    assert (none.score(np.zeros((2, 3))) > 0.99).all()


def test_statistics_of_any_text():
    for text in (b"", b" ", b"\n\n", b"a", "é".encode() * 5, b"x" * 3_000_000, b"A B! " * 10):
        got = quality.statistics(text)
        assert len(got) == len(quality.FEATURES) and np.isfinite(got).all()


def test_held_out_accuracy_and_contract(spark):
    got = op5_quality(spark, SMALL).toPandas().set_index("doc_id")
    docs = ds.dataset(f"{SMALL}/documents.parquet").to_table()
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    labels = ds.dataset(f"{SMALL}/labels.parquet").to_table().to_pandas().set_index("doc_id")
    both = got.join(labels, how="inner")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    worst, best = held[held.quality == 0].score.median(), held[held.quality == 1].score.median()
    assert worst < 0.2 < 0.9 < best


def test_nulls_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", "a", 1), (1, "good text here", "a", 1), (2, None, None, 2), (None, "", "b", 3)], "doc_id long, text string, out string, score int"
    )
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (7, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels, remainder(labels["doc_id"], 4) != 9)
    assert quality.score(docs, model).count() == 4
    assert quality.keep_good(docs, model).columns == docs.columns
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels)).collect() == []
    assert quality.fit(docs, labels.limit(0)).score(np.zeros((1, len(quality.FEATURES))))[0] > 0.99


def test_fit_reads_a_bounded_sample(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('word ', CAST(id % 7 AS int)) AS text")
    labels = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    seen = []
    quality_fit = quality.fit_trees
    try:
        quality.fit_trees = lambda x, y: seen.append(len(x)) or quality_fit(x, y)
        quality.fit(docs, labels, fit_rows=40)
    finally:
        quality.fit_trees = quality_fit
    assert seen == [40]


def test_histogram_splits_equal_all_cuts_tried():
    """Few distinct values, so that every cut has a bin: the same trees as by trying each value of each column in each node."""
    rnd = np.random.default_rng(7)
    x = rnd.integers(0, 9, (150, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 6) | (rnd.random(150) < 0.1)).astype(float)
    rate, penalty, least, depth = 0.3, 1.0, 8, 2
    trees = quality.fit_trees(x, y, rounds=4, depth=depth, rate=rate, bins=64, least=least, penalty=penalty)
    raw = np.full(150, trees.base)
    for _ in range(4):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)

        def worth(rows, g=g, h=h):
            return g[rows].sum() ** 2 / (h[rows].sum() + penalty)

        parts = [np.arange(150)]
        for _ in range(depth):
            halves = []
            for rows in parts:
                best = (1e-9, None)
                for j in range(3):
                    for v in np.unique(x[:, j])[:-1]:
                        left, right = rows[x[rows, j] <= v], rows[x[rows, j] > v]
                        if min(len(left), len(right)) >= least and (gain := worth(left) + worth(right) - worth(rows)) > best[0] + 1e-12:
                            best = (gain, (left, right))
                halves += best[1] or (rows, rows[:0])
            parts = halves
        for rows in parts:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + penalty)
    assert np.allclose(trees.score(x), 1 / (1 + np.exp(-raw)))
