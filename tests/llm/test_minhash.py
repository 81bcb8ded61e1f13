import random

import numpy as np
import pytest

from millrace.llm import minhash
from tests.llm.test_near import brute, corpus


def answer(spark, rows, k, percent, **more):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n int, node string, h int").repartition(3)
    return sorted([tuple(r) for r in minhash.near_duplicates(docs, k, percent, **more).collect()], key=str)


def wanted(rows, k, percent):
    return sorted([(*r, None if r[0] is None or r[2] is None else r[0] == r[2]) for r in brute(rows, k, percent)], key=str)


@pytest.mark.parametrize(("k", "percent", "seed"), [(2, 80, 1), (3, 90, 2)])
def test_equals_brute_force(spark, k, percent, seed):
    rows = corpus(seed)
    want = wanted(rows, k, percent)
    assert answer(spark, rows, k, percent) == want
    assert len({r[2] for r in want}) < len(rows) - 30


def test_no_link_between_rounds_is_lost(spark):
    """Chains, in which each document links with its neighbours only, and one text that many resemble."""
    words = [f"w{i}" for i in range(60)]
    rows = [(50 - i, " ".join(words[: 2 * i] + [f"x{j}" for j in range(60 - 2 * i)])) for i in range(30)]
    rows += [(100 + i, " ".join(["hub"] + words[:50] + [f"y{i}"])) for i in range(80)]
    assert answer(spark, rows, 1, 80) == wanted(rows, 1, 80)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"t{i % 70_000}" for i in range(150_000))
    rows = [(1, long), (2, long + " end"), (3, "short one here"), (4, None), (5, " \n ")]
    assert [r[2:] for r in answer(spark, rows, 2, 80)] == [(1, True), (1, False), (3, True), (4, True), (5, True)]
    assert answer(spark, [], 2, 80) == []


def test_two_collections_that_agree_share_a_key():
    rnd = np.random.default_rng(2)
    hashes = rnd.integers(0, 1 << 63, (2, 6)).astype(np.uint64)
    hashes[1, [1, 4]] = hashes[0, [1, 4]]
    a, b = minhash.table_keys(hashes)
    assert len(a) == 15 and len(set(a) & set(b)) == 1
    hashes[1, 4] += np.uint64(1)
    a, b = minhash.table_keys(hashes)
    assert not set(a) & set(b)


def test_recall_is_what_it_says():
    assert 1 - minhash.recall(0.8) < 1e-4 and minhash.recall(0.2) < 0.01
    rnd = random.Random(4)
    hits = n = 0
    for _ in range(300):
        base = rnd.sample(range(1 << 40), 100)
        cut = rnd.choice([30, 40])
        one, two = (np.sort(np.array(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for x in (base[:-cut], base[cut:]))
        s = (100 - 2 * cut) / 100
        keys = minhash.table_keys(minhash.collection_hashes([one, two]))
        hits += bool(set(keys[0]) & set(keys[1]))
        n += minhash.recall(s)
    assert abs(hits - n) < 4 * 300**0.5
