import os
import random

import numpy as np
import pytest

from millrace.llm import near
from millrace.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text, k):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[max(top(i), top(j))] = min(top(i), top(j))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return sorted(out, key=str)


def answer(spark, rows, k, percent):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, node string").repartition(3)
    return sorted([tuple(r)[:3] for r in near.near_groups(docs, k, percent).collect()], key=str)


def corpus(seed, n=160):
    rnd = random.Random(seed)
    rows, bases = [], [[f"{rnd.choice('abcdefg')}{rnd.randint(0, 30)}" for _ in range(rnd.randint(1, 80))] for _ in range(12)]
    for i in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            k = rnd.randrange(len(words))
            words[k : k + 1] = rnd.choice([[], ["new"], [words[k].upper(), "more"]]) if len(words) > 1 else words
        rows.append((i * 2 + 5, rnd.choice([" ", "\n "]).join(words)))
    return rows + [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE"), (1004, "one two"), (None, rows[3][1]), (7, rows[9][1]), (7, "z y x w v"), (9, "z y x w v u"), (9, "z y x w v u")]


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 90, 4096), (2, 60, 4), (5, 80, 16)])
def test_equals_brute_force(spark, k, percent, block, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", block)
    rows = corpus(k * percent + block)
    want = brute(rows, k, percent)
    assert answer(spark, rows, k, percent) == want
    assert len({r[2] for r in want}) < len(rows) - 30


def test_chain_of_links_and_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(near, "OFTEN", 2)
    words = [f"w{i}" for i in range(60)]
    rows = [(50 - i, " ".join(words[:i] + [f"x{j}" for j in range(60 - i)])) for i in range(40)]
    assert answer(spark, rows, 1, 90) == brute(rows, 1, 90)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"t{i % 70_000}" for i in range(150_000))
    rows = [(1, long), (2, long + " end"), (3, "short one here")]
    assert [r[2] for r in answer(spark, rows, 3, 90)] == [1, 1, 3]
    assert answer(spark, [], 3, 90) == []


def test_keep_first_keeps_columns_and_one_of_each_group(spark):
    rows = [(3, "a b c d e f g", "p"), (1, "a b c d e f g", "q"), (None, "A b c d e f g", "r"), (4, None, "s"), (5, "other words here now ok", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id string")
    got = near.keep_first(docs, 5, 80)
    assert got.columns == docs.columns
    assert sorted(r.gone_id for r in got.collect()) == ["q", "s", "t"]


def test_components_equal_union_find(spark):
    rnd = random.Random(3)
    links = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    up = {x: x for e in links for x in e}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for e in links for x in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def files(folder, begin):
    return {f"{d}/{x}" for d, names, found in os.walk(folder) for x in [*names, *found] if x.startswith(begin)}


def long_texts(n=14, words=2500, passage=700):
    """Texts of common words that share a passage of rare ones, about the eighth part of any two, and a near copy of the first."""
    rnd = random.Random(5)
    shared = [f"p{i}" for i in range(passage)]
    rows = []
    for i in range(n):
        own = [f"{rnd.choice('abcdefgh')}{rnd.randint(0, 40)}" for _ in range(words)]
        rows.append((i + 1, " ".join(own[: 100 * i] + shared + own[100 * i :])))
    return [*rows, (n + 1, rows[0][1] + " and more")]


def test_sets_that_differ_by_parities_are_not_read(spark, monkeypatch):
    read, verified = [], near._verified

    def noted(pairs, *a):
        read.append(pairs.count())
        return verified(pairs, *a)

    monkeypatch.setattr(near, "_verified", noted)
    rows = long_texts()
    assert answer(spark, rows, 5, 80) == brute(rows, 5, 80)
    assert sum(read) == 1  # by length, place and the sizes of 64 ranges, all pairs pass


def test_parities_never_tell_more_apart_than_the_sets_do():
    rnd = np.random.default_rng(2)
    for n in (1, 5, 63, 64, 65, 500, 5000):
        x = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        for kept in (0.0, 0.6, 0.9, 1.0):
            y = np.unique(np.concatenate((x[: int(kept * n)], rnd.integers(0, 1 << 63, int(n * 0.3) + 1, dtype=np.uint64))))
            differ = near._differ(near._parity(x), near._parity(y))
            assert differ == near._differ(near._parity(y), near._parity(x)) <= len(np.setxor1d(x, y))
    assert near._differ(near._parity(x), near._parity(rnd.integers(0, 1 << 63, 5000, dtype=np.uint64))) > 2 * 5000 * 0.2


def test_pairs_verified_in_parts(spark, monkeypatch):
    parts, verified = [], near._verified
    monkeypatch.setattr(near, "_verified", lambda *a: parts.append(a) or verified(*a))
    monkeypatch.setattr(near, "HELD", 1)
    rows = corpus(11)
    assert answer(spark, rows, 3, 80) == brute(rows, 3, 80)
    assert len(parts) > 3


def test_no_shuffle_files_and_few_tables_are_left(spark):
    docs = spark.createDataFrame(corpus(4), "doc_id long, text string").repartition(3)
    local = spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    shared = shared.removeprefix("file:")
    before, tables = files(os.path.dirname(local), "shuffle_"), files(shared, "table-")
    got = near.near_groups(docs, 3, 90)
    assert files(os.path.dirname(local), "shuffle_") <= before
    assert len(files(shared, "table-") - tables) == 3  # members, nodes and labels, which the result reads
    assert got.count() == docs.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
