import hashlib
import random
import re

import numpy as np
import pytest

from millrace.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            v = words(body)
            m = min(window, len(v))
            if not m or item is None:
                continue
            for i in range(len(v) - m + 1):
                for j in range(len(w) - m + 1):
                    if w[j : j + m] == v[i : i + m]:
                        hit |= set(range(j, j + m))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def answer(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, n_words string, items int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(decontaminate.find_items(d, b, **more))
    return sorted([tuple(r) for r in got.collect()], key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    some = ["a", "B", "c", "é", "D", "x1", "Ωmega"]

    def text(n):
        return "".join(rnd.choice(some) + rnd.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    docs = [(i, text(rnd.randint(0, 300))) for i in range(60)] + [(60, None), (61, ""), (62, "..."), (5, "a b"), (5, "a b"), (None, "a B c d")]
    items = [(i, text(rnd.randint(0, 9))) for i in range(25)] + [(30, None), (None, "a"), (3, "x1 x1 x1"), (31, text(40))]
    items = [x for x in items if len(words(x[1])) != 1]
    want = brute(docs, items, 4)
    assert answer(spark, docs, items, window=4) == want
    assert answer(spark, docs, items, window=4, block_words=6) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)


def test_one_word_item_and_exact_window(spark):
    docs = [(1, "one TWO three"), (2, "twofold"), (3, "three four five six")]
    assert [r[2:4] for r in answer(spark, docs, [(1, "Two!")])] == [(1, 1), (0, 0), (0, 0)]
    assert [r[2] for r in answer(spark, docs, [(1, "three four five six seven")], window=4)] == [0, 0, 4]


def test_empty_tables_and_clean_rows(spark):
    assert answer(spark, [], [(1, "a")]) == []
    assert [r[2] for r in answer(spark, [(1, "a b")], [])] == [0]
    docs = spark.createDataFrame([(1, "a b c", "p"), (2, "d e", "q"), (None, None, None)], "id long, body string, hit string")
    items = spark.createDataFrame([(9, "b c")], "item_id long, text string")
    kept = decontaminate.keep_clean(docs, items, text_col="body")
    assert sorted(kept.collect(), key=str) == sorted([(2, "d e", "q"), (None, None, None)], key=str)


def test_long_text(spark):
    text = "lorem " * 400_000 + "needle in a haystack " + "ipsum " * 400_000
    got = answer(spark, [(1, text)], [(7, "needle in a haystack")])
    assert got[0][1:4] == (800_004, 4, 1)


@pytest.mark.parametrize("n", [2_000, 200_000])
def test_most_positions_are_skipped_at_any_size(n):
    """Zipf-like words: the mean shift of a block that a text has is above half of the largest one."""
    rnd = np.random.default_rng(3)
    vocabulary = [f"w{i}".encode() for i in range(n // 4)]

    def text(k):
        return b" ".join(vocabulary[min(int(x) - 1, len(vocabulary) - 1)] for x in rnd.zipf(1.2, k))

    tables = decontaminate.Benchmark([(str(i), text(500)) for i in range(n // 500)], 10)
    (t,) = tables.tables
    ids = np.array([tables.vocabulary.get(w, -1) for w in decontaminate.words_of(text(20_000))])
    known = (ids[1:] >= 0) & (ids[:-1] >= 0)
    shift = t.shift[decontaminate._block_hash(ids[:-1][known], ids[1:][known], t.bits)]
    # frequent pairs of words stand in many windows: those that the patterns do not hold are skipped
    held = {(a, b) for row in t.rows.tolist() for a, b in zip(row, row[1:])}
    fresh = np.array([(a, b) not in held for a, b in zip(ids[:-1][known].tolist(), ids[1:][known].tolist())])
    assert shift[fresh].mean() > 0.5 * (t.length - 1)
