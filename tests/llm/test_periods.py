import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm.common import hashed_words
from millrace.llm.periods import find_runs, periodic_tails, report, runs_of


def brute(w, least=12):
    """Every stretch in which words p apart agree, for every p; of equal runs that of the smallest period."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        t = 0
        while t + p < len(w):
            lo = t
            while t + p < len(w) and w[t] == w[t + p]:
                t += 1
            if t > lo and t - lo + p >= max(least, 2 * p):
                found.setdefault((lo, t - lo + p), p)
            t += t == lo
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(rnd):
    n = rnd.choice([0, 1, 11, 30, 150])
    kind = rnd.random()
    if kind < 0.4:
        return [rnd.choice("abcdef"[: rnd.randint(1, 6)]) for _ in range(n)]
    if kind < 0.7:
        w = ([rnd.choice("abcd") for _ in range(rnd.randint(1, 17))] * (n + 1))[:n]
        for _ in range(rnd.randint(0, 3)):
            if w:
                w[rnd.randrange(len(w))] = rnd.choice("abz")
        return w
    a, b = ["a"], ["a", "b"]  # words of Fibonacci: many runs inside one another
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("least", [2, 12])
def test_runs_equal_brute_force(least):
    rnd = random.Random(least)
    for _ in range(400):
        texts = [words(rnd) for _ in range(rnd.randint(1, 4))]
        hashes, starts, _, _ = hashed_words([" ".join(w).encode() for w in texts], lower=False)
        got = [tuple(map(int, r)) for r in zip(*runs_of(hashes, starts, least), strict=True)]
        want = [(int(at) + s, n, p) for w, at in zip(texts, starts[:-1], strict=True) for s, n, p in brute(w, least)]
        assert got == want


def test_long_period_and_one_word_over_and_over():
    rnd = random.Random(1)
    base = [str(rnd.random()) for _ in range(40_000)]
    for w, want in ((base * 2, (0, 80_000, 40_000)), (["x"] * 100_000, (0, 100_000, 1))):
        hashes, starts, _, _ = hashed_words([" ".join(w).encode()], lower=False)
        assert [tuple(map(int, r)) for r in zip(*runs_of(hashes, starts), strict=True)] == [want]
    none = runs_of(np.empty(0, np.uint64), np.array([0, 0]))
    assert [len(x) for x in none] == [0, 0, 0]


def corpus():
    rnd = random.Random(5)
    rows = [(i, rnd.choice([" ", "\n\t "]).join(words(rnd))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "one"), (104, "Ab ab " * 20), (7, rows[3][1]), (7, rows[3][1]), (None, "a " * 30)]
    return rows + [(105, " ".join(f"é{i % 7}" for i in range(3_000)))]


def test_find_runs_and_report(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, runs string").repartition(5)
    got = sorted(
        ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs).collect()), key=str
    )
    want = []
    for doc_id, text in rows:
        w = (text or "").split()
        runs = brute(w)
        want.append((doc_id, len(w), runs, collapsed(w, runs)))
    assert got == sorted(want, key=str)
    by = {r.doc_id: r for r in report(find_runs(docs)).collect()}
    assert (by[100].n_runs, by[100].start, by[100].length, by[100].period, by[100].exponent_milli) == (0, None, None, None, None)
    assert by[100].runs_sha256 == by[100].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    for doc_id, text in rows:
        w = (text or "").split()
        runs = brute(w)
        if not runs:
            continue
        s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        r = by[doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), s, n, p, 1000 * n // p)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()


def test_tails_repeat_in_a_tenth_of_the_rows(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(300)] + [(1000, None), (None, "a b c")]
    got = {r.doc_id: r.text for r in periodic_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    changed = 0
    for doc_id, text in rows:
        w = (text or "").split()
        h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[doc_id].split() == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        else:
            assert got[doc_id] == text
    assert changed > 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert find_runs(docs).collect() == [] and report(find_runs(periodic_tails(docs))).collect() == []
