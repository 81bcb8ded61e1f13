import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import hmm
from millrace.llm.common import remainder

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text):
    return (text or "").encode().translate(LOWER).split() + [b""]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute_base(rows):
    c = Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            c.update(tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for doc_id, text in rows:
        t = tokens(text)
        out.append((doc_id, held(doc_id), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)))
    return out


def corpus(n=200):
    rnd = random.Random(6)
    one, two = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choice(one if i % 2 else two) for _ in range(rnd.randint(0, 60)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "UPPER Case wörd"), (3, "a1 a2"), (3, "a1 a2"), (None, "a1 unseen"), (n + 3, "b1 " * 3000)]


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, trained string")
    return hmm.score_texts(docs, remainder(docs["doc_id"], 10) != 0, states=3, rounds=5, **more)


@pytest.mark.parametrize("held_words", [10, 1000])
def test_base_equals_brute_force_and_states_help(spark, held_words):
    rows = corpus()
    scored, likelihoods = run(spark, rows, held_words=held_words, top_words=held_words, endings=8)
    got = sorted([tuple(r) for r in scored.collect()], key=str)
    want = sorted(brute_base(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert math.isfinite(g[6]) and g[6] < 0
    assert all(b > a - 1e-6 for a, b in zip(likelihoods, likelihoods[1:]))
    if held_words == 1000:
        out = [g for g in got if g[1] and g[2] > 5]
        assert sum(g[6] for g in out) > sum(g[5] for g in out)


def test_forward_equals_the_sum_over_paths():
    rnd = np.random.default_rng(3)
    model = hmm._normal(rnd.random(3), rnd.random((3, 3)), rnd.random((5, 3)), np.ones(5))
    texts = [rnd.integers(0, 5, n).astype(np.int16) for n in (1, 4, 0, 6, 2)]
    for text, got in zip(texts, model.log10_likelihood(texts), strict=True):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = 1.0
            for t, k in enumerate(path):
                p *= (model.start[k] if not t else model.move[path[t - 1], k]) * model.emit[text[t], k]
            total += p
        assert got == pytest.approx(math.log10(total) if len(text) else 0.0)


def test_expected_counts_equal_the_sum_over_paths():
    rnd = np.random.default_rng(4)
    model = hmm._normal(rnd.random(2), rnd.random((2, 2)), rnd.random((3, 2)), np.ones(3))
    texts = [np.array(x, np.int16) for x in ([0, 2, 1, 1], [2], [1, 0])]
    got = {"log10": np.zeros(1), "start": np.zeros(2), "move": np.zeros((2, 2)), "emit": np.zeros((3, 2))}
    hmm._expected(model, texts, got)
    want = {k: np.zeros_like(v) for k, v in got.items()}
    for text in texts:
        weights = {}
        for path in itertools.product(range(2), repeat=len(text)):
            p = 1.0
            for t, k in enumerate(path):
                p *= (model.start[k] if not t else model.move[path[t - 1], k]) * model.emit[text[t], k]
            weights[path] = p
        total = sum(weights.values())
        want["log10"] += math.log10(total)
        for path, p in weights.items():
            want["start"][path[0]] += p / total
            for t, k in enumerate(path):
                want["emit"][text[t], k] += p / total
                if t:
                    want["move"][path[t - 1], k] += p / total
    for k in got:
        assert np.allclose(got[k], want[k])


def test_probabilities_of_one_token_texts_sum_to_one(spark):
    """Every known word and one unknown word per ending, followed by the end, and the end alone: all texts of up to one word."""
    rows = [(i, t) for i, t in enumerate(["aa bb cc", "aa aa", "dd", "", "bb dd aa", "ee"] * 3)]
    known = sorted({w.decode() for _, t in rows for w in tokens(t) if w})
    docs = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, t boolean")
    words = known + [next(f"u{k}" for k in range(999) if zlib.crc32(f"u{k}".encode()) % 2 == e) for e in range(2)]
    probe = spark.createDataFrame([(100 + i, w, False) for i, w in enumerate([*words, ""])], "doc_id long, text string, t boolean")
    both = docs.union(probe)
    scored, _ = hmm.score_texts(both, both["t"], states=1, rounds=1, endings=2, top_words=2, held_words=3)
    one = {r.doc_id - 100: 10**r.score for r in scored.collect() if r.doc_id >= 100}
    end = one[len(words)]
    assert sum(one[i] for i in range(len(words))) == pytest.approx((1 - end) * end, rel=1e-6)


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    scored, _ = hmm.score_texts(docs, docs["doc_id"] > 5, states=2, rounds=2)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored.collect()) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    none = docs.limit(0)
    assert hmm.score_texts(none, none["doc_id"] > 0, states=2, rounds=1)[0].collect() == []


def test_long_texts_are_one_sequence(spark):
    """A round over texts of several stretches gives the model of whole texts: transitions everywhere, starts only at their first tokens."""
    rnd = np.random.default_rng(5)
    model = hmm._normal(rnd.random(3), rnd.random((3, 3)), rnd.random((6, 3)), np.ones(6))
    texts = [rnd.integers(0, 6, n).astype(np.int16) for n in (3 * hmm.SPAN + 7, 2 * hmm.SPAN, hmm.SPAN + 1, 5, 1)]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for text in texts:
        a, b = [model.start * model.emit[text[0]]], [np.ones(3)]
        for s in text[1:]:
            a.append(a[-1] / a[-1].sum() @ model.move * model.emit[s])
        for s in text[:0:-1]:
            x = model.move @ (model.emit[s] * b[-1])
            b.append(x / x.sum())
        b.reverse()
        for t, s in enumerate(text):
            g = a[t] * b[t] / (a[t] @ b[t])
            emit[s] += g
            start += g * (t == 0)
            if t:
                x = a[t - 1][:, None] * model.move * model.emit[s] * b[t]
                move += x / x.sum()
    encoded = spark.createDataFrame([(len(x), bytearray(x.tobytes())) for x in texts], "n_tokens long, symbols binary")
    got, _ = hmm._one_round(encoded, model)
    want = hmm._normal(start, move, emit, model.emit @ np.full(3, 1 / 3))
    for k in ("start", "move", "emit"):
        assert np.allclose(getattr(got, k), getattr(want, k))
