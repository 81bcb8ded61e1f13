import hashlib
import random

import pytest

from millrace.llm import anchors, passages

NULL = -(1 << 63)


def brute(rows, length):
    order = sorted(range(len(rows)), key=lambda i: NULL if rows[i][0] is None else rows[i][0])
    seen, out, held, last = set(), [], set(), None
    for k in order:
        doc_id, text = rows[k]
        if doc_id != last or not out:
            seen |= held
            held, last = set(), doc_id
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            held.add(window)
            if window in seen:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def answer(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, hash int, whole string").repartition(3)
    return sorted([tuple(r) for r in passages.report(passages.remove_passages(docs, **more)).collect()], key=str)


def corpus(seed):
    rnd = random.Random(seed)
    block = [rnd.choice(["the", "of", "é", "big", "x"]) for _ in range(40)]
    rows = []
    for i in range(150):
        own = [rnd.choice(["a", "b", "c", "of", "the", f"w{i}"]) for _ in range(rnd.randint(0, 30))]
        kind = i % 5
        if kind == 0:
            own = own + block[rnd.randint(0, 20) : rnd.randint(20, 40)] + own
        elif kind == 1:
            own = block
        elif kind == 2:
            own = own[:3] * 10
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(own)))
    return rows + [(200, None), (201, ""), (None, " ".join(block)), (7, " ".join(block[5:])), (7, " ".join(block)), (7, " ".join(block)), (300, "of " * 500)]


@pytest.mark.parametrize("chunk", [5, 1_500_000])
def test_equals_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK", chunk)
    monkeypatch.setattr(passages, "CHUNK", chunk)
    rows = corpus(chunk)
    want = brute(rows, 6)
    assert answer(spark, rows, length=6, seed=2) == want
    assert sum(r[2] for r in want) > 500


def test_long_text_clean_documents_and_empty_table(spark):
    rnd = random.Random(1)
    long = [f"w{rnd.randint(0, 10**9)}" for _ in range(100_000)]
    rows = [(1, " ".join(long)), (2, "intro " + " ".join(long[500:560]) + " outro"), (3, " ".join(long[:12]))]
    got = answer(spark, rows)
    assert got == brute(rows, 13)
    assert [r[2] for r in got] == [0, 60, 0]
    assert answer(spark, []) == []


def test_kept_text_and_spans(spark):
    rows = [(1, "a b c d e f g"), (2, "x  b c d e\ny")]
    got = passages.remove_passages(spark.createDataFrame(rows, "doc_id long, text string"), length=4, seed=2).collect()
    by = {r.doc_id: r for r in got}
    assert by[2].kept_text == "x y" and [tuple(s) for s in by[2].removed_spans] == [(1, 5)]
    assert by[1].kept_text == "a b c d e f g" and by[1].removed_spans == []
