import hashlib
import random

import numpy as np
import pytest

from millrace.llm import fingerprint
from millrace.llm.fingerprint import winnow


def plain(text, gram, window):
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    h = [int(x) >> 32 for x in fingerprint._roll(points, gram)]
    wide, out = min(window, len(h)), []
    for i in range(len(h) - wide + 1):
        least = min(h[i : i + wide])
        at = max(k for k in range(i, i + wide) if h[k] == least)
        if not out or out[-1] != (least, at):
            out.append((least, at))
    return out


@pytest.mark.parametrize("chunk", [1 << 20, 5])
def test_rightmost_smallest_of_each_window(chunk, monkeypatch):
    monkeypatch.setattr(fingerprint, "_CHUNK", chunk)
    rnd = random.Random(1)
    for n in (4, 5, 9, 30, 200):
        for alphabet in ("a", "ab", "abcdé😀"):
            text = "".join(rnd.choice(alphabet) for _ in range(n))
            h, p = winnow(text, 4, 8)
            assert list(zip(h.tolist(), p.tolist(), strict=True)) == plain(text, 4, 8)


def test_long_enough_matches_share_a_gram():
    rnd = random.Random(2)
    for _ in range(200):
        shared = "".join(rnd.choice("abcdefgh") for _ in range(4 + 8 - 1))
        a, b = ("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))) + shared + "".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in "ab")
        (ha, pa), (hb, pb) = winnow(a, 4, 8), winnow(b, 4, 8)
        ga = {(x, a[p : p + 4]) for x, p in zip(ha.tolist(), pa.tolist(), strict=True)}
        gb = {(x, b[p : p + 4]) for x, p in zip(hb.tolist(), pb.tolist(), strict=True)}
        assert ga & gb


def test_short_texts_and_likeness():
    assert len(winnow("")[0]) == 0 and len(winnow("a")[0]) == 1
    assert winnow("a")[0] != winnow("aa")[0] and winnow("ab")[0] != winnow("ba")[0]
    none = winnow("")[0]
    assert fingerprint.likeness(none, none) == 1.0 and fingerprint.likeness(none, winnow("a")[0]) == 0.0
    text = "some words that are long enough " * 20
    assert fingerprint.likeness(winnow(text)[0], winnow(text)[0]) == 1.0


def brute(rows):
    order = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(1 << 63)))
    out = {}
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.written(*winnow(text)), fingerprint.written(*winnow(edited)))
    return out


@pytest.mark.parametrize("run_rows", [1, 7, 1000])
def test_edited_texts_equal_brute_force(spark, run_rows):
    rnd = random.Random(run_rows)
    rows = [(i * 3 - 50, "".join(rnd.choice("ab é😀\n") for _ in range(rnd.choice([0, 1, 5, 400])))) for i in range(60)]
    rows += [(1000, None), (None, "last " * 50), (10_000_000_000, "x" * 300_000)]
    docs = spark.createDataFrame([(*r, "y", 2) for r in rows], "doc_id long, text string, run string, tail int").repartition(5)
    got = fingerprint.edited_fingerprints(docs, run_rows=run_rows).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got} == want
    assert len(got) == len(rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_one_row_repeated_rows_and_none(spark):
    schema = "doc_id long, text string"
    one = fingerprint.edited_fingerprints(spark.createDataFrame([(5, "abcd")], schema)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0
    assert fingerprint.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    twice = fingerprint.edited_fingerprints(spark.createDataFrame([(5, "abcd"), (5, "abcd"), (6, "wxyz")], schema)).collect()
    assert len(twice) == 3
    pairs = fingerprint.fingerprints(spark.createDataFrame([(1, "abc"), (2, None)], schema)).collect()
    assert [(r.n_chars, len(r.hashes), r.places) for r in pairs] == [(3, 1, [0]), (0, 0, [])]
