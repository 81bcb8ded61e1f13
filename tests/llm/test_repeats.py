import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import repeats

NULL = -(1 << 63)


def brute(rows, length):
    """Rows in the order that the operator defines; equal rows are one."""
    texts = sorted({(NULL if i is None else i, repeats_hash(t or ""), t or "") for i, t in rows})
    seen, out = set(), {}
    for key, _, text in texts:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[(key, text)] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return sorted([(i, *out[(NULL if i is None else i, t or "")]) for i, t in rows], key=str)


def repeats_hash(text):
    return HASHES[text]


HASHES = {}


def answer(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, kept string")
    for r in docs.selectExpr("coalesce(text, '') AS t", "xxhash64(coalesce(text, '')) AS h").collect():
        HASHES[r.t] = r.h
    got = repeats.report(repeats.remove_repeats(docs.repartition(3), **more)).collect()
    return sorted([tuple(r) for r in got], key=str)


def corpus(seed):
    rnd = random.Random(seed)
    block = "".join(rnd.choice("abc é") for _ in range(60))
    rows = []
    for i in range(120):
        kind = i % 6
        own = "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 60)))
        if kind == 0:
            text = own + block[rnd.randint(0, 30) : rnd.randint(30, 60)] + own[::-1]
        elif kind == 1:
            text = own[: rnd.randint(0, 9)] * rnd.randint(0, 12)
        elif kind == 2:
            text = block
        elif kind == 3:
            k = rnd.randint(0, 59)
            text = block[:k] + "Z" + block[k + 1 :]
        else:
            text = own
        rows.append((i, text))
    return rows + [(200, None), (201, ""), (None, block), (None, own), (7, block + "tail"), (7, block + "tail"), (300, "ab" * 300)]


@pytest.mark.parametrize("hot", [1, 10_000])
def test_equals_brute_force(spark, hot):
    rows = corpus(hot)
    want = brute_after(spark, rows, hot=hot)
    assert sum(r[2] for r in want) > 1000


def brute_after(spark, rows, length=12, gram=5, **more):
    got = answer(spark, rows, length=length, gram=gram, **more)
    want = brute(rows, length)
    assert got == want
    return want


def test_small_chunks_long_text_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_CHUNK", 7)
    brute_after(spark, corpus(3))
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcdefghijklmnop") for _ in range(200_000))
    brute_after(spark, [(1, long), (2, "x" + long[5000:9000] + "y"), (3, "qrst" * 20_000)], length=100, gram=40)
    assert answer(spark, [], length=100, gram=40) == []


def test_pieces_of_long_texts_overlap(monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 50)
    rnd = random.Random(2)
    text = bytes(rnd.choice(b"abcd") for _ in range(400))
    whole = {(int(h), int(p)) for h, _, p in zip(*repeats.byte_anchors([text], 12, 5))}
    monkeypatch.setattr(repeats, "_PIECE", 4 << 20)
    assert whole == {(int(h), int(p)) for h, _, p in zip(*repeats.byte_anchors([text], 12, 5))}


@pytest.mark.parametrize("gram", [1, 4, 5, 7, 24, 31])
def test_gram_hashes_depend_on_the_gram_only(gram):
    rnd = random.Random(gram)
    text = bytes(rnd.choice(b"ab") for _ in range(300))
    h = repeats._rolled(np.frombuffer(text, np.uint8), gram)
    assert len(h) == 300 - gram + 1
    by = defaultdict(set)
    for i, x in enumerate(h.tolist()):
        by[text[i : i + gram]].add(x)
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def test_intervals_and_groups_equal_plain_definitions():
    rnd = random.Random(5)
    for _ in range(60):
        lcp = [0] + [rnd.randint(0, 4) for _ in range(rnd.randint(0, 12))]
        want = set()
        for a in range(len(lcp)):
            for b in range(a + 1, len(lcp)):
                d = min(lcp[a + 1 : b + 1])
                if d >= 1 and (a == 0 or lcp[a] < d) and (b + 1 == len(lcp) or lcp[b + 1] < d):
                    want.add((d, a, b))
        assert set(repeats.intervals(lcp, 1)) == want
        pairs = sorted((bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 5))), bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 4)))) for _ in range(8))
        right, left = [p[0] for p in pairs], [p[1] for p in pairs]
        groups = list(repeats.maximal_repeats(right, left, 3))
        together = Counter()
        for e, l, g in groups:
            for i in g:
                assert left[i][:e] == left[g[0]][:e] and right[i][:l] == right[g[0]][:l]
            for x, i in enumerate(sorted(g)):
                for j in sorted(g)[x + 1 :]:
                    together[(i, j)] = max(together[(i, j)], e + l)
        for i in range(8):
            for j in range(i + 1, 8):
                n = repeats.common(right[i], right[j]) + repeats.common(left[i], left[j])
                if repeats.common(right[i], right[j]) and n >= 3:
                    assert together[(i, j)] == n


def test_groups_have_all_occurrences(spark):
    shared = "the passage that three documents share word for word "
    rows = [(1, "aaa " + shared + "bbb"), (2, "ccc " + shared + "ddd"), (3, "eee " + shared + "ddd"), (4, "nothing")]
    found = []
    for partitions in (1, 4, 64):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(min(partitions, 4))
        found.append(sorted(tuple(r) for r in repeats.find_repeats(docs, length=20, gram=8).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert found[0] == found[1] == found[2]
    got = repeats.find_repeats(docs, length=20, gram=8).collect()
    by = defaultdict(list)
    for r in got:
        by[(r.repeat, r.length)].append(r)
    assert frozenset({1, 2, 3}) in {frozenset(r.key for r in v) for v in by.values()}
    assert frozenset({2, 3}) in {frozenset(r.key for r in v) for v in by.values()}
    texts = {i: t.encode() for i, t in rows}
    for v in by.values():
        assert len(v) > 1 and len({texts[r.key][r.start : r.start + r.length] for r in v}) == 1
        assert sum(r.first for r in v) == 1 and min(v, key=lambda r: (r.key, r.start)).first


def test_groups_of_hard_rows(spark):
    """Nulls, empty and repeated rows, a shared id, a long text and columns with clashing names; and no rows at all."""
    text = "a passage of some length that comes back "
    rows = [(1, text + "x"), (1, text + "x"), (1, "y " + text), (None, text), (2, None), (3, ""), (4, "short"), (5, "".join(f"{i} " for i in range(9_000)) + text)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, repeat int, th string").repartition(3)
    got = repeats.find_repeats(docs, length=20, gram=8).collect()
    assert {r.key for r in got} == {1, 5, -(1 << 63)} and all(r.length >= 20 for r in got)
    # strings reach 12 bytes before their anchor and 20 from it
    assert max(r.length for r in got) == 32 and len({(r.key, r.th) for r in got}) == 4
    assert repeats.find_repeats(docs.limit(0), length=20, gram=8).collect() == []


def test_buckets_of_frequent_anchors_are_dealt_by_string(spark, monkeypatch):
    """A phrase in 300 different contexts: no bucket holds more suffixes than ``hot``, the bytes that go stay the same."""
    rnd = random.Random(9)
    own = ["".join(rnd.choice("abcdefgh") for _ in range(40)) for _ in range(300)]
    rows = [(i, o[:20] + "the phrase" + o[20:]) for i, o in enumerate(own)] + [(400 + i, own[i][11:20] + "the phrase" + own[i][20:29]) for i in range(9)]
    seen = []
    searched = repeats._suffixes
    monkeypatch.setattr(repeats, "_suffixes", lambda *a: seen.append(searched(*a)) or seen[-1])
    want = brute_after(spark, rows, length=16, gram=8, hot=20)
    assert sum(r[2] for r in want) > 9 * 16
    sizes = [r["count"] for r in seen[0].where("sure <= 0").groupBy("h").count().collect()]
    assert len(sizes) > 300 and max(sizes) <= 20


@pytest.mark.parametrize("partitions", [1, 7])
def test_groups_keep_the_copies_that_a_chunk_settles(spark, partitions):
    """Many copies of a text, and a part of it elsewhere: each group has every place where its string stands."""
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdefgh") for _ in range(60))
    rows = [(i, text) for i in range(40)] + [(50, "Z" + text[10:45] + "Y"), (51, text + text), (60, "only here, and nowhere else at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = [r for r in repeats.find_repeats(docs, length=20, gram=8).collect() if r.repeat]
    texts = dict(rows)
    by = defaultdict(list)
    for r in got:
        by[(r.repeat, r.length)].append(r)
    for v in by.values():
        string = texts[v[0].key][v[0].start : v[0].start + v[0].length]
        want = sorted((i, m.start()) for i, t in rows for m in re.finditer(f"(?={string})", t))
        assert sorted((r.key, r.start) for r in v) == want
        assert [(r.key, r.start) for r in v if r.first] == want[:1]
    assert {51} | set(range(40)) in [{r.key for r in v} for v in by.values()]
    assert {50, 51} | set(range(40)) in [{r.key for r in v} for v in by.values()]
