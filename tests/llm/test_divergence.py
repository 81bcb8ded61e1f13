import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"


def plain(rows, min_docs):
    """The same by dicts and Python's whole numbers."""
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        seen[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang, df in seen.items():
        kept = [t for t, n in df.items() if n >= min_docs]
        groups = {s: c for (k, s), c in counts.items() if k == lang}

        def share(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = sum(groups.values(), Counter())
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            own = [
                (-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]
            ]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(own)[:10])]
    return sorted(out)


def corpus(seed, n=200):
    rnd = random.Random(seed)
    terms = [f"{a}{b}" for a in ("Wort", "mot", "ünï", "𝒳", "x") for b in "abcdefgh"]
    rows = []
    for _ in range(n):
        k = int(rnd.paretovariate(0.6)) % 60
        text = rnd.choice([" ", ", ", "_1"]).join(rnd.choice(terms[: rnd.choice([5, 20, 40])]) for _ in range(k))
        rows.append((text, rnd.choice(["en", "de", None]), rnd.choice([f"s{i}" for i in range(7)] + ["hot"] * 6)))
    return rows + [(None, "en", "s1"), ("", "fr", "only"), ("7 42 ...", "it", "a"), ("", "it", "b"), (None, None, None), rows[0], rows[0]]


def answer(spark, rows, **more):
    docs = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in divergence.source_divergence(docs, **more).collect())


@pytest.mark.parametrize("block", [1_000, 4])
def test_equals_plain_counting(spark, block, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = corpus(block)
    want = plain(rows, 10)
    assert answer(spark, rows) == want
    assert {r[2] for r in want} == {"pair", "term"} and ("it", "a", "pair", "b", 0, 1) in want


def test_columns_by_name_and_empty_table(spark):
    docs = spark.createDataFrame([("a b", 1, "p"), ("b c", 1, "q")], "body string, kind int, site string")
    got = divergence.source_divergence(docs, 1, "kind", "site", "body").collect()
    assert sorted(map(tuple, got)) == plain([("a b", "1", "p"), ("b c", "1", "q")], 1)
    assert answer(spark, []) == []


def test_spilled_and_merged_stripes_are_the_whole_counts(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    rows = [((t or ""), g or "", s or "") for t, g, s in corpus(3, 60)]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*[(g, s, t) for t, g, s in rows], strict=True)], names=["lang", "source", "text"])
    spilled = list(divergence._fold([batch]))
    assert len(spilled) > 5
    every = pa.Table.from_batches(spilled).sort_by([("lang", "ascending"), ("term", "ascending")]).combine_chunks().to_batches()[0]
    merged = list(divergence._merge(1)(iter(every.slice(a, 7) for a in range(0, every.num_rows, 7))))
    got = {(r["lang"], r["term"]): (r["df"], dict(zip(r["sources"], r["counts"], strict=True))) for b in merged for r in b.to_pylist()}
    want = defaultdict(lambda: [0, Counter()])
    for text, lang, source in rows:
        terms = [t.decode() for part in divergence.terms_of(text.encode()) for t in part]
        for t in set(terms):
            want[lang, t][0] += 1
        for t in terms:
            want[lang, t][1][source] += 1
    assert got == {k: (n, dict(c)) for k, (n, c) in want.items()}


def test_pieces_of_a_long_text_cut_no_term(monkeypatch):
    text = ("Übung macht den " + "M" * 100 + "eister 3 ") * 20
    whole = [t for part in divergence.terms_of(text.encode()) for t in part]
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert [t for part in divergence.terms_of(text.encode()) for t in part] == whole
    assert whole[0].decode() == "Übung"


def test_shares_of_large_counts_are_exact():
    counts = [0, 1, 7, 10**12, 4 * 10**15]
    got = divergence.share(np.array(counts), np.int64(4 * 10**15), 3)
    assert got.tolist() == [1 + 10**9 * (c + 2) // (4 * 10**15 + 6) for c in counts]
