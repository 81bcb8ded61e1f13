import random
from collections import defaultdict

from millrace.llm import lines

SPACE = " \t\r\x0b\x0c"


def brute(rows, min_sites):
    sites, first = defaultdict(set), {}
    for doc_id, text, site in rows:
        for i, line in enumerate((text or "").split("\n")):
            key = line.strip(SPACE)
            if key:
                if site is not None:
                    sites[key].add(site)
                at = (doc_id is not None, doc_id or 0, i)
                first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, text, _ in rows:
        kept, n, gone = [], 0, 0
        for i, line in enumerate((text or "").split("\n")):
            key = line.strip(SPACE)
            n += bool(key)
            if key and len(sites[key]) >= min_sites and first[key] != (doc_id is not None, doc_id or 0, i):
                gone += 1
            else:
                kept.append(line)
        out.append((doc_id, n, gone, "\n".join(kept) if gone else text))
    return sorted(out, key=str)


def answer(spark, rows, min_sites):
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, source string, n_lines string, gone int")
    got = lines.remove_spread_lines(docs, min_sites)
    return sorted([(r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in got.collect()], key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    some = [f"line {i}" for i in range(30)] + ["", "  ", " line 1\t", "line 2\r"]
    rows = []
    for i in range(150):
        body = [rnd.choice(some) if rnd.random() < 0.8 else f"own {i} {j}" for j in range(rnd.randint(0, 12))]
        rows.append((i, "\n".join(body), rnd.choice([None, *[f"s{k}" for k in range(14)]])))
    rows += [(200, None, "s1"), (201, "", "s2"), (None, "line 1\nline 3", "s3"), (7, "line 1\nown", "s4"), (7, "line 1\nown", "s4"), (7, "own\nline 1", "s5")]
    for least in (2, 9, 12):
        want = brute(rows, least)
        assert answer(spark, rows, least) == want
        assert any(r[2] for r in want)


def test_many_sites_and_hot_line(spark):
    rows = [(i, f"spread\nown {i}\nclose {i % 40}", f"site {i // 3}") for i in range(900)]
    want = brute(rows, 100)
    assert answer(spark, rows, 100) == want
    assert sum(r[2] for r in want) == 899


def test_long_text_and_empty_table(spark):
    long = "\n".join(["same"] * 30_000 + [f"l{i}" for i in range(30_000)])
    rows = [(1, long, "a"), (2, "same\nother", "b")]
    assert answer(spark, rows, 2) == brute(rows, 2)
    assert answer(spark, [], 2) == []
