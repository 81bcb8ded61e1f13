import hashlib
import logging
import math
from collections import Counter

import pytest

from millrace.operators.split import hash_thresholds, row_hash, split_summary, stratified_split, test_quotas as quotas, with_folds


def rows(n=1000):
    # one class fills about a third, one is rare
    return [(i, "a" if i % 3 == 0 else "b" if i % 50 else "rare") for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_split_is_exact_and_independent_of_partitions(frame, partitions):
    data = rows()
    df = frame(data, "id long, y string", partitions)
    train, test = stratified_split(df, "id", "y", test_size=0.2, seed=42)
    got = {r["id"] for r in test.collect()}
    wanted = quotas(sorted(Counter(y for _, y in data).items()), 0.2)
    assert sum(wanted.values()) == math.ceil(len(data) * 0.2)
    want = set()
    for c, q in wanted.items():
        ordered = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, y in data if y == c)
        want |= {i for _, i in ordered[:q]}
    assert got == want
    assert got | {r["id"] for r in train.collect()} == {i for i, _ in data}


def test_split_never_loses_unlabelled_rows_silently_and_checks_size(frame, caplog):
    df = frame([(1, "a"), (2, "a"), (3, None), (4, "a"), (5, "a")], "id long, y string")
    with pytest.raises(ValueError, match="1 rows have no 'y'"):
        stratified_split(df, "id", "y", test_size=0.25)
    with caplog.at_level(logging.WARNING, logger="millrace.operators.split"):
        train, test = stratified_split(df, "id", "y", test_size=0.25, unlabelled="leave out")
    assert "1 rows have no 'y'" in caplog.text
    assert (train.count(), test.count()) == (3, 1)
    with pytest.raises(ValueError):
        stratified_split(df, "id", "y", test_size=1.0)


def test_seeds_differ(frame):
    df = frame(rows(200), "id long, y string")
    ids = [frozenset(r["id"] for r in stratified_split(df, "id", "y", seed=s)[1].collect()) for s in (1, 2)]
    assert ids[0] != ids[1]


def test_quotas_take_the_largest_remainders():
    assert quotas([("a", 5), ("b", 5), ("c", 4)], 0.2) == {"a": 1, "b": 1, "c": 1}
    assert quotas([("a", 10)], 0.25) == {"a": 3}
    assert quotas([], 0.2) == {}


def test_thresholds_found_over_several_passes(frame):
    data = rows(3000)
    df = frame(data, "id long, y string", 4)
    ranks = [("a", 1), ("a", 500), ("b", 77), ("b", 78), ("rare", 40)]
    got = hash_thresholds(df, "y", row_hash("id", 7), ranks, listed_rows=5)
    for c, r in ranks:
        ordered = sorted(hashlib.md5(f"{i}:7".encode()).hexdigest() for i, y in data if y == c)
        assert got[c, r] == ordered[r - 1]


@pytest.mark.parametrize("partitions", [1, 7])
def test_folds(frame, partitions):
    data = rows(503)
    folded = with_folds(frame(data, "id long, y string", partitions), "id", "y", n_splits=5).collect()
    assert {r["fold"] for r in folded} == set(range(5))
    for c in ("a", "b", "rare"):
        sizes = Counter(r["fold"] for r in folded if r["y"] == c)
        assert max(sizes.values()) - min(sizes.get(f, 0) for f in range(5)) <= 1
    with pytest.raises(ValueError):
        with_folds(frame(data, "id long, y string"), "id", "y", n_splits=1)


def test_numeric_labels(frame):
    df = frame([(i, i % 3) for i in range(30)], "id long, y int")
    train, test = stratified_split(df, "id", "y", test_size=0.2)
    summary = {r["label"]: (r["n_train"], r["n_test"], r["pct_test"]) for r in split_summary(train, test, "y").collect()}
    assert summary == {c: (8, 2, pytest.approx(1 / 3)) for c in range(3)}


def test_thresholds_end_when_many_rows_share_an_id(frame):
    df = frame([(1, "a")] * 50 + [(2, "a")] * 50, "id long, y string")
    got = hash_thresholds(df, "y", row_hash("id", 1), [("a", 10), ("a", 90)], listed_rows=5)
    hashes = sorted(hashlib.md5(f"{i}:1".encode()).hexdigest() for i in (1, 2))
    assert got == {("a", 10): hashes[0], ("a", 90): hashes[1]}
