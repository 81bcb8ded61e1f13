import math
import random
from collections import Counter

import duckdb
import pandas as pd
import pytest

from millrace.functions.correlation import all_pairs, average_ranks, correlations, gap_patterns, rankings, spearman
from millrace.functions import correlation as correlation_module
from millrace.functions.columns import col
from millrace.operators import profile as p
from millrace.operators import profile_diff as d
from millrace.plans.jobs import profile_diff


def by_column(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture
def mixed(frame):
    rows = [
        (1, 0.0, "a", "12", "yes", "2013-01-01", 1, 5.0, True),
        (2, 1.5, "b", "1e3", "No", "2014-02-03", 0, 6.0, False),
        (3, None, "a", " 7 ", "T", "2015-02-03", 1, None, None),
        (4, float("nan"), None, None, "f", None, 1, 8.0, True),
    ]
    return frame(
        rows, "id long, x double, t string, num string, flag string, day string, bit int, whole double, b boolean", 3
    )


def test_missing(mixed):
    out = by_column(p.missing_summary(mixed))
    assert out["x"] == {"column": "x", "n_missing": 2, "pct_missing": 0.5, "pct_zero": 0.25, "dtype": "double"}
    assert out["t"]["pct_zero"] is None and out["t"]["pct_missing"] == 0.25
    assert out["bit"]["pct_zero"] == 0.25
    assert p.missing_summary(mixed).first()["column"] == "x"
    assert [r["column"] for r in p.top_missing(p.missing_summary(mixed), 2).collect()] == ["x", "b"]


def test_cardinality(mixed):
    out = by_column(p.cardinality_report(mixed, max_cats=3))
    assert out["t"] == {
        "column": "t", "dtype": "string", "n_unique": 2, "top_value": "a", "top_freq": 2, "top_pct": 0.5,
        "suggested_encoding": "binary",
    }
    assert out["x"]["n_unique"] == 2 and out["x"]["top_value"] == "0.0"
    assert out["flag"]["suggested_encoding"] == "target_encode"
    assert out["num"]["suggested_encoding"] == "onehot"
    assert out["bit"]["suggested_encoding"] == "numeric"
    assert out["b"]["suggested_encoding"] == "binary"
    assert [r["column"] for r in p.high_cardinality(p.cardinality_report(mixed, 3)).collect()] == ["flag"]


def test_cardinality_of_constant_and_empty_columns(frame):
    out = by_column(p.cardinality_report(frame([("k", None), ("k", None)], "c string, e string")))
    assert out["c"]["suggested_encoding"] == "drop"
    assert (out["e"]["n_unique"], out["e"]["top_value"], out["e"]["top_freq"]) == (0, None, 0)
    assert out["e"]["suggested_encoding"] == "onehot"


def test_cardinality_estimate(frame):
    out = by_column(p.cardinality_report(frame([(str(i % 40),) for i in range(400)], "c string"), approx=True))
    assert abs(out["c"]["n_unique"] - 40) <= 3


def test_dtypes(mixed):
    out = {k: v["suspected_dtype"] for k, v in by_column(p.dtype_audit(mixed)).items()}
    assert out == {
        "id": None,
        "x": None,
        "t": None,
        "num": "float64 or int64",
        "flag": "bool",
        "day": "datetime64",
        "bit": "bool",
        "whole": "int64 (no fractional part)",
        "b": None,
    }


def test_all_null_columns_are_not_flagged(frame):
    out = by_column(p.dtype_audit(frame([(None, None, None)], "a string, b int, c double")))
    assert not any(r["flagged"] for r in out.values())


@pytest.mark.parametrize("partitions", [1, 7])
def test_distribution_matches_pandas(frame, partitions):
    data = pd.DataFrame({"a": [1.0, 2.0, 2.5, 9.0, 4.0, None], "b": [3.0] * 6, "c": [1.0, 2.0, None, None, None, None]})
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in data.itertuples(index=False)]
    out = by_column(p.distribution_summary(frame(rows, "a double, b double, c double", partitions)))
    desc = data.describe()
    for c in "abc":
        got = out[c]
        assert got["count"] == desc[c]["count"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("median", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[mine] == pytest.approx(desc[c][theirs])
        for mine, theirs in (("skew", data[c].skew()), ("kurtosis", data[c].kurtosis())):
            assert got[mine] is None if math.isnan(theirs) else got[mine] == pytest.approx(theirs)


def test_label_distribution(frame):
    out = p.label_distribution(frame([("a",), ("a",), (None,), ("b",)], "y string"), "y").collect()
    assert [tuple(r) for r in out] == [("a", 2, 0.5), (None, 1, 0.25), ("b", 1, 0.25)]


def test_redundancy(frame):
    df = frame([(float(i), 2.0 * i, -3.0 * i, 1.0, "t") for i in range(10)], "a double, b double, c double, k double, t string")
    out = [tuple(r) for r in p.redundancy_report(df).collect()]
    assert [(a, b) for a, b, _ in out] == [("a", "b"), ("a", "c"), ("b", "c")]
    assert [r for *_, r in out] == pytest.approx([1.0, -1.0, -1.0])
    empty = p.redundancy_report(df.select("a", "k"))
    assert empty.columns == ["col_a", "col_b", "correlation"] and empty.count() == 0


@pytest.fixture(scope="module")
def gaps():
    data = pd.DataFrame({"a": range(60)}, dtype=float)
    data["b"] = (data["a"] * 37 % 11) - 5
    data["c"] = data["a"] ** 2
    data["d"] = 4.0
    data["e"] = data["a"] * 53 % 29
    data.loc[data["a"] % 7 == 0, "b"] = None
    data.loc[data["a"] % 5 == 1, "c"] = None
    return data


def spark_rows(data):
    return [(i, *[None if pd.isna(v) else float(v) for v in r]) for i, r in enumerate(data.itertuples(index=False))]


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_correlation_matches_pandas(frame, gaps, method, partitions):
    df = frame(spark_rows(gaps), "id long, a double, b double, c double, d double, e double", partitions)
    want = gaps.corr(method="pearson") if method == "pearson" else None
    for (x, y), r in correlations(df, list("abcde"), method).items():
        if method == "pearson":
            expected = want.loc[x, y]
        else:
            both = gaps[[x, y]].dropna().rank()
            expected = both[x].corr(both[y]) if both[x].nunique() > 1 and both[y].nunique() > 1 else float("nan")
        if math.isnan(expected):
            assert r is None
        else:
            assert r == pytest.approx(expected, abs=1e-9)


def test_correlation_far_from_zero_and_beside_other_columns(frame):
    """A large offset, and rows outside a pair that lie elsewhere; the same with a further column."""
    rows = []
    for i in range(300):
        x = 1e9 + i % 17 + 0.01 * i
        rows.append((x, None if i % 3 == 0 else 2 * x + i % 5, 5.0, -1e12 if i % 3 == 0 else 1e9 + i % 7))
    data = pd.DataFrame(rows, columns=list("abcd"))
    df = frame(rows, "a double, b double, c double, d double", 7)
    whole = correlations(df, list("abcd"), "pearson")
    few = correlations(df, list("ab"), "pearson")
    both = data.dropna(subset=["b"])
    want = (both.a - 1e9).corr(both.b - 2e9)
    assert whole["a", "b"] == pytest.approx(want, abs=1e-8) and few["a", "b"] == pytest.approx(want, abs=1e-8)
    assert whole["b", "d"] == pytest.approx((both.b - 2e9).corr(both.d - 1e9), abs=1e-6)
    assert whole["a", "c"] is None and whole["c", "d"] is None


@pytest.mark.parametrize("limit", [0, 10_000])
def test_spearman_does_not_depend_on_repeated_ids(frame, monkeypatch, limit):
    monkeypatch.setattr(correlation_module, "BROADCAST_BYTES", limit)
    rows = [(i % 20 or None, float(i * 7 % 31), float(i * 11 % 23)) for i in range(400)]
    df = frame(rows, "id long, a double, b double", 5)
    data = pd.DataFrame(rows, columns=["id", "a", "b"]).rank()
    assert correlations(df, ["a", "b"], "spearman")["a", "b"] == pytest.approx(data.a.corr(data.b), abs=1e-9)


def test_ranks_without_broadcast(frame, gaps):
    """The shuffled path, with a value that fills a third of the rows and short buckets."""
    rows = [(i, 5.0 if i % 3 == 0 else float(i * 31 % 97), None if i % 4 == 0 else float(i % 10)) for i in range(600)]
    df = frame(rows, "id long, a double, b double", 5)
    out = average_ranks(df, {"a": col("a"), "b": col("b")}, broadcast_rows=0, rows_per_bucket=20)
    got = out.collect()
    want = pd.DataFrame(rows, columns=["id", "a", "b"])[["a", "b"]].rank()
    for c in "ab":
        assert sorted(r[c] for r in got if r[c] is not None) == pytest.approx(sorted(want[c].dropna()))
    pairs = sorted((r["a"], r["b"] or -1.0) for r in got)
    assert pairs == sorted(zip(want["a"], want["b"].fillna(-1.0)))


def test_profile_agrees_with_the_single_reports(mixed):
    whole = p.profile(mixed, "t", id_col="id")
    df = mixed.drop("id", "t")
    for name, single in (
        ("missing", p.missing_summary(df)),
        ("cardinality", p.cardinality_report(df)),
        ("distribution", p.distribution_summary(df)),
        ("dtype_audit", p.dtype_audit(df)),
        ("redundancy", p.redundancy_report(df)),
    ):
        assert whole[name].collect() == single.collect()
    assert whole["label_distribution"].count() == 3


def test_diffs(frame):
    before = frame([(1, None, "a", 1.0, 1), (2, 2.0, "b", 2.0, 0), (3, 4.0, "a", 3.0, 1)], "id int, x double, t string, z double, bit int")
    after = frame([(1, 3.0, 0.0, 1.0, 9.0), (2, 2.0, 1.0, 2.0, 5.0), (3, 4.0, 0.0, 3.0, 7.0)], "id int, x double, t double, z double, new double")
    b, a = p.profile(before, id_col="id"), p.profile(after, id_col="id")
    diff = d.diff_profiles(b, a)
    missing = by_column(diff["missing"])
    assert missing["x"]["pct_change"] == pytest.approx(-1 / 3)
    assert missing["bit"]["pct_missing_after"] is None and missing["bit"]["pct_change"] is None
    assert diff["missing"].first()["column"] == "x"
    cards = by_column(diff["cardinality"])
    assert cards["t"]["encoding_changed"] and cards["new"]["encoding_changed"] and not cards["x"]["encoding_changed"]
    assert {r["column"] for r in d.changed_encodings(diff["cardinality"]).collect()} == {"t", "new", "bit"}
    assert by_column(diff["distribution"])["z"]["skew_change"] == pytest.approx(0.0)
    flagged = by_column(diff["dtype_audit"])
    assert set(flagged) == {"x", "t", "z", "bit", "new"}
    assert flagged["bit"]["flagged_after"] is None
    assert [r["column"] for r in d.most_changed_missing(diff["missing"]).collect()] == ["x"]


def test_redundancy_diff(frame):
    schema = "col_a string, col_b string, correlation double"
    before = frame([("a", "b", 0.99), ("c", "a", 0.97)], schema)
    after = frame([("b", "a", 0.98), ("d", "a", -0.96)], schema)
    out = {(r["col_a"], r["col_b"]): (r["correlation"], r["status"]) for r in d.diff_redundancy(before, after).collect()}
    assert out == {("a", "b"): (0.99, "unchanged"), ("a", "c"): (0.97, "resolved"), ("a", "d"): (-0.96, "new")}


def test_profile_diff_needs_labels_for_supervised_steps(frame):
    df = frame([(1, "a")], "id int, t string")
    spec = {"name": "s", "preprocessing": [{"type": "target_encoder"}]}
    with pytest.raises(ValueError, match="labels are required"):
        profile_diff(df, spec, label_col=None)


def test_duckdb_agrees_on_moments():
    data = pd.DataFrame({"x": [1.0, 5.0, 2.0, 8.0, 8.0]})
    got = duckdb.sql("select skewness(x), kurtosis(x) from data").fetchall()[0]
    assert got == pytest.approx((data["x"].skew(), data["x"].kurtosis()))


def test_columns_with_gaps_in_the_same_rows_share_rankings(frame):
    rng = random.Random(5)
    rows = [(i, *[rng.random() if (i % (3 + j % 2)) else None for j in range(40)]) for i in range(60)]
    names = [f"c{j}" for j in range(40)]
    df = frame(rows, "id long, " + ", ".join(f"{n} double" for n in names), 3)
    patterns = gap_patterns(df, names)
    assert [patterns[n] for n in names] == ["c0", "c1"] * 20
    assert len(set(rankings(names, patterns).values())) == 80
    few = names[:4]
    data = pd.DataFrame([r[1:5] for r in rows], columns=few).astype(float)
    got = spearman(df.select("id", *few), few)
    for a, b in all_pairs(few):
        both = data[[a, b]].dropna().rank()
        assert got[a, b] == pytest.approx(both[a].corr(both[b]), abs=1e-9)


def test_long_texts_are_counted_by_hash(frame):
    """Ties, heads that many texts share, texts that are the head of others, and what is shuffled does not grow with them."""
    long = "same beginning " * 20
    rows = [(i, t) for i, t in enumerate([long + "b", long + "a", long + "a", long + "b", long, "short", None, long + "c" * 5_000] + ["x" * 64, "x" * 65] * 1)]
    df = frame(rows, "id long, t string", 3)
    for make in (df, df.where("t IS NOT NULL AND length(t) < 70"), df.where("t IS NULL")):
        (row,) = p.cardinality_report(make.select("t")).collect()
        values = [r["t"] for r in make.collect()]
        present = Counter(v for v in values if v is not None)
        want = min(present.items(), key=lambda kv: (-kv[1], kv[0].encode())) if present else (None, 0)
        assert (row["n_unique"], row["top_value"], row["top_freq"]) == (len(present), *want)


def test_dates_and_times_count_by_their_spelling(spark, frame):
    """Values are counted as they are and spelled once each; of two instants with one spelling the rows meet."""
    rows = [(None,)] * 2 + [(x,) for x in (1_572_139_800, 1_572_136_200, 1_572_100_000, 1_572_100_000)]  # Berlin's clock went back in between
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = frame(rows, "s long", 3).selectExpr(
            "timestamp_seconds(s) AS t", "cast(timestamp_seconds(s) AS timestamp_ntz) AS u", "cast(timestamp_seconds(s) AS date) AS d"
        )
        found = {r["column"]: (r["n_unique"], r["top_value"], r["top_freq"]) for r in p.cardinality_report(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {"t": (2, "2019-10-26 16:26:40", 2), "u": (2, "2019-10-26 16:26:40", 2), "d": (2, "2019-10-26", 2)}
