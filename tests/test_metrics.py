import pytest

from millrace.operators import charts, metrics
from millrace.operators.metrics import LABELS, class_metrics, confusion_matrix, cost_score, pair_counts, scores

F, R, N = LABELS


@pytest.fixture
def perfect(frame):
    return frame([(c, c) for c in LABELS for _ in range(30)], "y string, prediction string", 4)


@pytest.fixture
def all_functional(frame):
    return frame([(c, F) for c in LABELS for _ in range(30)], "y string, prediction string", 4)


def test_perfect(perfect):
    got = scores(pair_counts(perfect, "y"))
    assert got["accuracy"] == got["f1_macro"] == got["f1_weighted"] == 1.0
    assert all(v["precision"] == v["recall"] == v["f1"] == 1.0 for v in got["per_class"].values())
    assert cost_score(perfect, "y") == 0.0


def test_one_answer_only(all_functional):
    got = scores(pair_counts(all_functional, "y"))
    assert got["accuracy"] == pytest.approx(1 / 3)
    assert got["f1_macro"] == pytest.approx(0.5 / 3)
    assert got["per_class"][R] == {"precision": 0.0, "recall": 0.0, "f1": 0.0, "support": 30}
    assert cost_score(all_functional, "y") == 30 * 2 + 30 * 5


def test_absent_class_counts_in_the_macro_mean(frame):
    df = frame([(F, F), (N, N)], "y string, prediction string")
    got = scores(pair_counts(df, "y"))
    assert got["f1_macro"] == pytest.approx(2 / 3)
    assert got["f1_weighted"] == 1.0


def test_confusion(perfect, all_functional, frame):
    assert [tuple(r) for r in confusion_matrix(pair_counts(perfect, "y")).collect()] == [(F, 30, 0, 0), (R, 0, 30, 0), (N, 0, 0, 30)]
    other = frame([("x", F), (F, "x"), (F, R)], "y string, prediction string")
    got = confusion_matrix(pair_counts(other, "y"))
    assert got.columns == ["true_label", *LABELS]
    assert tuple(got.first()) == (F, 0, 1, 0)


def test_costs(frame):
    assert cost_score(frame([(N, F)], "y string, prediction string"), "y") == 5.0
    flat = [[0.0, 1.0], [1.0, 0.0]]
    assert cost_score(frame([("a", "b"), ("a", "a")], "y string, prediction string"), "y", labels=["a", "b"], costs=flat) == 1.0
    with pytest.raises(ValueError, match="without a cost"):
        cost_score(frame([("x", F)], "y string, prediction string"), "y")


def test_class_metrics_rows(all_functional):
    got = {r["label"]: r.asDict() for r in class_metrics(pair_counts(all_functional, "y")).collect()}
    assert got[F]["recall"] == 1.0 and got[F]["precision"] == pytest.approx(1 / 3)
    assert [r["label"] for r in class_metrics(pair_counts(all_functional, "y")).collect()] == LABELS


def test_chart_tables(spark, frame):
    df = frame([(F, F), (F, R), (N, N), ("x", F)], "y string, prediction string")
    shares = [(r["label"], r["count"], r["pct"]) for r in charts.class_shares(df, "y").collect()]
    assert shares == [(F, 2, 0.5), (N, 1, 0.25)]
    counts = pair_counts(df, "y")
    norm = [tuple(r) for r in charts.confusion_shares(counts).collect()]
    assert norm == [(F, 0.5, 0.5, 0.0), (R, None, None, None), (N, 0.0, 0.0, 1.0)]
    assert charts.class_metrics_long(counts).count() == 9
    assert {(r["true_label"], r["predicted"]): r["cost"] for r in charts.cost_table(spark).collect()}[N, F] == 5.0
    comparison = charts.model_comparison(spark, {"m": {"accuracy": 0.5, "f1_macro": 0.25, "other": 1}})
    assert [tuple(r) for r in comparison.collect()] == [("m", "accuracy", 0.5), ("m", "f1_macro", 0.25)]
    top = charts.top_importances(spark, {"a": 0.1, "b": 0.7, "c": 0.2}, 2)
    assert [tuple(r) for r in top.collect()] == [("b", 0.7), ("c", 0.2)]


def test_many_classes(frame):
    rows = [(i % 150, (i + (i % 7 == 0)) % 150) for i in range(6000)]
    df = frame(rows, "y long, prediction long")
    got = scores(pair_counts(df, "y"), list(range(150)))
    assert got["accuracy"] == sum(a == b for a, b in rows) / len(rows)


def test_only_rows_per_class_reach_the_driver(frame, monkeypatch):
    """2,000 pairs of 100 classes, one of them a null label: 101 rows are collected; more classes than allowed are refused."""
    rows = [(i % 100 if i % 50 else None, (i * 7 + i // 100) % 100) for i in range(2_000)]
    df = frame(rows, "y long, prediction int", 3)
    got = metrics._sums(pair_counts(df, "y"), list(range(100)))
    assert len(got) == 101
    assert sum(s.support for s in got.values()) == sum(s.claimed for s in got.values()) == 2_000
    assert scores(pair_counts(df, "y"), list(range(100)))["accuracy"] == sum(a == b for a, b in rows) / 2_000
    monkeypatch.setattr(metrics, "MAX_CLASSES", 50)
    with pytest.raises(ValueError, match="more than 50 classes"):
        scores(pair_counts(df, "y"), [1])
