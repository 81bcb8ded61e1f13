import random

import pytest
from pyspark.ml import PipelineModel

from millrace.operators.models import BoostedTrees, ClassifierModel, LeafLimitedTrees, LogisticClassifier, RandomForest, tree_depth

CLASSES = ["functional", "functional needs repair", "non functional"]
SCHEMA = "id long, a double, b double, c double, d double, y string"
FAST = {
    LogisticClassifier: {"max_iter": 20},
    RandomForest: {"n_estimators": 5, "max_depth": 4},
    BoostedTrees: {"n_estimators": 3, "max_depth": 2},
    LeafLimitedTrees: {"n_estimators": 3, "num_leaves": 4, "min_child_samples": 5},
}


def rows(shift=0.0, n=90):
    rng = random.Random(7)
    return [(i, *[rng.gauss(0, 1) + shift * (i % 3) * (j == 0) for j in range(4)], CLASSES[i % 3]) for i in range(n)]


@pytest.mark.parametrize("kind", list(FAST))
def test_contract(frame, kind, tmp_path):
    df = frame(rows(4.0), SCHEMA, 3)
    model = kind(idCol="id", labelCol="y", **FAST[kind]).fit(df)
    scored = model.transform(df)
    got = scored.collect()
    assert len(got) == 90
    assert {r["prediction"] for r in got} <= set(CLASSES)
    assert all(len(r["probability"]) == 3 and abs(sum(r["probability"]) - 1) < 1e-6 for r in got)
    assert all(model.classes[max(range(3), key=lambda i: r["probability"][i])] == r["prediction"] for r in got)
    assert sum(r["prediction"] == r["y"] for r in got) > 60
    assert model.classes == CLASSES
    importances = model.importances()
    assert list(importances) == ["a", "b", "c", "d"] and all(v >= 0 for v in importances.values())
    assert max(importances, key=importances.get) == "a"
    assert scored.columns == [*df.columns, "probability", "prediction"]
    # unlabelled rows can be scored, and a saved model answers the same
    path = str(tmp_path / "model")
    PipelineModel([model]).write().save(path)
    loaded = PipelineModel.load(path)
    assert isinstance(loaded.stages[0], ClassifierModel)
    again = loaded.transform(df.drop("y")).collect()
    assert {r["id"]: r["prediction"] for r in again} == {r["id"]: r["prediction"] for r in got}


@pytest.mark.parametrize("kind", [LogisticClassifier, BoostedTrees, LeafLimitedTrees])
def test_two_classes(frame, kind):
    data = [(i, float(i % 2) + 0.01 * i, i % 2) for i in range(40)]
    df = frame(data, "id long, x double, y int")
    model = kind(idCol="id", labelCol="y", **FAST[kind]).fit(df)
    got = model.transform(df).collect()
    assert model.classes == [0, 1]
    assert {r["prediction"] for r in got} == {0, 1}
    assert all(len(r["probability"]) == 2 for r in got)


@pytest.mark.parametrize("kind", [LogisticClassifier, RandomForest, BoostedTrees])
def test_gaps_and_flags_as_features(frame, kind):
    data = [(i, None if i % 4 == 0 else float(i % 3), i % 2 == 0, CLASSES[i % 3]) for i in range(60)]
    df = frame(data, "id long, x double, flag boolean, y string")
    model = kind(idCol="id", labelCol="y", **FAST[kind]).fit(df)
    assert list(model.importances()) == ["x", "flag", "x_missing"]
    assert model.transform(df).count() == 60


def test_unlabelled_rows_are_not_learned_from(frame):
    df = frame([*rows(4.0), (1000, 0.0, 0.0, 0.0, 0.0, None)], SCHEMA)
    model = LogisticClassifier(idCol="id", labelCol="y", max_iter=5).fit(df)
    assert model.classes == CLASSES


def test_text_features_and_single_class_are_refused(frame):
    with pytest.raises(ValueError, match="encode or drop"):
        RandomForest(idCol="id", labelCol="y").fit(frame([(1, "t", "a"), (2, "u", "b")], "id int, t string, y string"))
    with pytest.raises(ValueError, match="two classes"):
        RandomForest(idCol="id", labelCol="y").fit(frame([(1, 1.0, "a"), (2, 2.0, "a")], "id int, x double, y string"))


def test_parameters(spark):
    with pytest.raises(ValueError):
        BoostedTrees(learning_rate=0.6)
    with pytest.raises(ValueError):
        BoostedTrees(subsample=0.0)
    with pytest.raises(ValueError):
        LogisticClassifier(C=0.0)
    with pytest.raises(ValueError):
        RandomForest(class_weight="heavy")
    with pytest.raises(ValueError, match="30"):
        tree_depth(40)
    assert tree_depth(None) == 30 and RandomForest(max_bins=64).get("max_bins") == 64
    assert RandomForest(max_depth=None).get("max_depth") is None
    assert BoostedTrees().get("n_estimators") == 500
    assert LeafLimitedTrees().get("num_leaves") == 63


def test_balanced_weights_lift_the_rare_class(frame):
    rng = random.Random(5)
    data = [(i, rng.gauss(0, 1) + (1.0 if i % 20 == 0 else 0.0), "rare" if i % 20 == 0 else "common") for i in range(400)]
    df = frame(data, "id long, x double, y string")
    found = {}
    for weight in ("balanced", None):
        model = RandomForest(idCol="id", labelCol="y", n_estimators=10, max_depth=2, class_weight=weight).fit(df)
        found[weight] = model.transform(df).filter("prediction = 'rare'").count()
    assert found["balanced"] > found[None]
