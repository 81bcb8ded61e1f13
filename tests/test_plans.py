import itertools
import math
import random
import re
import statistics
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.functions.columns import in_parallel
from millrace.operators.clean import NumericImputer, ZeroToNull
from millrace.operators.metrics import pair_counts, scores
from millrace.operators.split import with_folds
from millrace.plans import jobs, store
from millrace.plans.sampler import DensitySampler
from millrace.plans.spec import baseline_spec, build_pipeline, full_spec, model_step, read_spec, step_names, without_model
from millrace.plans.tune import SPACES, Range, tune
from millrace.plans.validate import PreparedFolds, cross_val_eval, fold_scores
from millrace.sources import scratch
from millrace.sources.tables import read_table
from millrace.streaming.score import predict_arriving

CLASSES = ["functional", "functional needs repair", "non functional"]


def spec(model=None, **params):
    return {
        "name": "small",
        "preprocessing": [
            {"type": "zero_to_nan", "columns": ["height"]},
            {"type": "pump_age"},
            {"type": "redundant_dropper", "columns_to_drop": ["date_recorded"]},
            {"type": "numeric_imputer"},
            {"type": "categorical_imputer"},
            {"type": "target_encoder", "columns": ["funder"]},
            {"type": "ordinal_encoder"},
        ],
        "features": [
            {"type": "geo_cluster", "n_clusters": 3},
            {"type": "variance_threshold"},
            {"type": "correlation_threshold"},
        ],
        "model": {"type": model, **params} if model else None,
    }


def raw_rows(n=120):
    rng = random.Random(11)
    for i in range(n):
        yield (
            i, f"20{10 + i % 4}-03-01", 1990.0 + i % 20 if i % 9 else None, rng.choice([0, 100, 200]), rng.choice("abc"),
            rng.choice(["x", "y", None]), rng.uniform(-10, -1), 30 + rng.random() + 5 * (i % 3), CLASSES[i % 3],
        )


SCHEMA = (
    "id long, date_recorded string, construction_year double, height int, funder string, source string, "
    "latitude double, longitude double, status_group string"
)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    df = spark.createDataFrame(list(raw_rows()), SCHEMA)
    paths = {"features": str(folder / "features"), "labels": str(folder / "labels"), "root": str(folder)}
    df.drop("status_group").write.parquet(paths["features"])
    df.select("id", "status_group").write.parquet(paths["labels"])
    return paths


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(list(raw_rows()), SCHEMA).repartition(3)


def test_steps_are_named_and_ordered():
    names = step_names(build_pipeline({**spec("lgbm"), "features": [{"type": "numeric_imputer"}, {"type": "numeric_imputer"}]}))
    assert names == [
        "zero_to_nan", "pump_age", "redundant_dropper", "numeric_imputer", "categorical_imputer", "target_encoder",
        "ordinal_encoder", "numeric_imputer_1", "numeric_imputer_2", "model",
    ]
    assert step_names(build_pipeline({"name": "only_model", "model": {"type": "xgb"}})) == ["model"]
    assert step_names(build_pipeline({"name": "none"})) == []


def test_parameters_reach_the_stages():
    stages = build_pipeline(
        '{"name": "s", "preprocessing": [{"type": "numeric_imputer", "strategy": "mean"}], "model": {"type": "xgb", "n_estimators": 7}}',
        id_col="key",
    ).getStages()
    assert isinstance(stages[0], NumericImputer) and stages[0].get("strategy") == "mean" and stages[0].get("idCol") == "key"
    assert stages[1].get("n_estimators") == 7 and stages[1].get("labelCol") == "status_group"
    assert ZeroToNull().get("columns") == ["construction_year", "gps_height", "population"]


def test_bad_specs():
    with pytest.raises(KeyError, match="no_such_step"):
        build_pipeline({"name": "s", "preprocessing": [{"type": "no_such_step"}]})
    with pytest.raises(KeyError, match="svm"):
        build_pipeline({"name": "s", "model": {"type": "svm"}})
    for bad in (
        {"name": "s", "extra": 1},
        {"preprocessing": []},
        {"name": "s", "preprocessing": [{"strategy": "mean"}]},
        {"name": "s", "preprocessing": [{"type": "numeric_imputer", "typo": 1}]},
        {"name": "s", "model": {"type": "xgb", "learning_rate": 0.9}},
    ):
        with pytest.raises(ValueError):
            build_pipeline(bad)


@pytest.mark.parametrize("made", [baseline_spec(), full_spec(), full_spec("lgbm", n_estimators=5)])
def test_shipped_specs_build(made):
    names = step_names(build_pipeline(made))
    assert names.index("pump_age") < names.index("ordinal_encoder")
    assert read_spec(without_model(made))["model"] is None


def test_fit_save_load_predict(spark, raw, tmp_path):
    fitted = build_pipeline(spec("logistic_regression", max_iter=10)).fit(raw)
    folder = str(tmp_path / "models")
    first = store.save(spark, fitted, "model_a", folder, spec=spec("logistic_regression"))
    second = store.save(spark, fitted, "model_a", folder)
    assert first != second and re.fullmatch(r"model_a_\d{8}_\d{6}_\d{6}", first)
    want = {r["id"]: r["prediction"] for r in fitted.transform(raw).collect()}
    loaded = store.load_latest(spark, "model_a", folder)
    assert {r["id"]: r["prediction"] for r in loaded.transform(raw.drop("status_group")).collect()} == want
    assert store.load_spec(spark, first, folder) == spec("logistic_regression")
    listed = store.list_models(spark, folder).collect()
    assert [(r["stem"], r["name"]) for r in listed] == [(first, "model_a"), (second, "model_a")]
    assert all(r["saved_at"] is not None for r in listed)
    with pytest.raises(FileNotFoundError):
        store.load_latest(spark, "model", folder)
    with pytest.raises(FileNotFoundError):
        store.load(spark, "model_a", folder)
    with pytest.raises(FileNotFoundError):
        store.load_spec(spark, second, folder)


def test_empty_store(spark, tmp_path):
    listed = store.list_models(spark, str(tmp_path / "nothing"))
    assert listed.columns == ["stem", "name", "saved_at", "path"] and listed.count() == 0


def test_every_fitted_stage_survives_saving(spark, raw, tmp_path, monkeypatch):
    """With written value tables, as after a fit on many categories."""
    from millrace.operators import encode

    monkeypatch.setattr(encode, "LITERAL_ROWS", -1)
    made = spec()
    made["preprocessing"].insert(5, {"type": "frequency_encoder"})
    made["features"].append({"type": "mutual_info", "k": 3})
    fitted = build_pipeline(made).fit(raw)
    path = str(tmp_path / "fitted")
    fitted.write().save(path)
    loaded = PipelineModel.load(path)
    assert [type(s) for s in loaded.stages] == [type(s) for s in fitted.stages]
    columns = fitted.transform(raw).columns
    assert loaded.transform(raw).columns == columns
    assert sorted(map(str, loaded.transform(raw).collect())) == sorted(map(str, fitted.transform(raw).collect()))
    with pytest.raises(ValueError, match="no 'model' step"):
        model_step(fitted)


def test_cross_validation(raw):
    pipeline = build_pipeline({"name": "s", "model": {"type": "logistic_regression", "max_iter": 5}}, id_col="id")
    df = raw.select("id", "longitude", "latitude", "status_group")
    got = cross_val_eval(pipeline, df, "id", "status_group", n_splits=2)
    assert set(got) == {f"{k}_{s}" for k in ("accuracy", "f1_macro", "f1_weighted", "cost") for s in ("mean", "std")}
    assert all(isinstance(v, float) for v in got.values())
    assert all(got[k] >= 0 for k in got if k.endswith("std"))
    assert got["accuracy_mean"] > 0.9
    assert not hasattr(pipeline, "stages_")


def test_search(raw):
    df = raw.select("id", "longitude", "latitude", "status_group")
    spaces = {"random_forest": {"n_estimators": Range(2, 4, whole=True), "max_depth": Range(2, 3, whole=True)}}
    base = {"name": "rf", "model": {"type": "random_forest"}}
    best = tune(base, df, "id", "status_group", n_trials=2, cv_folds=2, spaces=spaces)
    assert best["name"] == "rf_tuned" and best["preprocessing"] == []
    assert 2 <= best["model"]["n_estimators"] <= 4 and 2 <= best["model"]["max_depth"] <= 3
    with pytest.raises(ValueError, match="logistic_regression"):
        tune({"name": "s", "model": {"type": "logistic_regression"}}, df, "id", "status_group")


def test_search_spaces():
    rng = random.Random(0)
    assert set(SPACES) == {"xgb", "lgbm", "random_forest"}
    for space in SPACES.values():
        for r in space.values():
            drawn = [r.draw(rng) for _ in range(200)]
            assert all(r.low <= x <= r.high for x in drawn)
            assert all(isinstance(x, int) for x in drawn) == r.whole


def test_split_train_evaluate_predict(spark, files):
    out = f"{files['root']}/split"
    shares = jobs.split(spark, files["features"], files["labels"], out, test_size=0.25)
    assert [(r["n_train"], r["n_test"]) for r in shares.collect()] == [(30, 10)] * 3
    models = f"{files['root']}/models"
    small = spec("logistic_regression", max_iter=10)
    stem = jobs.train(spark, f"{out}/train_values", f"{out}/train_labels", models, spec=small, name="mine")
    assert stem.startswith("mine_")
    held = jobs.evaluate(spark, "mine", f"{out}/test_values", f"{out}/test_labels", models, latest=True, holdout=True)
    assert set(held) == {"accuracy", "f1_macro", "f1_weighted", "cost"} and held["accuracy"] > 0.8
    path = jobs.predict(spark, stem, f"{out}/test_values", models, f"{files['root']}/predicted")
    rows = read_table(spark, path, fmt="csv")
    assert rows.columns == ["id", "status_group"] and rows.count() == 30
    with pytest.raises(ValueError, match="no model"):
        jobs.train(spark, files["features"], files["labels"], models, spec=spec())

    fitted = store.load(spark, stem, models)
    test = jobs.read_dataset(spark, f"{out}/test_values", f"{out}/test_labels")
    charts = jobs.chart_tables(spark, {"mine": fitted}, test, lat_col="latitude", lon_col="longitude", top_n=3)
    assert charts["importances_mine"].count() == 3
    assert charts["map_mine"].count() == 30
    assert charts["confusion_mine"].count() == 3
    assert charts["model_comparison"].count() == 2

    arriving = read_table(spark, f"{out}/test_values")
    query = predict_arriving(
        spark, fitted, f"{out}/test_values", arriving.schema, f"{files['root']}/streamed", f"{files['root']}/stream_state"
    )
    query.awaitTermination(60)
    streamed = {r["id"]: r["status_group"] for r in spark.read.parquet(f"{files['root']}/streamed").collect()}
    assert streamed == {r["id"]: r["status_group"] for r in rows.collect()}


def test_diagnose(spark, files):
    out = f"{files['root']}/reports"
    found = jobs.diagnose(spark, files["features"], files["labels"], spec=spec(), output_dir=out)
    assert set(found) == {"before", "after", "diff"}
    assert found["before"]["label_distribution"].count() == 3
    written = read_table(spark, f"{out}/diff_missing", fmt="csv")
    changed = {r["column"]: r["pct_change"] for r in written.collect()}
    assert changed["construction_year"] < 0
    plain = jobs.diagnose(spark, files["features"])
    assert set(plain) == {"before"} and "label_distribution" not in plain["before"]


def tables_left(spark):
    root = scratch.scratch_root(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName().startswith("table-")}


def test_cross_validation_leaves_no_table(spark, raw):
    before = tables_left(spark)
    made = spec("logistic_regression", max_iter=3)
    cross_val_eval(build_pipeline(made), raw, "id", "status_group", n_splits=2)
    assert tables_left(spark) == before
    broken = build_pipeline({**made, "model": {"type": "lgbm", "n_estimators": 1, "random_state": 1}})
    broken.getStages()[-1]._fit = None  # fails after the folds are prepared
    with pytest.raises(TypeError):
        cross_val_eval(broken, raw, "id", "status_group", n_splits=2, parallelism=1)
    assert tables_left(spark) == before


def test_scopes_have_their_own_tables(spark):
    df = spark.range(3)
    with scratch.scratch_scope(spark):
        outer, _ = scratch.write_table(df)
        with scratch.scratch_scope(spark):
            inner, _ = scratch.write_table(df)
            found = in_parallel(spark, [lambda: scratch.write_table(df)[0]] * 2, 2)
        assert outer.count() == 3
        for gone in (inner, *found):
            with pytest.raises(Exception, match="(?i)not.exist|path"):
                gone.count()


def test_search_prepares_each_fold_once(spark, raw, monkeypatch):
    fitted = []
    fit = NumericImputer._fit
    monkeypatch.setattr(NumericImputer, "_fit", lambda self, df: fitted.append(1) or fit(self, df))
    before = tables_left(spark)
    spaces = {"random_forest": {"n_estimators": Range(1, 2, whole=True), "max_depth": Range(1, 2, whole=True)}}
    made = {**spec("random_forest"), "features": []}
    best = tune(made, raw, "id", "status_group", n_trials=3, cv_folds=2, spaces=spaces, trials_at_once=2)
    assert len(fitted) == 2 and best["name"] == "small_tuned" and tables_left(spark) == before


def test_prepared_folds_score_as_whole_pipelines(spark, raw):
    made = spec("logistic_regression", max_iter=5)
    folded, _ = scratch.write_table(with_folds(raw, "id", "status_group", n_splits=2))
    got = fold_scores(build_pipeline(made), PreparedFolds(folded, 2), "status_group", labels=CLASSES, costs=None)
    for fold, found in enumerate(got):
        train, held = folded.where(F.col("fold") != fold).drop("fold"), folded.where(F.col("fold") == fold).drop("fold")
        want = scores(pair_counts(build_pipeline(made).fit(train).transform(held), "status_group"), CLASSES)
        assert found["f1_macro"] == pytest.approx(want["f1_macro"], abs=1e-9)


def test_savers_of_one_name_at_once(spark, raw, tmp_path, monkeypatch):
    """Stamps that are taken are passed over; a broken save leaves nothing that is listed."""
    folder, fitted = str(tmp_path / "models"), build_pipeline({"name": "none"}).fit(raw)
    clock = itertools.cycle([datetime(2024, 5, 6, 7, 8, 9)])
    monkeypatch.setattr(store, "datetime", type("Clock", (), {"now": staticmethod(lambda: next(clock))}))
    stems = in_parallel(spark, [lambda: store.save(spark, fitted, "m", folder)] * 3, 3)
    assert sorted(stems) == [f"m_20240506_070809_00000{i}" for i in range(3)]
    assert store.latest_stem(spark, "m", folder) == "m_20240506_070809_000002"

    class Broken:
        def write(self):
            return self

        def save(self, path):
            fitted.write().save(path)
            raise OSError("full")

    with pytest.raises(OSError):
        store.save(spark, Broken(), "m", folder)
    (tmp_path / "models" / "by hand").mkdir()
    listed = [(r["stem"], r["name"], r["saved_at"]) for r in store.list_models(spark, folder).orderBy("stem").collect()]
    assert [r[0] for r in listed] == ["by hand", *sorted(stems)]
    assert listed[0][1:] == ("by hand", None) and listed[3][1:] == ("m", datetime(2024, 5, 6, 7, 8, 9, 2))
    assert not any((tmp_path / "models" / "_staging").iterdir())


def response(p):
    """A made-up score of boosting parameters: best at a rate of 0.05, depth 6, 400 trees; they depend on one another."""
    rate, depth, trees = math.log(p["learning_rate"] / 0.05), p["max_depth"] - 6, math.log(p["n_estimators"] / 400)
    return -(rate**2) - 0.1 * depth**2 - (trees + 0.5 * rate) ** 2 - 0.5 * (p["subsample"] - 0.8) ** 2


def test_densities_beat_even_draws():
    best = {"densities": [], "even": []}
    for seed in range(25):
        sampler, trials = DensitySampler(SPACES["xgb"], seed), []
        for _ in range(40):
            trials.append((p := sampler.propose(trials), response(p)))
        best["densities"].append(max(s for _, s in trials))
        rng = random.Random(seed)
        best["even"].append(max(response({n: r.draw(rng) for n, r in SPACES["xgb"].items()}) for _ in range(40)))
    assert statistics.median(best["densities"]) > statistics.median(best["even"])


def test_proposals_hang_on_the_trials_alone():
    space = SPACES["lgbm"]
    rng = random.Random(3)
    trials = [({n: r.draw(rng) for n, r in space.items()}, rng.random()) for _ in range(15)]
    first = DensitySampler(space, 1).propose(trials)
    assert first == DensitySampler(space, 1).propose(trials) != DensitySampler(space, 2).propose(trials)
    running = [*trials, (first, None)]
    second = DensitySampler(space, 1).propose(running)
    assert second != first
    for p in (first, second):
        assert all(space[n].low <= v <= space[n].high and isinstance(v, int) == space[n].whole for n, v in p.items())
    for r in space.values():
        assert all(r.low <= r.at(u) <= r.high for u in (0.0, 0.5, 1.0))
        assert r.at(r.place(r.at(0.3))) == pytest.approx(r.at(0.3))


def test_predictions_without_a_path(spark, files):
    models = f"{files['root']}/more_models"
    stem = jobs.train(spark, files["features"], files["labels"], models, spec=spec("logistic_regression", max_iter=3), name="p")
    path = jobs.predict(spark, stem, files["features"], models)
    assert path.endswith(f"submission_{stem}") and read_table(spark, path, fmt="csv").count() == 120
