"""Splits, metrics, models, search and the model store on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import class_counts, col
from millrace.operators import charts, metrics
from millrace.operators.models import BoostedTrees, LeafLimitedTrees, LogisticClassifier, RandomForest
from millrace.operators.select import TreeImportance
from millrace.operators.split import stratified_split, split_summary, with_folds, with_test_flag
from millrace.plans import store
from millrace.plans.sampler import Range
from millrace.plans.spec import build_pipeline, model_step
from millrace.plans.tune import tune
from millrace.plans.validate import cross_val_eval, holdout_eval, scores_table
from millrace.sources.scratch import scratch_root, write_table
from millrace.sources.sinks import write_predictions, write_split
from millrace.sources.tables import read_dataset, read_table
from workload.preparation import orders_with_customer, rounded, table

# --- splits ----------------------------------------------------------------------------


def stratified_test_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return with_test_flag(orders, "o_orderkey", "o_orderstatus", test_size=0.2, seed=42)


def stratified_folds(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return with_folds(orders, "o_orderkey", "o_orderstatus", n_splits=5, seed=42)


def split_shares(spark, sf):
    train, test = stratified_split(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", test_size=0.2)
    return rounded(split_summary(train, test, "o_orderstatus"), 6, "pct_train", "pct_test")


def split_tables(spark, sf):
    """The four written tables read back: every order with the side it is on and its label."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    train, test = stratified_split(orders, "o_orderkey", "o_orderstatus", test_size=0.2)
    paths = write_split(train, test, f"{scratch_root(spark)}/split-{uuid.uuid4().hex}", id_col="o_orderkey", label_col="o_orderstatus")
    sides = []
    for side in ("train", "test"):
        values, labels = (read_table(spark, paths[f"{side}_{part}"]) for part in ("values", "labels"))
        sides.append(values.join(labels, "o_orderkey").withColumn("is_test", F.lit(side == "test")))
    return sides[0].unionByName(sides[1])


def load_dataset(spark, sf):
    """Features and a label table written with other names, read, checked and joined."""
    folder = f"{scratch_root(spark)}/labels-{uuid.uuid4().hex}"
    table(spark, sf, "labels").select("doc_id", "quality").write.parquet(folder)
    data = read_dataset(spark, f"{sf}/documents.parquet", folder, id_col="doc_id", label_col="good")
    return data.select("doc_id", "lang", "source", "n_chars", "good")


# --- metrics ---------------------------------------------------------------------------

CLASSES = ["F", "O", "P"]


def _rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Order status guessed from the price by a fixed rule."""
    price = F.col("o_totalprice")
    guess = F.when(price < 150000, "F").when(price < 300000, "O").otherwise("P")
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", guess.alias("prediction"))


def _rule_counts(spark, sf):
    return metrics.pair_counts(_rule_predictions(spark, sf), "o_orderstatus")


def class_metrics(spark, sf):
    return rounded(metrics.class_metrics(_rule_counts(spark, sf), CLASSES), 6, "precision", "recall", "f1")


def summary_metrics(spark, sf):
    found = metrics.scores(_rule_counts(spark, sf), CLASSES)
    row = tuple(float(found[k]) for k in ("accuracy", "f1_macro", "f1_weighted"))
    df = spark.createDataFrame([row], "accuracy double, f1_macro double, f1_weighted double")
    return rounded(df, 6, *df.columns)


def confusion(spark, sf):
    return metrics.confusion_matrix(_rule_counts(spark, sf), CLASSES)


def cost(spark, sf):
    total = metrics.cost_score(_rule_predictions(spark, sf), "o_orderstatus", labels=CLASSES)
    return spark.createDataFrame([(total,)], "cost double")


# --- chart tables ----------------------------------------------------------------------


def class_shares(spark, sf):
    return rounded(charts.class_shares(table(spark, sf, "orders"), "o_orderstatus", ["P", "O", "F"]), 6, "pct")


def confusion_shares(spark, sf):
    return rounded(charts.confusion_shares(_rule_counts(spark, sf), CLASSES), 6, *CLASSES)


def class_metrics_long(spark, sf):
    return rounded(charts.class_metrics_long(_rule_counts(spark, sf), CLASSES), 6, "value")


def model_comparison(spark, sf):
    """The price rule against always answering the most frequent class."""
    rule = _rule_predictions(spark, sf)
    counts = class_counts(rule, "o_orderstatus")
    constant = rule.withColumn("prediction", F.lit(max(counts, key=lambda cn: cn[1])[0]))
    results = {
        name: metrics.scores(metrics.pair_counts(df, "o_orderstatus"), CLASSES)
        for name, df in (("rule", rule), ("constant", constant))
    }
    return rounded(charts.model_comparison(spark, results), 6, "value")


# --- models ----------------------------------------------------------------------------


def _prepared_orders(spark, sf):
    prepared = orders_with_customer(spark, sf).select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "c_acctbal",
        F.year("o_orderdate").alias("order_year"),
        F.col("c_nationkey").cast("double").alias("nation"),
    )
    return write_table(prepared)[0]


def _vectors(spark, sf):
    """Embedding dimensions as columns; the ten labels grouped into three classes."""
    df = table(spark, sf, "embeddings")
    dims = [F.col("embedding")[i].cast("double").alias(f"d{i}") for i in range(64)]
    label = F.when(F.col("label") < 4, "a").when(F.col("label") < 7, "b").otherwise("c")
    return df.select("vec_id", label.alias("status"), *dims)


def _fit_and_predict(df, model, id_col):
    """Every row once, the sum of its classes' probabilities, and whether it got one of the classes."""
    fitted = model.fit(df)
    total = F.round(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x), 6)
    return fitted.transform(df).select(id_col, total.alias("total"), F.col("prediction").isin(fitted.classes).alias("known"))


def fit_logistic(spark, sf):
    model = LogisticClassifier(idCol="o_orderkey", labelCol="o_orderstatus", max_iter=50)
    return _fit_and_predict(_prepared_orders(spark, sf), model, "o_orderkey")


def fit_forest(spark, sf):
    model = RandomForest(idCol="o_orderkey", labelCol="o_orderstatus", n_estimators=20, max_depth=6)
    return _fit_and_predict(_prepared_orders(spark, sf), model, "o_orderkey")


def fit_boosted(spark, sf):
    model = BoostedTrees(idCol="vec_id", labelCol="status", n_estimators=5, max_depth=3)
    return _fit_and_predict(_vectors(spark, sf), model, "vec_id")


def fit_leaf_limited(spark, sf):
    model = LeafLimitedTrees(idCol="vec_id", labelCol="status", n_estimators=5, num_leaves=8)
    return _fit_and_predict(_vectors(spark, sf), model, "vec_id")


def _told_by_nation(spark, sf):
    """A label that the nation's number tells, beside two columns that tell nothing."""
    nation = F.col("c_nationkey")
    label = F.when(nation < 6, "low").when(nation < 17, "middle").otherwise("high")
    return orders_with_customer(spark, sf).select(
        "o_orderkey", label.alias("zone"), nation.cast("double").alias("nation"), "c_acctbal", "o_totalprice"
    )


def _learned(df, model, id_col):
    return model.fit(df).transform(df).select(id_col, "prediction")


def learn_logistic(spark, sf):
    """Two classes with a wide gap between them."""
    nation = F.col("nation")
    df = _told_by_nation(spark, sf).where((nation < 5) | (nation > 19)).select("o_orderkey", F.when(nation < 5, "low").otherwise("high").alias("zone"), "nation")
    return _learned(df, LogisticClassifier(idCol="o_orderkey", labelCol="zone", max_iter=50), "o_orderkey")


def learn_forest(spark, sf):
    model = RandomForest(idCol="o_orderkey", labelCol="zone", n_estimators=15, max_depth=6)
    return _learned(_told_by_nation(spark, sf), model, "o_orderkey")


def learn_boosted(spark, sf):
    model = BoostedTrees(idCol="o_orderkey", labelCol="zone", n_estimators=4, max_depth=3, learning_rate=0.5, subsample=1.0, colsample_bytree=1.0)
    return _learned(_told_by_nation(spark, sf), model, "o_orderkey")


def learn_leaf_limited(spark, sf):
    model = LeafLimitedTrees(idCol="o_orderkey", labelCol="zone", n_estimators=4, num_leaves=6, learning_rate=0.5, colsample_bytree=1.0)
    return _learned(_told_by_nation(spark, sf), model, "o_orderkey")


def learn_from_gaps(spark, sf):
    """The label is told by a price that is missing; the model has no indicator column."""
    price = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "finished").otherwise("open").alias("state"), price.alias("price"), F.year("o_orderdate").alias("order_year")
    )
    model = LeafLimitedTrees(idCol="o_orderkey", labelCol="state", n_estimators=3, num_leaves=4, learning_rate=0.5, colsample_bytree=1.0)
    return _learned(df, model, "o_orderkey")


def importance_select(spark, sf):
    df = _prepared_orders(spark, sf).withColumn(
        "late_status", F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no")
    )
    model = TreeImportance(
        idCol="o_orderkey", labelCol="late_status", n_estimators=5, max_depth=3, percentile_cutoff=50.0
    ).fit(df.drop("o_orderstatus"))
    return spark.createDataFrame(list(model.learned["scores"].items()), "column string, importance double")


def top_importances(spark, sf):
    model = RandomForest(idCol="vec_id", labelCol="status", n_estimators=20, max_depth=5).fit(_vectors(spark, sf))
    return charts.top_importances(spark, model.importances(), 5)


# --- validation and search -------------------------------------------------------------

SPEC = {
    "name": "orders",
    "preprocessing": [
        {"type": "redundant_dropper", "columns_to_drop": ["o_custkey", "c_custkey", "c_name"]},
        {"type": "pump_age", "reference_column": "o_orderdate", "construction_column": "start", "output_column": "age"},
        {"type": "redundant_dropper", "columns_to_drop": ["o_orderdate", "start"]},
        {"type": "numeric_imputer"},
        {"type": "categorical_imputer"},
        {"type": "target_encoder", "columns": ["c_mktsegment"]},
        {"type": "frequency_encoder", "columns": ["o_orderpriority"]},
        {"type": "ordinal_encoder"},
    ],
    "features": [
        {"type": "variance_threshold", "threshold": 0.0001},
        {"type": "correlation_threshold"},
        {"type": "mutual_info", "k": 5},
    ],
    "model": {"type": "random_forest", "n_estimators": 10, "max_depth": 5},
}
KEYS = {"id_col": "o_orderkey", "label_col": "o_orderstatus"}


def _raw_orders(spark, sf):
    """Joined once and written: every stage of a fit reads it again."""
    raw = orders_with_customer(spark, sf).withColumn("start", F.lit(1992.0))
    return write_table(raw)[0]


def whole_pipeline(spark, sf):
    """Fit the whole spec on the training rows and score the held-out rows."""
    train, test = stratified_split(_raw_orders(spark, sf), "o_orderkey", "o_orderstatus")
    fitted = build_pipeline(SPEC, **KEYS).fit(train)
    return scores_table(train, holdout_eval(fitted, test, "o_orderstatus", labels=CLASSES))


def cross_validation(spark, sf):
    """Scores over folds of a label that the rows tell: all of them are right, in every fold."""
    spec = {"name": "zones", "preprocessing": [{"type": "numeric_imputer"}], "model": {"type": "lgbm", "n_estimators": 3, "num_leaves": 6, "learning_rate": 0.5}}
    df = _told_by_nation(spark, sf).drop("o_totalprice")
    pipeline = build_pipeline(spec, id_col="o_orderkey", label_col="zone")
    found = cross_val_eval(pipeline, df, "o_orderkey", "zone", n_splits=3, labels=["low", "middle", "high"])
    return rounded(scores_table(df, found), 6, "value")


def search(spark, sf):
    """The best parameters found, and whether they lie in the space that was searched."""
    spaces = {"random_forest": {"n_estimators": Range(5, 10, whole=True), "max_depth": Range(2, 5, whole=True)}}
    spec = {"name": "orders", "preprocessing": [{"type": "numeric_imputer"}], "model": {"type": "random_forest"}}
    df = _prepared_orders(spark, sf)
    best = tune(spec, df, "o_orderkey", "o_orderstatus", n_trials=3, cv_folds=2, spaces=spaces)
    params = [(k, spaces["random_forest"][k].low <= v <= spaces["random_forest"][k].high) for k, v in best["model"].items() if k != "type"]
    return spark.createDataFrame(params, "parameter string, inside boolean")


def _quick_model(spark, sf):
    spec = {**SPEC, "features": [], "model": {"type": "logistic_regression", "max_iter": 10}}
    df = _raw_orders(spark, sf)
    return df, spec, build_pipeline(spec, **KEYS).fit(df)


def store_roundtrip(spark, sf):
    """Save a pipeline, find it again by name, and compare what both predict."""
    df, spec, fitted = _quick_model(spark, sf)
    folder = f"{scratch_root(spark)}/models-{uuid.uuid4().hex}"
    store.save(spark, fitted, "orders", folder, spec=spec)
    loaded = store.load_latest(spark, "orders", folder)
    assert model_step(loaded).classes == CLASSES
    one, two = (m.transform(df).select("o_orderkey", F.col("prediction").alias(n)) for m, n in ((fitted, "fitted"), (loaded, "loaded")))
    return one.join(two, "o_orderkey").select("o_orderkey", (F.col("fitted") == F.col("loaded")).alias("same"))


def prediction_file(spark, sf):
    """The written file read back: every order once, with one of the classes."""
    df, _, fitted = _quick_model(spark, sf)
    path = f"{scratch_root(spark)}/predictions-{uuid.uuid4().hex}"
    write_predictions(fitted.transform(df), path, id_col="o_orderkey")
    written = read_table(spark, path, fmt="csv", schema="o_orderkey long, status_group string")
    return written.select("o_orderkey", F.col("status_group").isin(CLASSES).alias("known"))


QUERIES = {
    f.__name__: f
    for f in (
        stratified_test_rows,
        stratified_folds,
        split_shares,
        split_tables,
        load_dataset,
        class_metrics,
        summary_metrics,
        confusion,
        cost,
        class_shares,
        confusion_shares,
        class_metrics_long,
        model_comparison,
        fit_logistic,
        fit_forest,
        fit_boosted,
        fit_leaf_limited,
        learn_logistic,
        learn_forest,
        learn_boosted,
        learn_leaf_limited,
        learn_from_gaps,
        importance_select,
        top_importances,
        whole_pipeline,
        cross_validation,
        search,
        store_roundtrip,
        prediction_file,
    )
}

# --- oracles ---------------------------------------------------------------------------

_RANKED = """
    SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus
           ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42')) AS rn,
           count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders"""
_QUOTAS = """
    SELECT c, n, CAST(floor(x) AS BIGINT)
           + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, c)
                       <= wanted - sum(CAST(floor(x) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS quota
    FROM (SELECT c, n, w.wanted, n * w.wanted / CAST(t AS DOUBLE) AS x
          FROM (SELECT o_orderstatus AS c, count(*) AS n FROM orders GROUP BY 1),
               (SELECT count(*) AS t, CAST(ceil(round(count(*) * 0.2, 9)) AS BIGINT) AS wanted FROM orders) w)"""
_PAIRS = """
    SELECT o_orderstatus AS t, CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O'
           ELSE 'P' END AS p FROM orders"""
_PER_CLASS = f"""
    SELECT c AS label, coalesce(hit / nullif(CAST(claimed AS DOUBLE), 0), 0) AS precision,
           coalesce(hit / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
           coalesce(2 * hit / nullif(CAST(support + claimed AS DOUBLE), 0), 0) AS f1, support
    FROM (SELECT c, count(*) FILTER (t = c AND p = c) AS hit, count(*) FILTER (t = c) AS support,
                 count(*) FILTER (p = c) AS claimed
          FROM ({_PAIRS}), (VALUES ('F'), ('O'), ('P')) v(c) GROUP BY c)"""


def _accuracy(pairs: str) -> str:
    return f"(SELECT count(*) FILTER (t = p) / CAST(count(*) AS DOUBLE) FROM ({pairs}))"


_CONSTANT = """
    SELECT o_orderstatus AS t, (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p
    FROM orders"""

_NATION = "orders JOIN customer ON o_custkey = c_custkey"
_ZONE = f"SELECT o_orderkey, CASE WHEN c_nationkey < 6 THEN 'low' WHEN c_nationkey < 17 THEN 'middle' ELSE 'high' END AS prediction FROM {_NATION}"

ORACLES = {
    "fit_logistic": f"SELECT o_orderkey, CAST(1 AS DOUBLE) AS total, true AS known FROM {_NATION}",
    "fit_forest": f"SELECT o_orderkey, CAST(1 AS DOUBLE) AS total, true AS known FROM {_NATION}",
    "fit_boosted": "SELECT vec_id, CAST(1 AS DOUBLE) AS total, true AS known FROM embeddings",
    "fit_leaf_limited": "SELECT vec_id, CAST(1 AS DOUBLE) AS total, true AS known FROM embeddings",
    "learn_logistic": f"""
        SELECT o_orderkey, CASE WHEN c_nationkey < 5 THEN 'low' ELSE 'high' END AS prediction
        FROM {_NATION} WHERE c_nationkey < 5 OR c_nationkey > 19""",
    "learn_forest": _ZONE,
    "learn_boosted": _ZONE,
    "learn_leaf_limited": _ZONE,
    "learn_from_gaps": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS prediction FROM orders",
    "cross_validation": """
        SELECT * FROM (VALUES ('accuracy_mean', 1.0::DOUBLE), ('accuracy_std', 0.0), ('cost_mean', 0.0), ('cost_std', 0.0),
                       ('f1_macro_mean', 1.0), ('f1_macro_std', 0.0), ('f1_weighted_mean', 1.0), ('f1_weighted_std', 0.0)) AS t(score, value)""",
    "search": "SELECT * FROM (VALUES ('n_estimators', true), ('max_depth', true)) AS t(parameter, inside)",
    "store_roundtrip": "SELECT o_orderkey, true AS same FROM orders JOIN customer ON o_custkey = c_custkey",
    "prediction_file": "SELECT o_orderkey, true AS known FROM orders JOIN customer ON o_custkey = c_custkey",
    "load_dataset": "SELECT doc_id, lang, source, n_chars, quality AS good FROM documents JOIN labels USING (doc_id)",
    "split_tables": f"""
        SELECT o_orderkey, r.o_orderstatus, o_totalprice, rn <= quota AS is_test
        FROM ({_RANKED}) AS r JOIN ({_QUOTAS}) ON r.o_orderstatus = c JOIN orders USING (o_orderkey)""",
    "stratified_test_rows": f"""
        SELECT o_orderkey, o_orderstatus, rn <= quota AS is_test
        FROM ({_RANKED}) JOIN ({_QUOTAS}) ON o_orderstatus = c""",
    "stratified_folds": f"""
        SELECT o_orderkey, o_orderstatus, CAST(CASE WHEN rn > (n + 4) // 5 THEN 1 ELSE 0 END
               + CASE WHEN rn > (2 * n + 4) // 5 THEN 1 ELSE 0 END + CASE WHEN rn > (3 * n + 4) // 5 THEN 1 ELSE 0 END
               + CASE WHEN rn > (4 * n + 4) // 5 THEN 1 ELSE 0 END AS INTEGER) AS fold
        FROM ({_RANKED})""",
    "split_shares": f"""
        SELECT c AS label, CAST(n - quota AS BIGINT) AS n_train,
               round((n - quota) / CAST(sum(n - quota) OVER () AS DOUBLE), 6) AS pct_train,
               CAST(quota AS BIGINT) AS n_test, round(quota / CAST(sum(quota) OVER () AS DOUBLE), 6) AS pct_test
        FROM ({_QUOTAS})""",
    "class_metrics": f"""
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
        FROM ({_PER_CLASS})""",
    "summary_metrics": f"""
        SELECT round({_accuracy(_PAIRS)}, 6) AS accuracy, round(avg(f1), 6) AS f1_macro,
               round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM ({_PER_CLASS})""",
    "confusion": f"""
        SELECT c AS true_label, count(*) FILTER (t = c AND p = 'F') AS "F", count(*) FILTER (t = c AND p = 'O') AS "O",
               count(*) FILTER (t = c AND p = 'P') AS "P"
        FROM ({_PAIRS}), (VALUES ('F'), ('O'), ('P')) v(c) GROUP BY c""",
    "cost": f"""
        SELECT CAST(sum(CASE t || p WHEN 'FO' THEN 1 WHEN 'FP' THEN 3 WHEN 'OF' THEN 2 WHEN 'OP' THEN 2
                        WHEN 'PF' THEN 5 WHEN 'PO' THEN 3 ELSE 0 END) AS DOUBLE) AS cost FROM ({_PAIRS})""",
    "class_shares": """
        SELECT o_orderstatus AS label, count(*) AS count,
               round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS pct,
               CAST(CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER) AS position
        FROM orders WHERE o_orderstatus IN ('P', 'O', 'F') GROUP BY 1""",
    "confusion_shares": f"""
        SELECT t AS true_label, round(count(*) FILTER (p = 'F') / CAST(count(*) AS DOUBLE), 6) AS "F",
               round(count(*) FILTER (p = 'O') / CAST(count(*) AS DOUBLE), 6) AS "O",
               round(count(*) FILTER (p = 'P') / CAST(count(*) AS DOUBLE), 6) AS "P"
        FROM ({_PAIRS}) GROUP BY 1""",
    "class_metrics_long": f"""
        WITH m AS ({_PER_CLASS})
        SELECT label, 'precision' AS metric, round(precision, 6) AS value FROM m
        UNION ALL SELECT label, 'recall', round(recall, 6) FROM m
        UNION ALL SELECT label, 'f1', round(f1, 6) FROM m""",
    "model_comparison": f"""
        WITH m AS ({_PER_CLASS}), k AS ({_PER_CLASS.replace(_PAIRS, _CONSTANT)})
        SELECT 'rule' AS model, 'accuracy' AS metric, round({_accuracy(_PAIRS)}, 6) AS value
        UNION ALL SELECT 'rule', 'f1_macro', round(avg(f1), 6) FROM m
        UNION ALL SELECT 'constant', 'accuracy', round({_accuracy(_CONSTANT)}, 6)
        UNION ALL SELECT 'constant', 'f1_macro', round(avg(f1), 6) FROM k""",
}
