import logging

import pytest

from millrace.operators.clean import CategoricalImputer, ColumnDropper, NumericImputer, ZeroToNull
from millrace.operators.encode import OrdinalEncoder, TargetEncoder
from tests.conftest import values


def test_sentinels_become_null(frame):
    df = frame([(1, 0, 5), (2, 1990, 0), (3, 0, 7), (4, 2005, None)], "id int, construction_year int, other int")
    out = ZeroToNull().transform(df)
    assert values(out, "construction_year") == [None, 1990, None, 2005]
    assert values(out, "other") == [5, 0, 7, None]
    assert out.dtypes == df.dtypes
    assert values(df, "construction_year") == [0, 1990, 0, 2005]


def test_sentinels_keep_nulls_and_skip_absent_and_text(frame):
    df = frame([(1, None, "0"), (2, 0.0, "x")], "id int, a double, t string")
    out = ZeroToNull(columns=["a", "t", "gone"]).transform(df)
    assert values(out, "a") == [None, None]
    assert values(out, "t") == ["0", "x"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_median(frame, partitions):
    df = frame([(1, 1.0), (2, 3.0), (3, None), (4, 5.0), (5, 7.0)], "id int, val double", partitions)
    model = NumericImputer(idCol="id").fit(df)
    assert values(model.transform(df), "val") == [1.0, 3.0, 4.0, 5.0, 7.0]
    unseen = frame([(1, None), (2, 10.0)], "id int, val double")
    assert values(model.transform(unseen), "val") == [4.0, 10.0]


def test_mean_and_constant(frame):
    df = frame([(1, 0.0), (2, 4.0), (3, None)], "id int, val double")
    assert values(NumericImputer(strategy="mean", idCol="id").fit(df).transform(df), "val")[2] == 2.0
    filled = NumericImputer(strategy="constant", fill_value=-1.0, idCol="id").fit(df).transform(df)
    assert values(filled, "val")[2] == -1.0


def test_numeric_imputer_leaves_id_label_and_text(frame):
    df = frame([(1, 2, 1, "a"), (2, None, None, None)], "id long, x int, y int, t string")
    out = NumericImputer(idCol="id", labelCol="y").fit(df).transform(df)
    assert dict(out.dtypes) == {"id": "bigint", "x": "double", "y": "int", "t": "string"}
    assert values(out, "y") == [1, None]
    assert values(out, "x") == [2.0, 2.0]


def test_numeric_imputer_named_columns_and_estimate(frame):
    df = frame([(1, 1.0, None), (2, None, 3.0), (3, 3.0, 3.0)], "id int, a double, b double")
    out = NumericImputer(columns=["a"], approx=True).fit(df).transform(df)
    assert values(out, "a")[1] in (1.0, 3.0)
    assert values(out, "b")[0] is None


def test_all_null_column_stays_null(frame, caplog):
    df = frame([(1, None), (2, None)], "id int, val double")
    with caplog.at_level(logging.WARNING):
        out = NumericImputer(idCol="id").fit(df).transform(df)
    assert values(out, "val") == [None, None]
    assert "val" in caplog.text


@pytest.mark.parametrize("partitions", [1, 7])
def test_most_frequent(frame, partitions):
    df = frame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, col string", partitions)
    assert values(CategoricalImputer().fit(df).transform(df), "col") == ["a", "a", "b", "a"]


def test_most_frequent_tie_takes_smallest_and_empty_takes_fill(frame):
    df = frame([(1, "b", None), (2, "a", None), (3, None, None)], "id int, col string, empty string")
    out = CategoricalImputer(fill_value="none").fit(df).transform(df)
    assert values(out, "col") == ["b", "a", "a"]
    assert values(out, "empty") == ["none"] * 3


def test_text_constant(frame):
    df = frame([(1, "a"), (2, None)], "id int, col string")
    assert values(CategoricalImputer(strategy="constant").fit(df).transform(df), "col") == ["a", "unknown"]


def test_drop_columns(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert ColumnDropper(columns_to_drop=["a", "zzz"]).transform(df).columns == ["b", "c"]
    assert ColumnDropper().transform(df).columns == ["a", "b", "c"]
    with pytest.raises(ValueError, match="id or label"):
        ColumnDropper(columns_to_drop=["a"], idCol="a").transform(df)


@pytest.mark.parametrize(
    ("stage", "params"),
    [
        (NumericImputer, {"strategy": "mode"}),
        (CategoricalImputer, {"strategy": "median"}),
        (NumericImputer, {"nonsense": 1}),
        (TargetEncoder, {"smoothing": 0.0}),
        (OrdinalEncoder, {"handle_unknown": "ignore"}),
    ],
)
def test_parameters_are_checked(spark, stage, params):
    with pytest.raises((ValueError, TypeError)):
        stage(**params)


def test_preparation_chain(frame):
    df = frame(
        [
            (1, 0, 100, "gov", "spring", "f"),
            (2, 2000, 0, None, "river", "n"),
            (3, 1990, 50, "gov", None, "f"),
            (4, 2010, 75, "ngo", "spring", "n"),
        ],
        "id int, construction_year int, gps_height int, funder string, source string, y string",
    )
    keys = {"idCol": "id", "labelCol": "y"}
    for stage in (
        ZeroToNull(**keys),
        NumericImputer(**keys),
        CategoricalImputer(**keys),
        TargetEncoder(columns=["funder"], **keys),
        OrdinalEncoder(**keys),
    ):
        df = stage.fit(df).transform(df) if hasattr(stage, "fit") else stage.transform(df)
    rows = df.collect()
    assert all(v is not None for r in rows for v in r)
    assert [c for c, t in df.dtypes if t == "string"] == ["y"]
