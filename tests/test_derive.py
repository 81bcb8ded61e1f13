import datetime as dt

import pytest

from millrace.operators.derive import GeoCluster, YearGap, map_points
from tests.conftest import values


def test_year_gap(frame):
    df = frame(
        [(1, "2013-03-14", 2000.0), (2, "2005-01-01", 2010.0), (3, "2011-05-05", None), (4, "bad", 2000.0),
         (5, "03/14/2011", 2001.0), (6, None, 2000.0)],
        "id int, date_recorded string, construction_year double",
    )
    out = YearGap().transform(df)
    assert values(out, "pump_age") == [13.0, None, None, None, 10.0, None]
    assert out.columns == ["id", "date_recorded", "construction_year", "pump_age"]


def test_year_gap_of_dates_and_text_years(frame):
    df = frame([(1, dt.date(2020, 1, 1), "2010"), (2, dt.date(2020, 1, 1), "n/a")], "id int, d date, y string")
    out = YearGap(reference_column="d", construction_column="y", output_column="age").transform(df)
    assert values(out, "age") == [10.0, None]


def test_year_gap_refuses_an_encoded_date(frame):
    df = frame([(1, 3.0, 2000.0)], "id int, date_recorded double, construction_year double")
    with pytest.raises(ValueError, match="before the encoder"):
        YearGap().transform(df)


def test_clusters(frame):
    df = frame(
        [(1, 0.0, 0.0), (2, 0.1, 0.1), (3, 10.0, 10.0), (4, 10.1, 9.9), (5, None, 1.0), (6, 1.0, None)],
        "id int, latitude double, longitude double",
    )
    model = GeoCluster(n_clusters=2).fit(df)
    out = values(model.transform(df), "geo_cluster")
    assert set(out[:4]) == {0.0, 1.0}
    assert out[0] == out[1] and out[2] == out[3] and out[0] != out[2]
    assert out[4:] == [None, None]
    unseen = frame([(1, 0.2, 0.0), (2, 9.0, 9.0)], "id int, latitude double, longitude double")
    assert values(model.transform(unseen), "geo_cluster") == [out[0], out[2]]


def test_cluster_parameters(spark):
    with pytest.raises(ValueError):
        GeoCluster(n_clusters=1)


def test_map_points(frame):
    df = frame(
        [(1, 1.0, 2.0, "functional"), (2, 0.0, 2.0, "functional"), (3, None, 2.0, "x"), (4, 3.0, 4.0, "other")],
        "id int, latitude double, longitude double, prediction string",
    )
    out = map_points(df, id_col="id")
    assert sorted(r["lat"] for r in out.collect()) == [1.0, 3.0]
    assert {r["prediction"]: r["colour"] for r in out.collect()} == {"functional": "#2196F3", "other": "#999999"}
    many = frame([(i, 1.0, 1.0, "functional") for i in range(1, 100)], "id int, latitude double, longitude double, prediction string", 5)
    assert map_points(many, id_col="id", max_points=10).count() == 10
