import pytest

from millrace.functions import values as values_module
from millrace.operators import encode
from millrace.operators.encode import FrequencyEncoder, OrdinalEncoder, TargetEncoder
from tests.conftest import values


@pytest.fixture(params=["literal", "broadcast", "salted"])
def path(request, monkeypatch):
    """The three ways a fitted table is applied must agree."""
    if request.param != "literal":
        monkeypatch.setattr(encode, "LITERAL_ROWS", -1)
    if request.param == "salted":
        monkeypatch.setattr(values_module, "BROADCAST_ROWS", -1)
    return request.param


@pytest.mark.parametrize("partitions", [1, 7])
def test_ordinal(frame, path, partitions):
    df = frame([(1, "bird"), (2, "cat"), (3, "dog"), (4, "cat"), (5, None)], "id int, col string", partitions)
    model = OrdinalEncoder(idCol="id").fit(df)
    assert values(model.transform(df), "col") == [0.0, 1.0, 2.0, 1.0, None]
    assert dict(model.transform(df).dtypes)["col"] == "double"
    unseen = frame([(1, "zebra"), (2, "cat")], "id int, col string")
    assert values(model.transform(unseen), "col") == [-1.0, 1.0]


def test_ordinal_error_mode(frame, path):
    df = frame([(1, "a"), (2, "b"), (3, None)], "id int, col string")
    model = OrdinalEncoder(handle_unknown="error", idCol="id").fit(df)
    assert values(model.transform(df), "col") == [0.0, 1.0, None]
    with pytest.raises(Exception, match="not seen at fit"):
        model.transform(frame([(1, "c")], "id int, col string")).collect()


def test_ordinal_unknown_value_and_untouched_columns(frame):
    df = frame([(1, "a", 3, "f"), (2, "b", 4, "n")], "id int, col string, x int, y string")
    model = OrdinalEncoder(unknown_value=-99, idCol="id", labelCol="y").fit(df)
    out = model.transform(frame([(1, "q", 3, "f")], "id int, col string, x int, y string"))
    assert out.columns == ["id", "col", "x", "y"]
    assert tuple(out.first()) == (1, -99.0, 3, "f")


def test_ordinal_orders_named_numbers_by_value(frame):
    df = frame([(1, 10), (2, 9), (3, 100)], "id int, n int")
    assert values(OrdinalEncoder(columns=["n"]).fit(df).transform(df), "n") == [1.0, 0.0, 2.0]


@pytest.mark.parametrize("partitions", [1, 7])
def test_target_formula(frame, path, partitions):
    df = frame(
        [(1, "A", 0.0), (2, "A", 2.0), (3, "A", 1.0), (4, "B", 2.0), (5, "B", 2.0)],
        "id int, funder string, y double",
        partitions,
    )
    model = TargetEncoder(columns=["funder"], idCol="id", labelCol="y").fit(df)
    assert values(model.transform(df), "funder") == pytest.approx([1.1, 1.1, 1.1, 1.8, 1.8])
    unseen = frame([(1, "C"), (2, None)], "id int, funder string")
    assert values(model.transform(unseen), "funder") == pytest.approx([1.4, 1.4])


def test_target_heavy_smoothing(frame):
    df = frame([(1, "A", 0.0), (2, "A", 2.0), (3, "A", 1.0), (4, "B", 2.0), (5, "B", 2.0)], "id int, f string, y double")
    out = TargetEncoder(columns=["f"], smoothing=1e6, labelCol="y").fit(df).transform(df)
    assert values(out, "f") == pytest.approx([1.4] * 5, abs=1e-4)


def test_target_text_label_and_null_labels(frame):
    df = frame(
        [(1, "gov", "functional"), (2, "gov", "non functional"), (3, "ngo", "non functional"), (4, "new", None)],
        "id int, installer string, y string",
    )
    model = TargetEncoder(idCol="id", labelCol="y").fit(df)
    g = 2 / 3
    assert values(model.transform(df), "installer") == pytest.approx([(1 + g) / 3, (1 + g) / 3, (1 + g) / 2, g])


def test_target_needs_a_label(frame):
    with pytest.raises(ValueError, match="label"):
        TargetEncoder().fit(frame([(1, "a")], "id int, f string"))


@pytest.mark.parametrize("partitions", [1, 7])
def test_frequency(frame, path, partitions):
    df = frame([(i, f) for i, f in enumerate(["gov", "gov", "gov", "ngo", "ngo"])], "id int, funder string", partitions)
    model = FrequencyEncoder(idCol="id").fit(df)
    out = model.transform(df)
    assert out.columns == ["id", "funder", "funder_freq"]
    assert values(out, "funder_freq") == pytest.approx([0.6, 0.6, 0.6, 0.4, 0.4])
    unseen = frame([(1, "other"), (2, None)], "id int, funder string")
    assert values(model.transform(unseen), "funder_freq") == [0.0, 0.0]


def test_frequency_counts_null_rows_and_takes_a_suffix(frame):
    df = frame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id int, f string")
    out = FrequencyEncoder(output_suffix="_share").fit(df).transform(df)
    assert values(out, "f_share") == [0.5, 0.5, 0.0, 0.25]


def test_hot_value_in_a_salted_lookup(frame, monkeypatch):
    """A third of the rows in one category, more categories than are broadcast."""
    monkeypatch.setattr(encode, "LITERAL_ROWS", -1)
    monkeypatch.setattr(values_module, "BROADCAST_ROWS", 10)
    rows = [(i, "hot" if i % 3 == 0 else f"c{i}" if i % 3 == 1 else None) for i in range(1500)]
    df = frame(rows, "id int, c string", 6)
    out = FrequencyEncoder(idCol="id").fit(df).transform(df)
    assert out.count() == 1500
    got = {r["id"]: r["c_freq"] for r in out.collect()}
    want = {i: 500 / 1500 if c == "hot" else 1 / 1500 if c else 0.0 for i, c in rows}
    assert got == pytest.approx(want)


def test_model_without_text_columns_changes_nothing(frame):
    df = frame([(1, 2.0, 1)], "id int, x double, y int")
    for stage in (OrdinalEncoder(), FrequencyEncoder(), TargetEncoder(labelCol="y")):
        assert stage.fit(df).transform(df).columns == ["id", "x", "y"]
