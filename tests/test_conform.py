import pytest
from pyspark.sql import functions as F

from stratafold.contract import TableContract
from stratafold.operators.conform import conform

CONTRACT = TableContract.of("t", [
    ("id", "VARCHAR(255)"), ("unmapped", "VARCHAR(100)"), ("n", "INTEGER"), ("d", "DATE")])


def test_mapped_columns_are_cast_and_the_rest_is_typed_null(frame, rows):
    df = frame([(7, 2.5)], "source_id int, volume double")
    found = conform(df, CONTRACT, {"ID": "source_id", "n": F.col("volume")})
    assert rows(found) == [("7", None, 2, None)]
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "string", "int", "date"]
    assert found.schema["id"].metadata["max_length"] == 255


def test_skeleton_has_one_empty_row_per_source_row(frame):
    found = conform(frame([(1,), (2,)], "a int"), CONTRACT)
    assert found.columns == CONTRACT.names
    assert [tuple(r) for r in found.collect()] == [(None,) * 4] * 2


def test_one_source_column_may_fill_several_targets(frame, rows):
    df = frame([("5",)], "code string")
    assert rows(conform(df, CONTRACT, {"id": "code", "n": "code"}), "id", "n") == [("5", 5)]


def test_as_is_keeps_the_source_type(frame):
    found = conform(frame([(1.5,)], "a double"), CONTRACT, {"n": "a"}, as_is=["N"])
    assert found.first().n == 1.5


def test_unknown_targets_and_bad_values(frame, rows):
    df = frame([("JWG",), ("2",)], "a string")
    with pytest.raises(ValueError, match="no column x"):
        conform(df, CONTRACT, {"x": "a"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, CONTRACT, {"n": "a"}).collect()
    assert rows(conform(df, CONTRACT, {"n": "a"}, on_error="null"), "n") == [(None,), (2,)]


def test_long_text_is_kept_and_can_be_stored(layers, frame):
    contract = TableContract.of("t", [("id", "VARCHAR(3)")])
    layers.replace(conform(frame([("abcdef",)], "a string"), contract, {"id": "a"}), "silver.t")
    assert layers.table("silver.t").first().id == "abcdef"


def test_is_one_projection(frame, capsys):
    conform(frame([(1,)], "a int"), CONTRACT, {"n": "a"}).explain()
    assert capsys.readouterr().out.count("Project") == 1
