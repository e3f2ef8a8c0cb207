import pytest

from stratafold.contract import Column, TableContract
from stratafold.operators.conformance import (
    catalog_rows, column_fill, conforms, key_sets, missing_descriptions, schema_diff, schema_rows,
    table_summary)

CLIENT = TableContract.of("CLIENT", [("ID", "VARCHAR(255)"), ("NAME", "VARCHAR(100)"),
                                     ("AGE", "INTEGER")], pk=["ID"])
FUTURE = TableContract.of("FUTURE_TABLE", [("ID", "INTEGER")])


@pytest.fixture
def empty(spark):
    return lambda schema: spark.createDataFrame([], schema)


def check(spark, contracts, tables, strict=False):
    diff = schema_diff(spark, contracts, schema_rows(spark, tables), strict)
    status = {(r.table_name, r.column_name): r.status for r in diff.collect()}
    return status, conforms(diff, "models"), conforms(diff, "stored")


def test_match(spark, empty):
    status, models, stored = check(spark, [CLIENT], {"client": empty("ID string, NAME string, AGE bigint")})
    assert set(status.values()) == {"ok"} and models and stored


@pytest.mark.parametrize("schema, column, expected", [
    ("id string, name string", "age", "missing_column"),
    ("id string, name string, age int, x int", "x", "extra_column"),
    ("id string, name string, age string", "age", "type_mismatch"),
])
def test_differences_fail_on_both_sides(spark, empty, schema, column, expected):
    status, models, stored = check(spark, [CLIENT], {"Client": empty(schema)})
    assert status[("client", column)] == expected
    assert not models and not stored


def test_column_order_and_letter_case_do_not_matter(spark, empty):
    _, models, stored = check(spark, [CLIENT], {"CLIENT": empty("age int, Name string, iD string")})
    assert models and stored


def test_undeclared_table_is_noted_only(spark, empty):
    tables = {"client": empty("id string, name string, age int"), "other": empty("col int")}
    status, models, stored = check(spark, [CLIENT], tables)
    assert status[("other", "col")] == "extra_table" and models and stored


def test_declared_table_may_be_absent_from_storage_but_not_from_the_models(spark, empty):
    tables = {"client": empty("id string, name string, age int")}
    status, models, stored = check(spark, [CLIENT, FUTURE], tables)
    assert status[("future_table", "id")] == "missing_table"
    assert not models and stored


def test_nothing_found_and_nothing_declared(spark, empty):
    _, models, stored = check(spark, [CLIENT], {})
    assert not models and stored
    _, models, stored = check(spark, [], {"client": empty("id string")})
    assert not models and not stored


def test_types_are_compared_loosely_unless_strict(spark, empty):
    contract = TableContract.of("t", [("a", "DECIMAL(10,2)"), ("b", "DATE"), ("c", "INTEGER")])
    tables = {"t": empty("a double, b timestamp, c bigint")}
    status, _, _ = check(spark, [contract], tables)
    assert set(status.values()) == {"ok"}
    status, models, _ = check(spark, [contract], tables, strict=True)
    assert set(status.values()) == {"type_mismatch"} and not models


@pytest.mark.parametrize("declared, actual, same", [
    ("INT", "bigint", True), ("TEXT", "string", True), ("NUMERIC(10,2)", "decimal(18,4)", True),
    ("TIMESTAMP", "date", True), ("DATE", "timestamp_ntz", True), ("VARCHAR(5)", "int", False),
    ("DATE", "string", False), ("DECIMAL(5,2)", "string", False), ("BOOLEAN", "int", False)])
def test_equal_and_different_types(spark, empty, declared, actual, same):
    status, _, _ = check(spark, [TableContract.of("t", [("a", declared)])], {"t": empty(f"a {actual}")})
    assert (status[("t", "a")] == "ok") is same


def test_unknown_actual_types_are_skipped(spark, frame):
    catalog = frame([("T", "A", 1, None)],
                    "table_name string, column_name string, ordinal_position int, data_type string")
    diff = schema_diff(spark, [TableContract.of("t", [("a", "DATE")])], catalog_rows(catalog, "mysql"))
    assert [r.status for r in diff.collect()] == ["ok"]


def test_catalog_rows_of_another_engine(frame):
    catalog = frame(
        [("B", "Y", 2, "jsonb"), ("B", "X", 1, "character varying"), ("A", "Z", 1, "int4")],
        "table_name string, column_name string, ordinal_position int, data_type string")
    found = catalog_rows(catalog, "postgres")
    assert [(r.table_name, r.column_name, r.canonical_type) for r in found.collect()] == [
        ("a", "z", "INTEGER"), ("b", "x", "VARCHAR"), ("b", "y", "JSON")]


def test_key_sets(spark, rows):
    declared = [
        TableContract.of("t", [], pk=["ID", "VERSION"], references=[("a", "p", "x")]),
        TableContract.of("nokeys", []), TableContract.of("unmodelled", [], pk=["id"])]
    modelled = [
        TableContract.of("t", [], pk=["id"], references=[("a", "p", "x"), ("b", "p", "x")]),
        TableContract.of("nokeys", [], pk=["id"])]
    assert rows(key_sets(spark, declared, modelled)) == [
        ("t", "fk", "a", "ok"), ("t", "fk", "b", "extra"),
        ("t", "pk", "id", "ok"), ("t", "pk", "version", "missing")]


def test_missing_descriptions(spark, rows):
    declared = [TableContract("t", (Column("a", "INT", "text"), Column("b", "INT", "text")),
                              description="about t")]
    modelled = [TableContract("t", (Column("a", "INT", "other text"), Column("b", "INT")))]
    assert rows(missing_descriptions(spark, declared, modelled)) == [("t", None), ("t", "b")]
    assert rows(missing_descriptions(spark, declared, declared)) == []


def test_descriptions_travel_with_the_schema(spark, empty):
    contract = TableContract("t", (Column("a", "INTEGER", "the key"),))
    df = spark.createDataFrame([], contract.schema)
    assert schema_rows(spark, {"t": df}).first().description == "the key"


def test_column_fill_and_summary(spark, frame, rows):
    tables = {"client": frame([("1", None, 3), (None, None, 4)], "id string, name string, age int")}
    assert rows(column_fill(tables)) == [
        ("client", "age", 2, 2), ("client", "id", 2, 1), ("client", "name", 2, 0)]
    assert rows(table_summary(spark, [CLIENT], tables)) == [("client", 3, 1, 0, 2)]


def test_many_tables_and_columns(spark, empty):
    contracts = [TableContract.of(f"t{i}", [(f"c{j}", "INTEGER") for j in range(3)])
                 for i in range(100)]
    wide = TableContract.of("wide", [(f"c{j}", "INTEGER") for j in range(200)])
    frames = {c.name: spark.createDataFrame([], c.schema) for c in [contracts[0], wide]}
    tables = {f"t{i}": frames["t0"] for i in range(100)} | {"wide": frames["wide"]}
    status, models, stored = check(spark, [*contracts, wide], tables)
    assert len(status) == 500 and models and stored


def test_model_columns_come_from_the_frame_also_for_unions_stars_and_clocks(spark, frame):
    t = frame([(1, "x")], "id int, name string")
    union = spark.sql("SELECT id AS record_id, 'A' AS source FROM {t} UNION ALL "
                      "SELECT id, 'B' FROM {t}", t=t)
    star = spark.sql("SELECT t.*, 'constant' AS extra_col FROM {t} t", t=t)
    clock = spark.sql("SELECT CURRENT_DATE AS today, CURRENT_TIMESTAMP AS now FROM {t}", t=t)
    found = schema_rows(spark, {"u": union, "s": star, "c": clock}).collect()
    assert [(r.table_name, r.column_name, r.canonical_type) for r in found] == [
        ("u", "record_id", "INTEGER"), ("u", "source", "VARCHAR"),
        ("s", "id", "INTEGER"), ("s", "name", "VARCHAR"), ("s", "extra_col", "VARCHAR"),
        ("c", "today", "DATE"), ("c", "now", "DATE")]
