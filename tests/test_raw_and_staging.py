import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from stratafold.functions.types import wider_type
from stratafold.operators.latest import latest_load, staging
from stratafold.sources import raw, sinks, tables
from stratafold.sources.raw import LOAD_ID, LOAD_TIME, append_load

WHEN = "2024-01-01 10:00:00"


def test_stamp(frame):
    df = raw.stamp(frame([(1,)], "a int"), "L1", WHEN)
    assert df.first() == (1, "L1", datetime(2024, 1, 1, 10))
    assert df.schema[LOAD_ID].dataType == T.StringType()


def test_history_grows_by_load_and_a_repeated_load_replaces_itself(layers, frame, rows):
    table = layers.qualified("raw.t")
    assert raw.append_load(frame([(1, "x"), (2, "y")], "a int, b string"), table, "1995", WHEN) == 2
    assert raw.append_load(frame([("z", 3)], "b string, a int"), table, "1996", WHEN) == 1
    assert rows(layers.table("raw.t"), "a", "b", LOAD_ID) == [
        (1, "x", "1995"), (2, "y", "1995"), (3, "z", "1996")]
    assert layers.table("raw.t").schema[LOAD_ID].dataType == T.StringType()
    raw.append_load(frame([("w", 4)], "b string, a int"), table, "1996", WHEN)
    assert rows(layers.table("raw.t"), "a", LOAD_ID) == [(1, "1995"), (2, "1995"), (4, "1996")]
    assert rows(layers.loads("raw.t")) == [("1995",), ("1996",)]
    assert rows(raw.load_report(layers.table("raw.t"))) == [("1995", 2), ("1996", 1)]


def test_a_load_with_other_columns_or_an_odd_id_is_refused(layers, frame):
    table = layers.qualified("raw.t")
    raw.append_load(frame([(1,)], "a int"), table, "L1", WHEN)
    with pytest.raises(ValueError, match="has columns"):
        raw.append_load(frame([(1, 2)], "a int, b int"), table, "L2", WHEN)
    with pytest.raises(ValueError, match="load id"):
        raw.append_load(frame([(1,)], "a int"), table, "L/2", WHEN)


def test_an_empty_load_adds_no_rows_and_is_not_the_latest(layers, frame, rows):
    table = layers.qualified("raw.t")
    raw.append_load(frame([(1,)], "a int"), table, "L1", WHEN)
    assert raw.append_load(frame([], "a int"), table, "L2", WHEN) == 0
    assert rows(latest_load(layers.table("raw.t")), "a") == [(1,)]


def test_replace_load(layers, frame, rows):
    table = layers.qualified("raw.t")
    raw.replace_load(frame([(1,)], "a int"), table)
    raw.replace_load(frame([(2,)], "a int"), table)
    assert rows(layers.table("raw.t")) == [(2,)]


def test_latest_load_is_text_order_and_skips_null_ids(frame, rows):
    df = frame([(1, "9"), (2, "10"), (3, None)], f"a int, {LOAD_ID} string")
    assert rows(latest_load(df)) == [(1, "9")]
    by_time = frame([(1, "9", 1), (2, "10", 2)], f"a int, {LOAD_ID} string, {LOAD_TIME} int")
    assert rows(latest_load(by_time, by=LOAD_TIME), "a") == [(2,)]


def test_latest_load_of_nothing_is_nothing(frame):
    assert latest_load(frame([], f"a int, {LOAD_ID} string")).count() == 0
    assert latest_load(frame([(1, None)], f"a int, {LOAD_ID} string")).count() == 0


def test_latest_load_reads_one_partition(layers, frame, capsys):
    table = layers.qualified("raw.t")
    for load in ("L1", "L2", "L3"):
        raw.append_load(frame([(1,), (2,)], "a int"), table, load, WHEN)
    latest = latest_load(layers.table("raw.t"), loads=layers.loads("raw.t"))
    latest.explain()
    plan = capsys.readouterr().out
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert LOAD_ID in filters and "Subquery" in filters
    assert latest.count() == 2


def test_staging_is_narrow_and_parses(frame, rows):
    df = raw.stamp(frame([(1, "2024-02-03T00:00:00", "drop")], "k int, d string, x string"), "L1", WHEN)
    staged = staging(df, ["k", "d"], {"d": F.col("d").cast("date")})
    assert staged.columns == ["k", "d", LOAD_ID]
    assert str(staged.first().d) == "2024-02-03"


def test_row_limit(spark):
    df = spark.range(100)
    assert tables.row_limit(df, None) is df
    assert tables.row_limit(df, 7).count() == 7
    assert [r.id for r in tables.row_limit(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "t") == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    split = tables.jdbc_options("jdbc:x", "t", {"user": "u"}, ("id", 1, 100, 8))
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8" and split["user"] == "u"


def test_lower_names(frame):
    assert tables.lower_names(frame([(1, 2)], "ID int, Some_Name int")).columns == ["id", "some_name"]


def test_csv_folder(spark, frame, tmp_path, rows):
    (tmp_path / "b.csv").write_text("KEY,Begin,Amount\n1,2024-01-02T00:00:00,2.5\n")
    sinks.write_csv(frame([(1, "x")], "ID int, Name string"), f"{tmp_path}/a.csv")
    found = tables.read_csv_folder(spark, str(tmp_path))
    assert list(found) == ["a", "b"]
    assert rows(found["a"]) == [(1, "x")]
    assert [(f.name, f.dataType.simpleString()) for f in found["b"].schema] == [
        ("key", "int"), ("begin", "string"), ("amount", "double")]
    declared = T.StructType().add("KEY", "string").add("Begin", "string").add("Amount", "string")
    typed = tables.read_csv_folder(spark, str(tmp_path), {"b": declared})["b"]
    assert typed.first() == ("1", "2024-01-02T00:00:00", "2.5")
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        tables.read_csv_folder(spark, str(empty))


def test_sinks(layers, frame, rows):
    df = sinks.doubles_to_decimal(frame([(1, 2.345, "x")], "a int, b double, c string"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "decimal(18,2)", "string"]
    assert df.first().b == Decimal("2.35")
    sinks.write_to(df, "athena", layers.qualified("silver.t"))
    sinks.write_to(df, "athena", layers.qualified("silver.t"))
    assert layers.table("silver.t").count() == 2
    with pytest.raises(ValueError, match="unknown destination"):
        sinks.write_to(df, "paper", "t")


# --- types that change between loads ---------------------------------------------------------------------

WIDER = [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "int", "bigint"),
    ("float", "double", "double"), ("int", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("decimal(6,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("string", "string", "string"),
    ("bigint", "double", None), ("float", "bigint", None), ("string", "int", None), ("date", "string", None),
    ("decimal(38,2)", "decimal(38,10)", None), ("decimal(5,2)", "double", None), ("date", "timestamp", None),
    ("boolean", "int", None)]


@pytest.mark.parametrize("one, other, both", WIDER)
def test_wider_type(one, other, both):
    kind = lambda name: T.StructType.fromDDL(f"c {name}")[0].dataType
    want = kind(both) if both else None
    assert wider_type(kind(one), kind(other)) == wider_type(kind(other), kind(one)) == want


FIRST = "SELECT 1 AS a, 2 AS b, DATE'2024-01-02' AS d, CAST(1.25 AS DECIMAL(6,2)) AS m, CAST(0.5 AS FLOAT) AS f, 'x' AS s"
SECOND = """SELECT 5000000000 AS a, CAST(7 AS TINYINT) AS b, TIMESTAMP_NTZ'2024-01-02 10:30:00' AS d,
    CAST(123456789.0625 AS DECIMAL(14,4)) AS m, 0.1D AS f, 'y' AS s"""


@pytest.mark.parametrize("managed", [False, True])
def test_earlier_loads_are_read_under_wider_types(layers, spark, rows, managed):
    """A table created with widen keeps its files; one created without is rewritten once."""
    table = layers.qualified("raw.t")
    append_load(spark.sql(FIRST), table, "L1", WHEN, widen=not managed)
    files = set(spark.table(table).inputFiles())
    append_load(spark.sql(SECOND), table, "L2", WHEN, widen=True)
    assert (files <= set(spark.table(table).inputFiles())) is not managed
    assert [t for _, t in spark.table(table).drop("_load_id", "_load_time").dtypes] == [
        "bigint", "int", "timestamp_ntz", "decimal(14,4)", "double", "string"]
    found = spark.table(table).orderBy("_load_id").drop("_load_time").collect()
    day = datetime(2024, 1, 2)
    assert [tuple(r) for r in found] == [
        (1, 2, day, Decimal("1.2500"), 0.5, "x", "L1"),
        (5000000000, 7, day.replace(hour=10, minute=30), Decimal("123456789.0625"), 0.1, "y", "L2")]
    append_load(spark.sql(FIRST), table, "L3", WHEN, widen=True)  # narrower again: stored under the wide types
    assert spark.table(table).where("_load_id = 'L3' and a = 1").count() == 1
    assert spark.table(table).count() == 3 and not spark.catalog.tableExists(table + "__wide")


def test_types_without_a_common_one_are_refused(layers, spark):
    table = layers.qualified("raw.t")
    append_load(spark.sql("SELECT 1 AS a, 2L AS b"), table, "L1", WHEN, widen=True)
    with pytest.raises(ValueError, match="a: int and string, b: bigint and double"):
        append_load(spark.sql("SELECT 'one' AS a, 2D AS b"), table, "L2", WHEN, widen=True)
    assert spark.table(table).count() == 1


def test_a_widening_that_was_cut_off_is_taken_up(layers, spark):
    table = layers.qualified("raw.t")
    append_load(spark.sql("SELECT 1 AS a"), table, "L1", WHEN, widen=True)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__wide")
    append_load(spark.sql("SELECT 2L AS a"), table, "L2", WHEN, widen=True)
    assert sorted(r.a for r in spark.table(table).collect()) == [1, 2]
