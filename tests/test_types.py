import pytest
from pyspark.sql import functions as F, types as T

from stratafold.functions.types import (
    BY_ENGINE, alias_map, canonical_type, canonical_type_column, declared_length, spark_type)


@pytest.mark.parametrize("raw, expected", [
    ("INT", "INTEGER"), ("bigint", "INTEGER"), ("SMALLINT", "INTEGER"), ("SERIAL", "INTEGER"),
    ("MEDIUMINT", "INTEGER"), ("INTEGER", "INTEGER"),
    ("VARCHAR(255)", "VARCHAR"), ("text", "VARCHAR"), ("VARCHAR2(20)", "VARCHAR"),
    ("NCLOB", "VARCHAR"), ("TINYTEXT", "VARCHAR"),
    ("NUMERIC(10,2)", "DECIMAL"), ("DECIMAL(18,4)", "DECIMAL"), ("double precision", "DECIMAL"),
    ("DOUBLE", "DECIMAL"), ("MONEY", "DECIMAL"), ("NUMBER(38)", "DECIMAL"), ("REAL", "DECIMAL"),
    ("TIMESTAMP", "DATE"), ("DATETIME2", "DATE"), ("TIME", "DATE"), ("DATE", "DATE"),
    (" VARCHAR (20)", "VARCHAR"),
    # Not mapped without an engine: they come back as they are, in upper case.
    ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH TIME ZONE"), ("BIT", "BIT"), ("bool", "BOOL"),
    ("BLOB", "BLOB"), ("BYTEA", "BYTEA"), ("UUID", "UUID"), ("INTERVAL", "INTERVAL"),
    ("enum", "ENUM"), ("GEOMETRY", "GEOMETRY"), ("", ""), (None, "UNKNOWN"),
])
def test_generic_names(raw, expected):
    assert canonical_type(raw) == expected


@pytest.mark.parametrize("engine, raw, expected", [
    ("postgres", "character varying", "VARCHAR"), ("postgres", "int8", "INTEGER"),
    ("postgres", "timestamp with time zone", "DATE"), ("postgres", "jsonb", "JSON"),
    ("postgres", "double precision", "DECIMAL"), ("postgres", "bool", "BOOLEAN"),
    ("mssql", "bit", "BOOLEAN"), ("mssql", "ntext", "VARCHAR"), ("mssql", "image", "BINARY"),
    ("mssql", "uniqueidentifier", "UUID"), ("mssql", "datetimeoffset", "DATE"),
    ("mysql", "year", "DATE"), ("mysql", "mediumblob", "BINARY"), ("mysql", "tinyint", "INTEGER"),
    ("mysql", "bit", "BIT"),
    ("duckdb", "HUGEINT", "INTEGER"), ("duckdb", "interval", "DATE"), ("duckdb", "BLOB", "BINARY"),
    ("duckdb", "DECIMAL(18,3)", "DECIMAL"),
    ("spark", "string", "VARCHAR"), ("spark", "timestamp_ntz", "DATE"),
    ("spark", "decimal(10,2)", "DECIMAL"), ("spark", "bigint", "INTEGER"),
])
def test_names_of_one_engine(engine, raw, expected):
    assert canonical_type(raw, engine) == expected


@pytest.mark.parametrize("engine", [None, *BY_ENGINE])
def test_column_form_gives_the_same_as_the_function(spark, engine):
    names = [*alias_map(engine), "VARCHAR(12)", "double precision", "Decimal(3,1)", "BIT", "", "Point"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "t string")
    found = df.select("t", canonical_type_column(F.col("t"), engine).alias("c")).collect()
    assert {row.t: row.c for row in found} == {n: canonical_type(n, engine) for n in [*names, None]}


@pytest.mark.parametrize("raw, expected", [
    ("INTEGER", T.IntegerType()), ("BIGINT", T.LongType()), ("VARCHAR2(20)", T.StringType()),
    ("DECIMAL(10,2)", T.DecimalType(10, 2)), ("NUMBER(9)", T.DecimalType(9, 0)),
    ("double precision", T.DoubleType()), ("DATE", T.DateType()),
    ("TIMESTAMP", T.TimestampNTZType()), ("TIMESTAMP WITH TIME ZONE", T.TimestampType()),
    ("BIT", T.BooleanType()), ("GEOMETRY", T.BinaryType()), ("jsonb", T.StringType()),
])
def test_spark_types(raw, expected):
    assert spark_type(raw) == expected


def test_unknown_declared_type_is_an_error():
    with pytest.raises(ValueError, match="HYPERCUBE"):
        spark_type("HYPERCUBE")


def test_declared_length():
    assert declared_length("VARCHAR(20)") == 20
    assert declared_length("varchar2 (7)") == 7
    assert declared_length("DECIMAL(10,2)") is None
    assert declared_length("TEXT") is None
