"""Declared against actual schemas, as small frames of column rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.contract import TableContract, contract_rows
from stratafold.functions.rows import rows_frame
from stratafold.functions.types import canonical_type, canonical_type_column

SCHEMA_ROWS = ("table_name string, position int, column_name string, data_type string, "
               "canonical_type string, description string")


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per actual column; only schemas are looked at, no job reads data."""
    rows = [
        (name.lower(), position, f.name.lower(), f.dataType.simpleString(),
         canonical_type(f.dataType.simpleString().split("<")[0], "spark"),
         f.metadata.get("comment"))
        for name, df in tables.items()
        for position, f in enumerate(df.schema, start=1)
    ]
    return rows_frame(spark, rows, SCHEMA_ROWS)


def catalog_rows(information_schema: DataFrame, engine: str) -> DataFrame:
    """The same rows from another engine's information_schema.columns, read over JDBC."""
    return information_schema.select(
        F.lower("table_name").alias("table_name"),
        F.col("ordinal_position").cast("int").alias("position"),
        F.lower("column_name").alias("column_name"),
        F.col("data_type").alias("data_type"),
        canonical_type_column(F.col("data_type"), engine).alias("canonical_type"),
        F.lit(None).cast("string").alias("description"),
    ).orderBy("table_name", "position")


def schema_diff(spark: SparkSession, contracts: Iterable[TableContract], actual: DataFrame,
                strict: bool = False) -> DataFrame:
    """One row per column that is declared or present, with its status.

    ok, missing_column, extra_column, type_mismatch, missing_table, extra_table; an
    actual type UNKNOWN is not compared. Canonical types are compared, or with
    ``strict`` the declared Spark type against the actual one.
    """
    contracts = list(contracts)
    types = [(c.name, col.name, col.type.simpleString()) for c in contracts for col in c.columns]
    declared = contract_rows(spark, contracts).select(
        F.col("table_name").alias("e_table"), F.col("column_name").alias("e_column"),
        F.col("canonical_type").alias("expected_type"))
    compared, expected = F.col("canonical_type"), F.col("expected_type")
    if strict:
        exact = rows_frame(spark, types, "s_table string, s_column string, s_type string")
        declared = declared.join(
            exact, (F.col("e_table") == F.col("s_table")) & (F.col("e_column") == F.col("s_column")))
        compared, expected = F.col("data_type"), F.col("s_type")
    named = [c.name for c in contracts]
    present = actual.select("table_name").distinct().select(F.col("table_name").alias("present"))
    both = (
        declared.join(actual, (F.col("e_table") == F.col("table_name"))
                      & (F.col("e_column") == F.col("column_name")), "full")
        .withColumn("table", F.coalesce("e_table", "table_name"))
        .withColumn("column", F.coalesce("e_column", "column_name"))
        .join(present, F.col("table") == F.col("present"), "left")
    )
    status = (
        F.when(F.col("present").isNull(), "missing_table")
        .when(~F.col("table").isin(named), "extra_table")
        .when(F.col("column_name").isNull(), "missing_column")
        .when(F.col("e_column").isNull(), "extra_column")
        .when((F.col("canonical_type") != "UNKNOWN") & (expected != compared), "type_mismatch")
        .otherwise("ok")
    )
    return both.select(
        F.col("table").alias("table_name"), F.col("column").alias("column_name"),
        "expected_type", F.col("canonical_type").alias("actual_type"), status.alias("status"))


# What counts as an error when models are checked and when stored tables are checked:
# a declared table may still be absent from storage, but every one needs a model.
ERRORS = {
    "models": ["missing_column", "extra_column", "type_mismatch", "missing_table"],
    "stored": ["missing_column", "extra_column", "type_mismatch"],
}


def conforms(diff: DataFrame, side: str) -> bool:
    """Pass or fail of a diff; extra tables are only noted on either side.

    With no contract at all both sides fail. With no actual table, models fail and
    stored tables pass.
    """
    counts = diff.agg(
        F.count_if(F.col("expected_type").isNotNull()).alias("declared"),
        F.count_if(F.col("actual_type").isNotNull()).alias("actual"),
        F.count_if(F.col("status").isin(ERRORS[side])).alias("errors"),
    ).first()
    if counts.actual == 0:
        return side == "stored"
    return counts.declared > 0 and counts.errors == 0


def key_sets(spark: SparkSession, declared: Iterable[TableContract],
             modelled: Iterable[TableContract]) -> DataFrame:
    """Declared keys against those a model states: ok, missing or extra per key column.

    A table whose contract declares no key of a kind is not compared on that kind.
    """

    def rows(contracts: Iterable[TableContract]) -> list[tuple]:
        return [(c.name, kind, column) for c in contracts
                for kind, columns in (("pk", c.pk), ("fk", c.reference_columns))
                for column in dict.fromkeys(columns)]

    modelled = list(modelled)
    expected, actual = rows(declared), rows(modelled)
    compared = {(table, kind) for table, kind, _ in expected}
    stated = {table for table, _, _ in actual} | {c.name for c in modelled}
    shape = "table_name string, kind string, column_name string"
    left = rows_frame(spark, [r for r in expected if r[0] in stated], shape)
    right = rows_frame(spark, [r for r in actual if r[:2] in compared], shape)
    marked = left.withColumn("e", F.lit(True)).join(
        right.withColumn("a", F.lit(True)), ["table_name", "kind", "column_name"], "full")
    status = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra")
    return marked.select("table_name", "kind", "column_name", status.otherwise("ok").alias("status"))


def missing_descriptions(spark: SparkSession, declared: Iterable[TableContract],
                         modelled: Iterable[TableContract]) -> DataFrame:
    """Described tables (column NULL) and columns whose model carries no description."""
    models = {c.name: c for c in modelled}
    rows = []
    for contract in declared:
        model = models.get(contract.name)
        if model is None:
            continue
        described = {c.name for c in model.columns if c.description}
        if contract.description and not model.description:
            rows.append((contract.name, None))
        rows += [(contract.name, c.name) for c in contract.columns
                 if c.description and c.name not in described]
    return rows_frame(spark, rows, "table_name string, column_name string")


def column_fill(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and filled values per column, one scan per table."""

    def counts(name: str, df: DataFrame) -> DataFrame:
        cells = [
            F.struct(F.lit(name.lower()).alias("table_name"), F.lit(column.lower()).alias("column_name"),
                     F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("filled"))
            for i, column in enumerate(df.columns)
        ]
        filled = [F.count(column).alias(f"_n{i}") for i, column in enumerate(df.columns)]
        total = df.agg(F.count(F.lit(1)).alias("_rows"), *filled)
        return total.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")

    return reduce(DataFrame.unionByName, [counts(name, df) for name, df in tables.items()])


def cast_failures(contracts: Iterable[TableContract], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Filled values per declared column, and those that its type can't hold; one scan per table."""

    def counts(contract: TableContract) -> DataFrame:
        found = []
        for i, c in enumerate(contract.columns):
            value = F.col(c.name)
            found += [F.count(value).alias(f"_n{i}"), F.count_if(
                value.isNotNull() & value.try_cast(c.type).isNull()).alias(f"_f{i}")]
        cells = [F.struct(F.lit(contract.name).alias("table_name"), F.lit(c.name).alias("column_name"),
                          F.col(f"_n{i}").alias("filled"), F.col(f"_f{i}").alias("failures"))
                 for i, c in enumerate(contract.columns)]
        return tables[contract.name].agg(*found).select(
            F.explode(F.array(*cells)).alias("cell")).select("cell.*")

    return reduce(DataFrame.unionByName, [counts(contract) for contract in contracts])


def table_summary(spark: SparkSession, contracts: Iterable[TableContract],
                  tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared columns and keys of each contract, with the rows its table holds."""
    declared = contract_rows(spark, contracts).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("columns"), F.count_if("in_pk").alias("pk_columns"),
        F.count_if("in_fk").alias("fk_columns"))
    held = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name.lower()).alias("held"), "rows")
        for name, df in tables.items()
    ])
    return declared.join(held, F.col("table_name") == F.col("held"), "left").drop("held")
