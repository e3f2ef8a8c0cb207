"""Writing tables out: CSV folders, decimals instead of floats, external destinations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from stratafold.sources.tables import CSV_QUOTING

# Destination -> Spark data source that writes it.
DESTINATIONS = {
    "postgres": "jdbc",
    "mssql": "jdbc",
    "duckdb": "jdbc",
    "mysql": "jdbc",
    "sqlalchemy": "jdbc",
    "snowflake": "snowflake",
    "bigquery": "bigquery",
    "redshift": "jdbc",
    "athena": "parquet",
}


def doubles_to_decimal(df: DataFrame, precision: int = 18, scale: int = 2) -> DataFrame:
    """Every float column as DECIMAL(precision, scale); the others unchanged."""
    target = T.DecimalType(precision, scale)
    floats = (T.DoubleType, T.FloatType)
    return df.select(*[
        F.col(f.name).cast(target).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name)
        for f in df.schema
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; one file per task below ``path``, quotes in values doubled."""
    df.write.mode("overwrite").options(**CSV_QUOTING).csv(path)


def write_to(df: DataFrame, destination: str, table: str, mode: str = "append",
             options: Mapping[str, str] | None = None) -> None:
    """Write to a named destination; connection options are those of its data source."""
    if destination not in DESTINATIONS:
        raise ValueError(f"unknown destination {destination!r}, known: {sorted(DESTINATIONS)}")
    source = DESTINATIONS[destination]
    writer = df.write.format(source).mode(mode).options(**(options or {}))
    if source == "parquet":
        writer.saveAsTable(table)
    else:
        writer.option("dbtable" if source != "bigquery" else "table", table).save()
