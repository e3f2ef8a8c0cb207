"""The raw layer: whole extracts appended as loads, each row stamped with its load."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, types as T
from pyspark.sql import functions as F

from stratafold.functions.types import wider_type

LOAD_ID = "_load_id"
LOAD_TIME = "_load_time"
#: Table property that changes with every load written.
LAST_WRITE = "stratafold.last_write"
#: Codec of stored tables: keys and texts take about two thirds of what Spark's default gives.
COMPRESSION = "zstd"
_WIDE = "__wide"


def stamp(df: DataFrame, load_id: str, load_time: datetime | str) -> DataFrame:
    """Every row with the text id and the time of its load."""
    return df.withColumns({
        LOAD_ID: F.lit(load_id),
        LOAD_TIME: F.lit(str(load_time)).cast("timestamp_ntz"),
    })


def append_load(df: DataFrame, table: str, load_id: str, load_time: datetime | str,
                add_columns: bool = False, widen: bool = False) -> int:
    """Append one extract as a load and return its row count.

    With ``add_columns`` a column the table does not have yet is added, NULL in earlier
    loads, and one that the extract lacks is NULL in this load; else both are refused.
    With ``widen`` a column whose type changed gets the narrowest type that holds both
    (``wider_type``), and earlier loads are read under it; a pair without such a type is
    refused. Without it the load is stored under the table's types, as INSERT casts it.

    The load is one partition, and writing it again replaces that partition, so a
    job repeated after a failure leaves no rows twice.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.\-]+", load_id):
        raise ValueError(f"load id {load_id!r} is not usable as a partition name")
    spark = df.sparkSession
    stamped = stamp(df, load_id, load_time)
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(table + _WIDE):
        spark.sql(f"ALTER TABLE {table}{_WIDE} RENAME TO {table}")  # a widening that was cut off
    if not spark.catalog.tableExists(table):
        _create(spark, table, stamped.schema, _place(spark, table) if widen else None)
    known = spark.table(table).columns
    if add_columns:
        new = [f for f in stamped.schema if f.name not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({T.StructType(new).toDDL()})")
            known = spark.table(table).columns
        kinds = {f.name: f.dataType for f in spark.table(table).schema}
        stamped = stamped.withColumns({
            name: F.lit(None).cast(kinds[name]) for name in known if name not in stamped.columns})
    if sorted(known) != sorted(stamped.columns):
        raise ValueError(f"{table} has columns {sorted(known)}, the load {sorted(stamped.columns)}")
    if widen:
        types = _common_types(table, spark.table(table).schema, stamped.schema)
        if any(types[f.name] != f.dataType for f in spark.table(table).schema):
            _retype(spark, table, types)
        stamped = stamped.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
    written = Observation()
    load = stamped.select(*[name for name in known if name != LOAD_ID]).observe(
        written, F.count(F.lit(1)).alias("rows"))
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({LOAD_ID} = '{load_id}') SELECT * FROM {{load}}",
              load=load)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LAST_WRITE}' = '{load_id} {uuid.uuid4().hex}')")
    return written.get["rows"]


def _place(spark: SparkSession, table: str) -> str:
    """A folder of its own in the table's database. Files there belong to no managed table, so a
    table can be declared anew over them."""
    *database, name = table.split(".")
    root = spark.catalog.getDatabase(database[0] if database else spark.catalog.currentDatabase()).locationUri
    return f"{root}/{name}_{uuid.uuid4().hex[:12]}"


def _create(spark: SparkSession, table: str, schema: T.StructType, place: str | None) -> None:
    at = f" LOCATION '{place}'" if place else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}) USING parquet "
              f"OPTIONS (compression '{COMPRESSION}') PARTITIONED BY ({LOAD_ID}){at}")


def _common_types(table: str, known: T.StructType, loaded: T.StructType) -> dict[str, T.DataType]:
    types, refused = {}, []
    for field in known:
        kind = wider_type(field.dataType, loaded[field.name].dataType)
        if kind is None:
            refused.append(f"{field.name}: {field.dataType.simpleString()} and "
                           f"{loaded[field.name].dataType.simpleString()}")
        types[field.name] = kind
    if refused:
        raise ValueError(f"{table} and the load have no common type for {', '.join(refused)}")
    return types


def _retype(spark: SparkSession, table: str, types: Mapping[str, T.DataType]) -> None:
    """Gives a raw table wider types.

    A table with a folder of its own is declared anew over the same files, which Parquet reads under
    the wider types; nothing is rewritten. The loads of one created without ``widen`` are rewritten
    once. The new table is whole before it takes the old one's name.
    """
    schema = T.StructType([T.StructField(f.name, types[f.name], f.nullable, f.metadata)
                           for f in spark.table(table).schema])
    told = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if row[0]}
    wide, external = table + _WIDE, told["Type"] == "EXTERNAL"
    spark.sql(f"DROP TABLE IF EXISTS {wide}")
    _create(spark, wide, schema, told["Location"] if external else _place(spark, table))
    if external:
        spark.sql(f"ALTER TABLE {wide} RECOVER PARTITIONS")
    else:
        with_types = spark.table(table).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        spark.sql(f"INSERT INTO {wide} SELECT * FROM {{rows}}", rows=with_types)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {wide} RENAME TO {table}")


def last_write(spark: SparkSession, table: str) -> str | None:
    """What the newest write of a raw table is known by: its mark, else the newest load id; None
    for a table that is neither marked nor partitioned by load."""
    marks = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if LAST_WRITE in marks:
        return marks[LAST_WRITE]
    if LOAD_ID not in [c.name for c in spark.catalog.listColumns(table) if c.isPartition]:
        return None
    return load_ids(spark, table).agg(F.max(LOAD_ID)).first()[0] or "no load"


def replace_load(df: DataFrame, table: str) -> None:
    """Drop the history: the table holds this extract only."""
    df.write.mode("overwrite").saveAsTable(table)


def load_ids(spark: SparkSession, table: str) -> DataFrame:
    """The load ids of a raw table from the catalog's partition list, without a data scan."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.substring_index("partition", "=", -1)
    return listed.select(F.when(value != "__HIVE_DEFAULT_PARTITION__", value).alias(LOAD_ID))


def load_report(df: DataFrame) -> DataFrame:
    """Rows per load."""
    return df.groupBy(LOAD_ID).agg(F.count(F.lit(1)).alias("rows"))
