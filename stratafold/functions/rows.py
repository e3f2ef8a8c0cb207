"""A few constant rows as a frame whose small size Spark can see."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F


def rows_frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows of a DDL schema, for seeds, code lists and schema descriptions."""
    fields = T.StructType.fromDDL(schema)
    text = json.dumps([dict(zip(fields.names, row)) for row in rows])
    parsed = F.from_json(F.lit(text), T.ArrayType(fields))
    return spark.range(1).select(F.inline(parsed))
