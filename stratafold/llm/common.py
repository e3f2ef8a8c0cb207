"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from stratafold.session import new_folder

Compute = Callable[[pa.RecordBatch], list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: a cut in its lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of_id(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def with_columns_by_batch(df: DataFrame, fields: list[T.StructField], compute: Compute) -> DataFrame:
    """The frame with columns that ``compute`` makes from each Arrow batch.

    All other columns pass through; a column with the name of a new one is replaced
    (``compute`` still sees it).
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept] + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(f.name)) for f in kept] + made, names=names)

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


def groups_by_size(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about ``most`` at most, one row at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def sampled_splits(df: DataFrame, key: str, parts: int, per_part: int = 32) -> list[int]:
    """At most ``parts`` ascending values of a whole-number column that part it evenly.

    They are quantiles of the distinct values picked by their hash, ``parts * per_part`` of
    them on average, so the same rows give the same splits however they are partitioned. The
    first is the smallest value. Nulls are left out.
    """
    known = df.where(F.col(key).isNotNull()).select(key)
    rows, least = known.agg(F.count(F.lit(1)), F.min(key)).first()
    if not rows:
        return []
    every = max(1, rows // (parts * per_part))
    picked = known.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0)
    values = picked.agg(F.concat(F.array(F.lit(least).cast("bigint")), F.sort_array(
        F.collect_set(F.col(key).cast("bigint")))).alias("values"))
    place = lambda i: F.floor(i.cast("bigint") * F.size("values") / parts).cast("int")
    splits = values.select(F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.get("values", place(i))))
    return sorted(set(splits.first()[0]))


def range_index(splits: list[int]):
    """A function of a whole-number column: which of the ranges that start at the splits it is in."""
    starts = np.array(splits, np.int64)

    @F.pandas_udf("int")
    def index(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(starts, keys.to_numpy(np.int64), "right") - 1
        return pd.Series(np.maximum(at, 0).astype(np.int32))

    return index
