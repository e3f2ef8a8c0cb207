"""Window results without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, types as T
from pyspark.sql import functions as F

from stratafold.operators.joins import keyed_join
from stratafold.session import new_folder

_MARKS = [T.StructField("_range", T.IntegerType()), T.StructField("_at", T.LongType()),
          T.StructField("_local", T.LongType()), T.StructField("_first", T.BooleanType())]


def numbered(df: DataFrame, partition: Iterable[str], order: Iterable[str | Column], name: str,
             ranges: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY partition ORDER BY order).

    The rows are shuffled once: ranged over (partition, order), so a large group spans many
    tasks, and numbered inside each sorted range while it streams by. Only a range's first
    group can have begun earlier, so one row a range says how far its numbers are shifted.
    Ties are ordered by a hash of the row, so they span ranges as well. The numbered ranges
    are written once, because shifting reads them again.
    """
    keys, spark = list(partition), df.sparkSession
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    by = [*keys, *order, "_tie"]
    ranged = tied.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie")
    folder = new_folder(spark, "numbered")
    _number_ranges(ranged, keys).write.parquet(folder)
    local = spark.read.parquet(folder)
    shifts = F.broadcast(_shifts(local, keys))  # at most one row a range
    number = F.col("_local") + F.when(F.col("_first"), F.col("_shift")).otherwise(0)
    return local.join(shifts, "_range").select(*df.columns, number.alias(name))


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; nulls are alike, and so are NaNs."""
    if isinstance(column, pa.ExtensionArray):
        column = column.storage
    one, other = column.slice(1), column.slice(0, max(len(column) - 1, 0))
    differs = pc.fill_null(pc.not_equal(one, other), False)
    if pa.types.is_floating(column.type):
        both = pc.and_(pc.fill_null(pc.is_nan(one), False), pc.fill_null(pc.is_nan(other), False))
        differs = pc.and_not(differs, both)
    return pc.or_(differs, pc.xor(pc.is_null(one), pc.is_null(other))).to_numpy(zero_copy_only=False)


def _number_ranges(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the range, the place in it, the number within the group there, and whether it is the
    range's first group, to sorted partitions."""
    at_keys = [ranged.columns.index(key) for key in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, held, first, last = TaskContext.get().partitionId(), 0, 0, True, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            changed = np.zeros(n, bool)
            for i in at_keys:
                column = batch.column(i)
                if last is not None:  # with the last row of the batch before
                    column = pa.concat_arrays([last.column(i), column])
                    changed |= _changes(column)
                else:
                    changed[1:] |= _changes(column)
            starts = np.flatnonzero(changed)
            begin = np.zeros(n, np.int64)
            begin[starts] = starts
            number = np.arange(n) - np.maximum.accumulate(begin) + 1
            number[:starts[0] if len(starts) else n] += held
            early = np.full(n, first)
            early[starts[0] if len(starts) else n:] = False
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, task, np.int32)), pa.array(rows + np.arange(n)),
                 pa.array(number), pa.array(early)], names=[*batch.schema.names, *(f.name for f in _MARKS)])
            rows, held, first, last = rows + n, int(number[-1]), bool(early[-1]), batch.slice(n - 1)

    return ranged.mapInArrow(run, T.StructType([*ranged.schema, *_MARKS]))


def _shifts(local: DataFrame, keys: list[str]) -> DataFrame:
    """By range, how many rows of its first group lie in earlier ranges."""
    key = F.struct(*keys) if keys else F.struct(F.lit(0))
    ends = local.groupBy("_range").agg(
        F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"),
        F.max_by("_local", "_at").alias("rows"))
    in_order = Window.orderBy("_range")
    running = F.sum("rows").over(Window.partitionBy("last").orderBy("_range"))
    ends = ends.withColumn("running", running)
    before = F.when(F.lag("last").over(in_order).eqNullSafe(F.col("first")), F.lag("running").over(in_order))
    return ends.select("_range", F.coalesce(before, F.lit(0).cast("bigint")).alias("_shift"))


def with_group_total(df: DataFrame, partition: Iterable[str], total: Column, name: str) -> DataFrame:
    """agg OVER (PARTITION BY partition): partial sums first, then joined back per group.

    Rows whose group is NULL are one group, as in a window.
    """
    keys = list(partition)
    totals = df.groupBy(*[F.col(key).alias(f"_g{i}") for i, key in enumerate(keys)]).agg(
        total.alias(name))
    on = {key: f"_g{i}" for i, key in enumerate(keys)}
    return keyed_join(df, totals, on, "left", null_safe=True)
