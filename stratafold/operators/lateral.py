"""Lateral top rows: for each outer row, the first n inner rows of its key in a given order.

Without a further condition the rows of a key are the same for every outer row, so each task
keeps n rows a key before anything is shuffled. With one (a condition over both sides), inner
rows are numbered within their key and cut into levels that double in size; each distinct outer
key and condition value asks the first level, and only those still short of n ask the next. So a
hot key is met a bounded number of rows at a time, and never with all its outer rows at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.operators.joins import keyed_join
from stratafold.operators.windows import numbered
from stratafold.session import new_folder

LEVEL_ROWS = 64


def top_per_key(inner: DataFrame, keys: Iterable[str], order: Iterable[Column], n: int,
                name: str = "place") -> DataFrame:
    """The first n rows of each key in order, ties by a hash of the row, with their place.

    The limit holds within each task before the shuffle, so a hot key sends n rows a task.
    Rows that lack a key are left out, as nothing can ask for them.
    """
    keys = list(keys)
    for key in keys:
        inner = inner.where(F.col(key).isNotNull())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*inner.columns)))
    return inner.withColumn(name, place).where(F.col(name) <= n)


def lateral_top(outer: DataFrame, inner: DataFrame, on: Mapping[str, str], order: Iterable[Column], n: int,
                residual: Column | None = None, params: Iterable[str] = (), how: str = "inner",
                place: str = "place", level_rows: int = LEVEL_ROWS) -> DataFrame:
    """``outer CROSS JOIN LATERAL (SELECT * FROM inner WHERE keys AND residual ORDER BY order LIMIT n)``.

    ``on`` pairs outer with inner key columns (the latter are dropped); ``order`` is over inner
    columns, ties follow a hash of the inner row. ``residual`` may use inner columns and the outer
    columns named in ``params``; no other outer column. ``how="left"`` keeps outer rows without a
    match. Column names of both sides must differ. ``place`` is the rank among an outer row's matches.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a lateral join is inner or left, not {how!r}")
    if n < 1:
        raise ValueError("at least one row must be asked for")
    params, order = list(params), list(order)
    both = {c.lower() for c in outer.columns} & {c.lower() for c in (*inner.columns, place)}
    if both:
        raise ValueError(f"both sides have {sorted(both)}")
    if residual is None:
        return keyed_join(outer, top_per_key(inner, on.values(), order, n, place), on, how)
    asked = list(dict.fromkeys([*on, *params]))
    found = _found(outer.select(*asked).distinct(), inner, on, order, n, residual, place, level_rows)
    names = {c: f"_o{i}" for i, c in enumerate(asked)}
    return keyed_join(outer, found.withColumnsRenamed(names), names, how, null_safe=True)


def _found(asking: DataFrame, inner: DataFrame, on: Mapping[str, str], order: list[Column], n: int,
           residual: Column, place: str, level_rows: int) -> DataFrame:
    """The matches of each distinct asker, level by level; a round's result is written to cut its plan."""
    spark, asked = asking.sparkSession, asking.columns
    for key in on.values():
        inner = inner.where(F.col(key).isNotNull())
    for key in on:
        asking = asking.where(F.col(key).isNotNull())
    ranked = _stored(numbered(inner, on.values(), order, "_rank"), "lateral_ranked")
    # Level 0 has the first level_rows ranks; each later level has as many as all before it.
    level = F.when(F.col("_rank") <= level_rows, 0).otherwise(
        F.ceil(F.log2(F.col("_rank") / level_rows)).cast("int"))
    ranked = ranked.withColumn("_level", level)
    deepest = ranked.agg(F.max("_level")).first()[0]
    if deepest is None:
        return asking.join(ranked.drop("_level", "_rank", *on.values()), F.lit(False)).withColumn(
            place, F.lit(0))
    pending = asking.withColumn("_have", F.lit(0))
    done = None
    for depth in range(deepest + 1):
        rows = ranked.where(F.col("_level") == depth).drop("_level")
        pairs = keyed_join(pending, rows, on, "inner", residual)
        within = Window.partitionBy(*asked).orderBy("_rank")
        hits = (pairs.withColumn("_nth", F.row_number().over(within)).where(F.col("_nth") <= n)
                .withColumn(place, F.col("_nth") + F.col("_have")).where(F.col(place) <= n))
        hits = _stored(hits.drop("_rank", "_nth", "_have"), "lateral_hits")
        done = hits if done is None else done.unionByName(hits)
        if depth == deepest:
            break
        counts = hits.groupBy(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(asked)]).agg(
            F.max(place).alias("_now"))
        same = {c: f"_c{i}" for i, c in enumerate(asked)}
        pending = keyed_join(pending, counts, same, "left", null_safe=True)
        short = pending.withColumn("_have", F.coalesce("_now", "_have")).drop("_now").where(F.col("_have") < n)
        # Only keys that have rows further down ask on.
        deeper = ranked.where(F.col("_level") == depth + 1).select(*on.values()).distinct()
        pending = _stored(keyed_join(short, deeper, on, "left_semi"), "lateral_pending")
        if pending.isEmpty():
            break
    return done


def _stored(df: DataFrame, label: str) -> DataFrame:
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
