"""Joins that stay balanced when one key holds a large share of the rows.

All of them are plain equi-joins whose left side Spark's adaptive execution can split: it
measures the shuffled bytes of every part when the join runs, splits those a hot key has
swollen (equal rows too), and broadcasts a right side that proves small. So nothing is
looked at while a frame is built, and no size switch changes a result.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KINDS = ("inner", "left", "left_semi", "left_anti")
_REPEAT_BLOCK = 10_000
FEW_COPIES = 64
JOIN_ON_TRUE_BYTES = 1 << 20


def keyed_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str,
               residual: Column | None = None, null_safe: bool = False) -> DataFrame:
    """Equi-join (inner, left, left_semi or left_anti) on {left column: right column}.

    Right key columns are dropped. ``residual`` is a further condition; with ``null_safe``
    NULL keys match each other. Other kinds are refused: only the left side's hot keys can
    be split in all four. Keys of two types compare as Spark compares the types.
    """
    if how not in _KINDS:
        raise ValueError(f"join kind {how!r} is not one of {_KINDS}")
    renamed = {key: f"_r{i}" for i, key in enumerate(on.values())}
    rest = [name for name in right.columns if name not in renamed]
    right = right.select(*rest, *[F.col(key).alias(r) for key, r in renamed.items()])
    match = F.lit(True) if residual is None else residual
    for lkey, rkey in on.items():
        one, other = F.col(lkey), F.col(renamed[rkey])
        match = match & (one.eqNullSafe(other) if null_safe else one == other)
    return left.join(right, match, how).drop(*renamed.values())


def with_matches(left: DataFrame, right: DataFrame, on: Mapping[str, str], matches: str) -> DataFrame:
    """Left rows with the number of right rows of their key, without forming the pairs."""
    keys = list(dict.fromkeys(on.values()))
    counted = right.groupBy(*keys).agg(F.count(F.lit(1)).alias(matches))
    joined = keyed_join(left, counted, on, "left")
    return joined.withColumn(matches, F.coalesce(F.col(matches), F.lit(0).cast("bigint")))


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times (a column, dropped).

    Rows of few copies stay where they are. Those of more are made in blocks, and the blocks are
    dealt out before their copies are made, so that no array grows large and the copies of one
    row come from many tasks. Both parts need the same columns, so that they read the same
    shuffles of ``df`` and what lies below those runs once.
    """
    first, bound = F.lit(1).cast("bigint"), F.lit(FEW_COPIES).cast("bigint")
    few = (df.where((F.col(times) > 0) & (F.col(times) <= bound))
           .withColumn("_copy", F.explode(F.sequence(first, F.col(times).cast("bigint"))))
           .drop(times, "_copy"))
    return few.unionByName(_repeat_many(df.where(F.col(times) > bound), times))


def _repeat_many(df: DataFrame, times: str) -> DataFrame:
    last_block = F.floor((F.col(times) - 1) / _REPEAT_BLOCK)
    in_block = F.least(F.lit(_REPEAT_BLOCK).cast("bigint"),
                       F.col(times) - F.col("_block") * _REPEAT_BLOCK)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.withColumn("_block", F.explode(F.sequence(zero, last_block)))
        .repartition(parts)
        .withColumn("_copy", F.explode(F.sequence(one, in_block)))
        .drop(times, "_block", "_copy")
    )


def fan_out(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join whose right side is not selected: it only repeats the left rows."""
    matched = with_matches(left, right, on, "_matches")
    return repeat_rows(
        matched.withColumn("_matches", F.greatest("_matches", F.lit(1).cast("bigint"))), "_matches")


def lookup_by_domain(df: DataFrame, codes: DataFrame, on: Mapping[str, str], domain: str,
                     rules: Iterable[tuple[Column, str]]) -> DataFrame:
    """Left rows with the code rows whose domain fits the row.

    ``on`` pairs the row's code with the code table's; ``rules`` pairs a condition on
    the row with the domain it selects. The join is a hash join on the code with the
    rules as a residual; a NULL condition matches nothing, so the row keeps an empty
    lookup.
    """
    fits = F.lit(False)
    for condition, name in rules:
        fits = fits | (condition & (F.col(domain) == F.lit(name)))
    kept = codes.withColumns({f"_{code}": F.col(code) for code in on.values()})
    joined = keyed_join(df, kept, on, "left", residual=fits)
    return joined.withColumnsRenamed({f"_{code}": code for code in on.values()})


def join_on_true(left: DataFrame, right: DataFrame, most_bytes: int = JOIN_ON_TRUE_BYTES) -> DataFrame:
    """Every left row with every row of a small right side.

    The right side is measured first and refused above ``most_bytes`` (of its rows as JSON). It then
    is one array, a scalar subquery that every task has, from which each left row draws its copies;
    no rows are shuffled. No right rows give no rows. Column names of both sides must differ.
    """
    both = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if both:
        raise ValueError(f"both sides have {sorted(both)}")
    row = F.struct(*right.columns)
    size = right.select(F.length(F.to_json(row, {"ignoreNullFields": "false"})).alias("n")).agg(F.sum("n")).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"the right side has {size} bytes, more than {most_bytes}")
    rows = right.agg(F.collect_list(row)).scalar()
    return left.withColumn("_right", F.explode(rows)).select(*left.columns, "_right.*")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference is set but names no parent."""
    keys = parent.select(F.col(pk).alias("_parent")).distinct()
    filled = child.where(F.col(fk).isNotNull())
    return keyed_join(filled, keys, {fk: "_parent"}, "left_anti")


def fan_out_counts(left: DataFrame, right: DataFrame, on: Mapping[str, str],
                   name: str = "rows") -> DataFrame:
    """Rows per key of a left join: left rows times right rows, without forming the pairs."""
    counted = left.groupBy(*on).agg(F.count(F.lit(1)).alias(name))
    matches = right.groupBy(*[F.col(key).alias(f"_r{i}") for i, key in enumerate(on.values())]).agg(
        F.count(F.lit(1)).alias("_matches"))
    same = F.lit(True)
    for i, key in enumerate(on):
        same = same & (F.col(key) == F.col(f"_r{i}"))
    times = F.coalesce(F.col("_matches"), F.lit(1).cast("bigint"))
    return counted.join(matches, same, "left").select(*on, (F.col(name) * times).alias(name))
