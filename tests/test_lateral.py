"""Lateral top rows and joins on true against Spark's own, on a key with two thirds of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from stratafold.operators.joins import join_on_true
from stratafold.operators.lateral import lateral_top, top_per_key


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(2)
    key = lambda: rng.choice([7, 7, 7, 7, rng.randrange(30), None])
    inner = [(key(), rng.choice([None, *range(20)]), i) for i in range(1500)]
    outer = [(key(), rng.choice([None, *range(-3, 20)]), i % 60) for i in range(120)]
    outer += [(7, 5, 1), (7, 5, 1), (99, 5, 2)]
    inner = spark.createDataFrame(inner, "ik bigint, v int, row bigint").repartition(4)
    outer = spark.createDataFrame(outer, "ok bigint, low int, id bigint").repartition(3)
    inner.createOrReplaceTempView("lateral_inner")
    outer.createOrReplaceTempView("lateral_outer")
    return outer, inner


def plain(spark, condition, n, how="CROSS JOIN LATERAL"):
    on = " ON TRUE" if how.startswith("LEFT") else ""
    return spark.sql(f"""SELECT o.*, i.v, i.row FROM lateral_outer o {how} (SELECT v, row FROM lateral_inner
        WHERE ik = o.ok AND {condition} ORDER BY v DESC, row LIMIT {n}) i{on}""")


def order():
    return [F.desc("v"), F.asc("row")]


@pytest.mark.parametrize("n", [1, 4, 2000])
def test_without_a_condition(spark, sides, rows, n):
    found = lateral_top(*sides, {"ok": "ik"}, order(), n)
    assert found.columns == ["ok", "low", "id", "v", "row", "place"]
    assert rows(found.drop("place")) == rows(plain(spark, "TRUE", n))
    assert found.agg(F.max("place"), F.min("place")).first()[1] == 1


@pytest.mark.parametrize("n, level", [(1, 64), (3, 2), (3, 5000), (40, 8)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_with_a_condition_on_the_outer_row(spark, sides, rows, n, level, how):
    """Levels are met one after the other until every asker has its rows."""
    found = lateral_top(*sides, {"ok": "ik"}, order(), n, F.col("v") < F.col("low"), ["low"], how, level_rows=level)
    kind = "CROSS JOIN LATERAL" if how == "inner" else "LEFT JOIN LATERAL"
    assert rows(found.drop("place")) == rows(plain(spark, "v < o.low", n, kind))
    places = found.where("place is not null").groupBy("ok", "low", "id", "place").count()
    assert places.where("place > 2000").count() == 0


def test_a_condition_that_only_the_last_rows_meet(spark, rows):
    inner = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    outer = spark.createDataFrame([(1, 2999), (1, 10)], "o int, last bigint")
    found = lateral_top(outer, inner, {"o": "k"}, [F.asc("v")], 2, F.col("v") >= F.col("last"), ["last"], level_rows=16)
    assert rows(found) == [(1, 10, 10, 1), (1, 10, 11, 2), (1, 2999, 2999, 1)]


def test_the_limit_holds_before_the_shuffle(sides):
    plan = top_per_key(sides[1], ["ik"], order(), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_no_rows_and_refusals(spark, sides, rows):
    outer, inner = sides
    none = inner.limit(0)
    low = {"residual": F.col("v") < F.col("low"), "params": ["low"]}
    for more in ({}, low):
        assert lateral_top(outer, none, {"ok": "ik"}, order(), 2, **more).count() == 0
        assert lateral_top(outer, none, {"ok": "ik"}, order(), 2, how="left", **more).count() == outer.count()
        assert lateral_top(outer.limit(0), inner, {"ok": "ik"}, order(), 2, **more).count() == 0
    for bad in ({"n": 0}, {"how": "full"}, {"place": "low"}):
        with pytest.raises(ValueError):
            lateral_top(outer, inner, {"ok": "ik"}, order(), **{"n": 1, **bad})


def test_join_on_true(spark, sides, rows):
    outer, inner = sides
    small = inner.where("ik = 3 or v is null").select("ik", "v")
    found = join_on_true(outer, small)
    assert rows(found) == rows(outer.crossJoin(small))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert join_on_true(outer, small.limit(0)).count() == 0
    with pytest.raises(ValueError, match="bytes"):
        join_on_true(outer, inner, most_bytes=1000)
    with pytest.raises(ValueError, match="both"):
        join_on_true(outer, outer)
