import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratafold.operators.windows import numbered, with_group_total


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds in one group, NULL groups, and many rows on one date."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot")
        .when(F.col("id") % 11 > 0, (F.col("id") % 11).cast("string"))
        .alias("g"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 97).alias("o"), F.col("id"))


@pytest.mark.parametrize("ranges", [1, 5, 16])
def test_numbered_equals_row_number(skewed, rows, ranges):
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")))
    assert rows(numbered(skewed, ["g"], ["o", "id"], "n", ranges)) == rows(plain)


def test_a_hot_group_spans_many_ranges(spark, skewed):
    ranged = skewed.repartitionByRange(8, "g", "o", "id").withColumn("p", F.spark_partition_id())
    spread = ranged.where("g = 'hot'").select("p").distinct().count()
    assert spread >= 5


def test_group_total_equals_a_window_sum(skewed, rows):
    plain = skewed.withColumn("t", F.sum("o").over(Window.partitionBy("g")))
    assert rows(with_group_total(skewed, ["g"], F.sum("o"), "t")) == rows(plain)


def test_null_and_float_groups_have_totals(frame, rows):
    df = frame([(None, 1), (None, 2), ("a", 5)], "g string, v int")
    assert rows(with_group_total(df, ["g"], F.sum("v"), "t")) == [(None, 1, 3), (None, 2, 3), ("a", 5, 5)]
    floats = frame([(0.5, 1), (0.5, 2)], "g double, v int")
    assert rows(with_group_total(floats, ["g"], F.sum("v"), "t")) == [(0.5, 1, 3), (0.5, 2, 3)]


def test_ties_span_ranges(spark, rows):
    ties = spark.range(20_000).select(F.lit("g").alias("g"), F.lit(1).alias("o"), "id")
    tied = ties.withColumn("_tie", F.xxhash64(*ties.columns)).repartitionByRange(8, "g", "o", "_tie")
    assert tied.select(F.spark_partition_id().alias("p")).distinct().count() == 8
    found = numbered(ties, ["g"], ["o"], "n", 8)
    assert found.select("n").distinct().count() == 20_000 and found.agg(F.max("n")).first()[0] == 20_000


def test_rows_are_shuffled_once(spark, skewed, rows):
    """One exchange of the rows; what is joined back is one row a range."""
    from stratafold.operators.windows import _number_ranges
    ranged = skewed.repartitionByRange(8, "g", "o").sortWithinPartitions("g", "o")
    plan = _number_ranges(ranged, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    found = numbered(skewed, ["g"], ["o", "id"], "n", 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort" not in plan.split("BroadcastExchange")[0]


def test_numbered_over_float_date_and_no_groups(spark, rows):
    data = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, F.lit(0.5)).alias("f"),
        F.expr("date_add(date'2024-01-01', cast(id % 2 as int))").alias("d"), "id")
    for keys in (["f", "d"], []):
        window = Window.partitionBy(*keys).orderBy(F.desc("id"))
        plain = data.withColumn("n", F.row_number().over(window))
        key = lambda df: sorted(str(tuple(r)) for r in df.collect())
        assert key(numbered(data, keys, [F.desc("id")], "n", 7)) == key(plain)
    assert numbered(data.limit(0), ["f"], ["id"], "n").count() == 0
