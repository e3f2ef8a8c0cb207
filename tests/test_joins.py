"""Joins against plain joins, on keys of which one holds a third of the rows or more."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratafold.operators.joins import (
    fan_out, fan_out_counts, keyed_join, lookup_by_domain, orphans, repeat_rows, with_matches)


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third on key 7, some on NULL, the rest over 400 keys."""
    rng = random.Random(1)
    keys = [7] * 1000 + [None] * 200 + [rng.randrange(400) for _ in range(1800)]
    return spark.createDataFrame([(k, i % 3, i) for i, k in enumerate(keys)],
                                 "k bigint, s bigint, row bigint").repartition(4)


@pytest.fixture(scope="module")
def right(spark):
    """Keys 0..299, key 7 three times, key 8 twice, one NULL."""
    data = [(k, f"v{k}") for k in range(300)] + [(7, "v7b"), (7, "v7c"), (8, "v8b"), (None, "vn")]
    return spark.createDataFrame(data, "rk bigint, v string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_keyed_join_equals_a_plain_join(skewed, right, rows, how):
    plain = skewed.join(right, F.col("k") == F.col("rk"), how).drop("rk")
    found = keyed_join(skewed, right, {"k": "rk"}, how)
    assert found.columns == plain.columns
    assert rows(found) == rows(plain)


@pytest.mark.parametrize("how", ["right", "full", "outer", "cross"])
def test_other_join_kinds_are_refused(skewed, right, how):
    with pytest.raises(ValueError, match="not one of"):
        keyed_join(skewed, right, {"k": "rk"}, how)


def test_null_keys_match_on_request(skewed, right, rows):
    plain = skewed.join(right, F.col("k").eqNullSafe(F.col("rk")), "left").drop("rk")
    assert rows(keyed_join(skewed, right, {"k": "rk"}, "left", null_safe=True)) == rows(plain)


def test_keyed_join_on_two_keys_of_the_same_name(skewed, rows):
    right = skewed.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n"))
    plain = skewed.join(right, ["k", "s"], "left").select("k", "s", "row", "n")
    assert rows(keyed_join(skewed, right, {"k": "k", "s": "s"}, "left")) == rows(plain)


@pytest.mark.parametrize("codes", [10_000, 10_001, 50_000])
def test_keys_of_two_whole_types_match_at_every_size(spark, codes):
    left = spark.range(100).select(F.col("id").cast("int").alias("k"))
    right = spark.range(codes).select(F.col("id").alias("rk"), F.lit(1).alias("one"))
    assert keyed_join(left, right, {"k": "rk"}, "left").where("one = 1").count() == 100


def test_a_hot_key_of_equal_rows_is_split(spark):
    """200,000 equal rows on one key: adaptive execution cuts them into many parts."""
    left = spark.range(200_000, numPartitions=8).select(F.lit(7).alias("k"), F.lit("x" * 50).alias("pad"))
    left = left.unionByName(spark.range(2_000).select(F.col("id").cast("int").alias("k"), F.lit("y").alias("pad")))
    right = spark.range(2_000).select(F.col("id").cast("int").alias("rk"), F.lit("v" * 20).alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = keyed_join(left, right, {"k": "rk"}, "left")
        parts = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        assert joined.where("v is not null").count() == 202_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_with_matches(skewed, right, rows):
    plain = skewed.join(right.groupBy("rk").count(), F.col("k") == F.col("rk"), "left")
    plain = plain.select("k", "s", "row", F.coalesce("count", F.lit(0)))
    assert rows(with_matches(skewed, right, {"k": "rk"}, "n")) == rows(plain)


def test_fan_out_repeats_rows_like_a_left_join(skewed, right, rows):
    plain = skewed.join(right, F.col("k") == F.col("rk"), "left").select("k", "s", "row")
    assert rows(fan_out(skewed, right, {"k": "rk"})) == rows(plain)


def test_fan_out_counts_form_no_pairs(skewed, right, rows, capsys):
    plain = skewed.join(right, F.col("k") == F.col("rk"), "left").groupBy("k").count()
    found = fan_out_counts(skewed, right, {"k": "rk"})
    assert rows(found) == rows(plain)


def test_repeat_rows_in_blocks(frame):
    df = frame([("a", 25_001), ("b", 0), ("c", 1), ("d", 10_000)], "k string, n bigint")
    counts = {r.k: r["count"] for r in repeat_rows(df, "n").groupBy("k").count().collect()}
    assert counts == {"a": 25_001, "c": 1, "d": 10_000}


def test_lookup_by_domain(frame, rows, capsys):
    df = frame([(1, "C", "X"), (2, "C", "Y"), (3, "C", None), (4, "none", "X"), (5, None, "X")],
               "id int, reason string, law string")
    codes = frame([("C", "D1", "one"), ("C", "D2", "two"), ("C", "D2", "two again"), ("C", "D3", "x")],
                  "code string, domain string, text string")
    is_x = F.col("law") == "X"
    found = lookup_by_domain(df, codes, {"reason": "code"}, "domain", [(is_x, "D1"), (~is_x, "D2")])
    assert sorted(found.columns) == ["code", "domain", "id", "law", "reason", "text"]
    assert rows(found, "id", "text") == [
        (1, "one"), (2, "two"), (2, "two again"), (3, None), (4, None), (5, None)]
    found.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_orphans(skewed, frame, rows):
    parents = frame([(k,) for k in list(range(0, 400, 2)) + [0, 0, None]], "id bigint")
    plain = skewed.where("k % 2 = 1").select("k", "s", "row")
    assert rows(orphans(skewed, "k", parents, "id")) == rows(plain)


def test_rows_of_few_copies_are_not_shuffled(spark, rows):
    df = spark.range(400).select("id", F.when(F.col("id") == 5, 30_000).otherwise(F.col("id") % 3).alias("n"))
    found = repeat_rows(df, "n")
    plan = found._jdf.queryExecution().executedPlan().toString()
    few, many = plan.split("Union")[1].split("Exchange")[0], plan.split("Exchange")[1:]
    assert len(many) == 1 and "Generate explode(sequence(1" in few
    counted = {r.id: r["count"] for r in found.groupBy("id").count().collect()}
    assert counted == {**{i: i % 3 for i in range(400) if i % 3}, 5: 30_000}
    spread = found.where("id = 5").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread >= 2


def test_few_and_many_copies_read_the_same_shuffle(spark, rows):
    """What lies below the last shuffle runs once, also when later steps drop columns."""
    left = spark.range(300).select((F.col("id") % 9).alias("k"), F.col("id").alias("row"), F.lit("x").alias("unused"))
    right = spark.range(400).select(F.when(F.col("id") < 350, 5).otherwise(F.col("id") % 9).alias("rk"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = with_matches(left, right, {"k": "rk"}, "n").withColumn("n", F.col("n") + F.col("row") % 2)
        found = repeat_rows(met, "n").select("k")
        counted = dict(Counter(r.k for r in found.collect()))
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("ReusedExchange") == 2
    assert counted == {r.k: r.n for r in met.groupBy("k").agg(F.sum("n").alias("n")).collect()}
