import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one
from lotewise.operators.quality import empty_fields, incoherent_values, outliers
from lotewise.operators.quantiles import exact_quantiles
from lotewise.operators.ranking import latest_per_key, number_within, running_total


def test_numbering_of_a_hot_key(spark, rows):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(9)}", rng.randrange(6), i) for i in range(600)]
    data += [(None, 1, 9001), (None, 2, 9002)]
    df = spark.createDataFrame(data, "k string, page int, pos int")
    got = number_within(df, ["k"], [F.col("page"), F.col("pos")], F.col("page"), "n")
    expected, seen = [], {}
    for k, page, pos in sorted(data, key=lambda r: (r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        expected.append((k, page, pos, seen[k]))
    assert rows(got) == sorted(expected, key=repr)


def test_running_total_with_offsets(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("a", 2, 1), ("b", 1, 1)], "k string, c int, f int").withColumn("o", F.monotonically_increasing_id())
    offsets = spark.createDataFrame([("a", 10)], "k string, offset int")
    got = running_total(df, ["k"], [F.col("c"), F.col("f").desc()], F.col("c"), F.col("f"), "t", offsets)
    assert rows(got, "k", "c", "f", "t") == [("a", 1, 0, 11), ("a", 1, 1, 11), ("a", 2, 1, 12), ("b", 1, 1, 1)]


def test_latest_is_combined_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.lit("hot"))
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert latest_per_key(df, ["k"], ["id"]).head()["id"] == 999


@pytest.mark.parametrize("probs", [{"q1": 0.25, "q3": 0.75}, {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}])
def test_quantiles_are_exact(spark, probs):
    rng = random.Random(11)
    groups = {
        "hot": [round(rng.lognormvariate(3, 2), 2) for _ in range(4000)],
        "same": [5.0] * 300,
        "two": [1.0, 2.0],
        "one": [7.0],
        "far": [1e-9 * i for i in range(50)] + [1e12 + i for i in range(50)],
        None: [float(rng.randrange(-50, 50)) for _ in range(500)],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("hot", None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g].n == len(values)
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12), (g, name)


def test_quantiles_need_a_group(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(3), [], "id", {"m": 0.5})


def test_outliers_outside_the_fences(spark, rows):
    df = spark.createDataFrame([("a", float(v)) for v in (10, 11, 12, 13, 14, 100)] + [("b", 1.0)], "g string, v double")
    assert rows(outliers(df, "v", ["g"]), "g", "v") == [("a", 100.0)]


def test_empty_and_zero_fields(spark, rows):
    df = spark.createDataFrame([("", 0.0, []), ("x", None, ["a"]), (" ", 2.0, None)], "t string, n double, l array<string>")
    assert rows(empty_fields(df)) == [("l", 3, 2, 0), ("n", 3, 1, 1), ("t", 3, 2, 0)]
    assert rows(empty_fields(df.limit(0))) == [("l", 0, 0, 0), ("n", 0, 0, 0), ("t", 0, 0, 0)]


def test_contradictions(spark, rows):
    df = spark.createDataFrame([(1, 5, 3), (2, 1, None), (3, 1, 2)], "k int, forced int, value int")
    rules = {"forced over value": F.col("forced") > F.col("value"), "odd": F.col("k") % 2 == 1}
    assert rows(incoherent_values(df, ["k"], rules)) == [(1, "forced over value"), (1, "odd"), (3, "odd")]


def test_hot_key_is_split_against_an_aggregate(spark):
    """The partition of a key with most rows is read by several tasks."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v")
        )
        one = many.groupBy("k").agg(F.max("v").alias("top"))
        joined = many_to_one(many, one, ["k"], "left")
        assert joined.filter("top >= v").agg(F.count("v")).head()[0] == 200000
        joined.write.format("noop").mode("overwrite").save()
        query = joined.agg(F.sum(F.length("v")), F.max("top"))
        query.collect()
        assert "SortMergeJoin(skew=true)" in query._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how, expected", [("inner", [(1, "x"), (None, "z")]), ("left", [(1, "x"), (2, "y"), (None, "z")]), ("left_semi", [(1, "x"), (None, "z")]), ("left_anti", [(2, "y")])])
def test_many_to_one(spark, rows, how, expected):
    many = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    one = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    assert rows(many_to_one(many, one, ["k"], how)) == sorted(expected, key=repr)


def test_rows_that_are_only_a_key(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(latest_per_key(df, ["k"], [])) == [(1,), (2,)]
