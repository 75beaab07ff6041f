"""A key holding a third of all rows: results stay exact with AQE's skew
handling forced on (tiny thresholds, so hot partitions really are split)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators.dedup import dedup_latest
from tierline.operators.merge import snapshot_diff, upsert
from tierline.operators.rank import dense_rank_within
from tierline.plans.products import enrich

FORCE_SKEW = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in FORCE_SKEW}
    for k, v in FORCE_SKEW.items():
        spark.conf.set(k, v)
    n = 6000
    # Key 0 holds a third of the rows; the rest are spread over 2,000 keys.
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("seq"), (F.col("id") % 97).cast("double").alias("amount"))
    yield df
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_enrich_hot_key(spark, skewed):
    dim = spark.range(0, 2001).select(F.col("id").alias("k"), (F.col("id") * 10).alias("attr"))
    got = enrich(skewed, dim, "k")
    rows = got.collect()
    assert len(rows) == skewed.count()
    assert all(r["attr"] == r["k"] * 10 for r in rows)
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in final          # the hot partition was split


def test_dedup_hot_key(spark, skewed):
    got = {r["k"]: r["seq"] for r in dedup_latest(skewed, ["k"], ["seq"]).collect()}
    expect = {r["k"]: r["m"] for r in skewed.groupBy("k").agg(F.max("seq").alias("m")).collect()}
    assert got == expect


def test_upsert_hot_key_in_target(spark, skewed):
    updates = spark.createDataFrame([(0, -1, 0.0), (5000, -2, 1.0)], "k long, seq long, amount double")
    got = upsert(skewed, updates, ["k"])
    assert got.filter("k = 0").count() == 1
    assert got.count() == skewed.filter("k != 0").count() + 2


def test_diff_and_rank_hot_value(spark, skewed):
    new = skewed.filter(~((F.col("k") == 0) & (F.col("seq") < 300)))
    diff = snapshot_diff(skewed, new, ["k", "seq"])
    assert diff.filter("_change_type = 'delete'").count() == 100
    assert diff.filter("_change_type != 'delete'").count() == 0
    expect = skewed.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy(F.desc("amount"))))
    got = dense_rank_within(skewed, ["k"], "amount", rank_col="r")
    assert _rows(got) == _rows(expect)
