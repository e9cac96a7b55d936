import pytest
from pyspark.sql import functions as F

from retailspark.operators import joins
from tests.conftest import plan_of, values


@pytest.fixture
def fact(spark):
    """A third of the rows on key 0, some keys NULL, some unknown to the dimension."""
    key = (
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 97)
    )
    return spark.range(6000).select(F.col("id").alias("row"), key.cast("bigint").alias("k"))


@pytest.fixture
def dim(spark):
    return spark.range(80).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(fact, dim, how):
    got = joins.spread_join(fact, dim, "k", F.col("row"), how)
    assert values(got.select("row", "k", "name")) == values(
        fact.join(dim, "k", how).select("row", "k", "name")
    )


def test_spread_join_divides_the_hot_key(spark, fact, dim, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", 1)
    assert joins.hot_keys(fact, "k") == [0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.spread_join(fact, dim, "k", F.col("row"))
        sizes = joined.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == fact.filter("k = 0").count()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 1500


def test_lookup_broadcasts_only_up_to_the_bound(fact, dim):
    def plan(**options):
        df = joins.lookup(fact, dim, "k", F.col("row"), **options)
        return plan_of(df, "optimized"), df

    small, a = plan()
    large, b = plan(broadcast_rows=10)
    assert "strategy=broadcast" in small
    assert "strategy=broadcast" not in large and "_slot" in large
    assert values(a.select("row", "name")) == values(b.select("row", "name"))


def test_unique_lookup_refuses_repeated_keys(spark):
    good = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, v string")
    assert values(joins.unique_lookup(good, "k", "v")) == [(1, "a")]
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, v string")
    with pytest.raises(Exception, match="k repeats"):
        joins.unique_lookup(bad, "k", "v").collect()


def test_adaptive_execution_splits_a_skewed_sort_merge_join(spark, fact, dim):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = fact.repartition(8).join(dim, "k")
        joined.collect()
        assert "skew=true" in plan_of(joined, "simple")
    finally:
        for key in settings:
            spark.conf.unset(key)
