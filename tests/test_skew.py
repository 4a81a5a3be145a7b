import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswork.operators import skew


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one key, some on a null key, the others spread."""
    rng = random.Random(7)
    data = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(60)}"
        data.append((i, key, rng.randrange(20), rng.choice(["a", "b", "c"])))
    return spark.createDataFrame(data, "id long, k string, v int, s string").repartition(4).cache()


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    pick = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert pick(left) == pick(right)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [10, 100, 10_000])
def test_salted_join_equals_plain_join(spark, rows, how, hot_rows):
    keys = ["hot", "k1", "k2", "k3", "other", None]
    right = spark.createDataFrame([(k, f"r{k}") for k in keys], "k string, r string")
    if how in ("left_semi", "left_anti"):
        right = right.select("k")
    salted = skew.salted_join(rows, right, ["k"], how, ["id"], hot_rows=hot_rows)
    same(salted, rows.join(right, ["k"], how))


def test_salted_join_spreads_the_hot_key(spark, rows):
    right = spark.createDataFrame([("hot", 1)], "k string, r int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(rows, right, ["k"], "inner", ["id"], hot_rows=20)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 500
    assert max(r["count"] for r in sizes) < 300


def test_top_k_equals_window(rows):
    order = [F.desc("v"), F.asc("id")]
    plain = rows.withColumn(
        "rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))
    ).where("rn <= 7").drop("rn")
    same(skew.top_k(rows, ["k"], order, 7, ["id"], salts=5), plain)


def test_global_rank_equals_window(rows):
    plain = rows.withColumn("rank", F.row_number().over(Window.orderBy("v", "id")).cast("long"))
    same(skew.global_rank(rows, ["v", "id"], partitions=6), plain)


def test_rank_and_lag_across_slices(rows):
    known = rows.where("k is not null")
    window = Window.partitionBy("k").orderBy("v", "id")
    ranked = skew.rank_in_group(known, ["k"], ["v", "id"], partitions=7)
    same(ranked, known.withColumn("rank", F.row_number().over(window).cast("long")))
    lagged = skew.lag_in_group(known, ["k"], ["v", "id"], "s", "previous", partitions=7)
    same(lagged, known.withColumn("previous", F.lag("s").over(window)))


def test_broadcast_check(spark):
    small, large = spark.range(5), spark.range(50)
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(skew.broadcast_if_small(small, 10))
    assert not hinted(skew.broadcast_if_small(large, 10))
    assert not hinted(skew.broadcast_if_small(small, 10, max_bytes=3))
    assert not hinted(skew.broadcast_if_small(small, 10, probe=large))
