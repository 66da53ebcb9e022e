"""Hot and NULL keys, snapshots of dimensions, windows by warehouse."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators import dwd, joins


@pytest.fixture
def fact(spark):
    """A third of the rows on one key, a sixth without a key."""
    row = F.col("id")
    key = F.when(row % 3 == 0, F.lit(7)).when(row % 6 == 1, F.lit(None)).otherwise(row % 997)
    return spark.range(60000, numPartitions=4).select("id", key.cast("bigint").alias("k"))


@pytest.fixture
def dim(spark):
    return spark.range(900).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_keys_holds_every_frequent_key_and_is_bounded(fact):
    found = joins.hot_keys(fact, "k", 8)
    assert found.pieces == {7: 4} and found.nulls  # a third of the rows: three eighths of the tasks or more
    even = joins.hot_keys(fact.withColumn("k", F.col("id")), "k", 8)
    assert not even and even.pieces == {} and not even.nulls
    assert not joins.hot_keys(fact.limit(0), "k")
    # shares below those the sketch takes are counted
    counted = joins.hot_keys(fact, "k", 60000)
    rows = dict(fact.groupBy("k").count().collect())
    share = joins.hot_share(60000) * fact.count()
    assert set(counted.pieces) == {k for k, n in rows.items() if n >= share and k is not None}


@pytest.mark.parametrize("partitions", [8, 200, 4000, 100000])
def test_pieces_follow_the_share_and_are_bounded(partitions):
    counts = {None: 5, "third": 300000, "tenth": 100000, "hundredth": 10000, **{i: 90 for i in range(1000)}}
    hot = joins.HotKeys.among(counts, 1000000, partitions)
    # with so many partitions, 90 rows are nine average ones
    small = set(range(1000)) if partitions == 100000 else set()
    assert set(hot.pieces) == {"third", "tenth", "hundredth"} | small and not hot.nulls
    for key, pieces in hot.pieces.items():
        assert pieces >= 2 and counts[key] / pieces <= 1000000 / partitions
    assert sum(hot.pieces.values()) <= 2 * (partitions + 2 * len(hot.pieces))
    assert 1 / joins.hot_share(partitions) <= max(200, partitions / 5)
    assert joins.hot_share(4000) == 5 / 4000  # five average partitions


def test_split_join_equals_plain_join(fact, dim):
    split = joins.split_left_join(fact, dim, "k", ["id"], joins.hot_keys(fact, "k"), 8)
    assert same_rows(split, fact.join(dim, "k", "left"))


def test_split_join_spreads_hot_and_missing_keys(spark, fact, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = joins.split_left_join(fact, dim, "k", ["id"], joins.hot_keys(fact, "k"), 8)
        plain = fact.join(dim, "k", "left")
        largest = [
            max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())
            for df in (split, plain)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert largest[0] < 60000 / 8 * 2 < 20000 <= largest[1]


def test_split_join_without_hot_keys(fact, dim):
    assert same_rows(joins.split_left_join(fact, dim, "k", ["id"], joins.HotKeys({}), 4), fact.join(dim, "k", "left"))


def test_even_keys_are_joined_plainly(spark, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        even = spark.range(2000).select(F.col("id").alias("k"))
        joined = joins.left_join(even, dim, "k", ["k"])
        assert "__slot" not in joined._jdf.queryExecution().toString()
        assert same_rows(joined, even.join(dim, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_decides_about_broadcast(spark, dim):
    assert joins.fits_broadcast(dim)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert not joins.fits_broadcast(dim)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_filter_keeps_facts_without_a_match(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    dim = spark.createDataFrame([(1, "old", "d1"), (1, "new", "d2"), (2, "gone", "d1")], "k int, n string, dt string")
    wide = joins.widen(fact, [joins.DimSpec(dim, ("k", "k"), {"n": "name"}, dt="d2")], ["k"])
    assert {tuple(r) for r in wide.collect()} == {(1, "new"), (2, None), (3, None)}


def test_repeated_dimension_keys_are_refused(spark):
    joins.require_unique(spark.range(5), "id")
    with pytest.raises(ValueError):
        joins.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")
    twice = spark.createDataFrame([(1, "d1"), (1, "d2")], "k int, dt string")
    joins.widen(spark.range(2).toDF("k"), [joins.DimSpec(twice, ("k", "k"), {}, dt="d1", check=True)], ["k"])
    with pytest.raises(ValueError):
        joins.widen(spark.range(2).toDF("k"), [joins.DimSpec(twice, ("k", "k"), {}, check=True)], ["k"])


def test_warehouse_efficiency_equals_a_window(spark):
    lines = spark.range(3000).select(
        F.col("id").alias("OrderID"),
        F.lit(1).alias("ProductID"),
        F.lit(1).alias("Quantity"),
        F.lit(1).alias("UnitPrice"),
        F.when(F.col("id") % 3 == 0, "Unknown Warehouse")
        .otherwise(F.concat(F.lit("w"), (F.col("id") % 11).cast("string")))
        .alias("WarehouseName"),
        F.when(F.col("id") % 4 == 0, "Delivered").otherwise("Shipped").alias("OrderDetailStatus"),
    )
    window = Window.partitionBy("WarehouseName")
    delivered = F.sum(F.when(F.col("OrderDetailStatus") == "Delivered", 1).otherwise(0)).over(window)
    expected = lines.withColumn("WarehouseEfficiency", delivered / F.count("*").over(window) * 100)
    got = dwd.warehouse_efficiency(lines)
    assert same_rows(got.select(*expected.columns), expected)


def test_lines_of_a_busy_warehouse_name_go_to_many_tasks(spark):
    lines = spark.range(4000).select(
        F.col("id").alias("OrderID"),
        *(F.lit(1).alias(c) for c in ("ProductID", "Quantity", "UnitPrice")),
        F.when(F.col("id") % 2 == 0, "Unknown Warehouse").otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("WarehouseName"),
        F.when(F.col("id") % 4 == 0, "Delivered").otherwise("Shipped").alias("OrderDetailStatus"),
    )
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = dwd.warehouse_efficiency(lines)
        busy = got.filter("WarehouseName = 'Unknown Warehouse'").groupBy(F.spark_partition_id().alias("task"), "WarehouseEfficiency").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(busy) > 1 and sum(r["count"] for r in busy) == 2000 and {r["WarehouseEfficiency"] for r in busy} == {50.0}
