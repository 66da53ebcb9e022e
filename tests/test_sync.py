"""Copying tables: every mode twice, isolation of failures, the daily jobs end to end."""

import uuid
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry.adapters import business_table
from tallyhouse.operators import views as order_views
from tallyhouse.plans import views as view_plan
from tallyhouse.plans import warehouse
from tallyhouse.plans.sync import TableSpec, default_specs, jdbc_reader, sync_all, sync_table
from tallyhouse.sinks import tables as sink
from tallyhouse.sources.tables import SOURCE_TABLES

ROWS = "id int, v string, changed timestamp"


@pytest.fixture
def db(spark):
    name = f"s{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


class Source:
    """A source table whose rows change between runs."""

    def __init__(self, *rows):
        self.rows = list(rows)

    def __call__(self, spark, spec):
        return spark.createDataFrame([(i, v, datetime(2020, 1, day)) for i, v, day in self.rows], ROWS)


def held(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "v", "dt").collect())


def test_incremental_copy_and_repeat(spark, db):
    spec = TableSpec("orders", f"{db}.orders", inc_col="changed")
    source = Source((1, "a", 1), (2, "b", 1))
    assert sync_table(spark, spec, "2020-01-01", source).rows == 2
    source.rows += [(3, "c", 2)]
    for _ in range(2):  # the second run of a date must not lose what the first one loaded
        assert sync_table(spark, spec, "2020-01-02", source).partitions == {"2020-01-02": 1}
    assert held(spark, spec.target) == [(1, "a", "2020-01-01"), (2, "b", "2020-01-01"), (3, "c", "2020-01-02")]
    assert sync_table(spark, spec, "2020-01-03", source).rows == 0
    assert sink.list_partitions(spark, spec.target) == ["2020-01-01", "2020-01-02"]


def test_lookback_reads_late_changes_again(spark, db):
    spec = TableSpec("orders", f"{db}.orders", inc_col="changed", lookback_days=1)
    source = Source((1, "a", 1), (2, "b", 2))
    sync_table(spark, spec, "2020-01-02", source)
    source.rows = [(1, "a", 1), (2, "late", 2), (3, "c", 3)]
    sync_table(spark, spec, "2020-01-03", source)
    assert [r[:2] for r in held(spark, spec.target) if r[2] == "2020-01-03"] == [(2, "late"), (3, "c")]


def test_full_copy_keeps_history_and_drops_old(spark, db):
    spec = TableSpec("customers", f"{db}.customers", mode="full", keep_days=1)
    source = Source((1, "a", 1))
    for day in ("2020-01-01", "2020-01-02", "2020-01-03", "2020-01-03"):
        sync_table(spark, spec, day, source)
    assert held(spark, spec.target) == [(1, "a", "2020-01-02"), (1, "a", "2020-01-03")]


def test_full_copy_of_the_latest_only(spark, db):
    spec = TableSpec("factories", f"{db}.factories", mode="full", strategy="latest_only")
    sync_table(spark, spec, "2020-01-01", Source((1, "a", 1), (2, "b", 1)))
    sync_table(spark, spec, "2020-01-02", Source((1, "z", 2)))
    assert held(spark, spec.target) == [(1, "z", "2020-01-02")]
    assert sink.list_partitions(spark, spec.target) is None


def test_without_a_partition_column(spark, db):
    grow = TableSpec("log", f"{db}.log", inc_col="changed", part_col=None)
    sync_table(spark, grow, "2020-01-01", Source((1, "a", 1)))
    sync_table(spark, grow, "2020-01-02", Source((1, "a", 1), (2, "b", 2)))
    assert spark.table(grow.target).count() == 2
    whole = TableSpec("codes", f"{db}.codes", mode="full", part_col=None)
    for _ in range(2):
        sync_table(spark, whole, "2020-01-01", Source((1, "a", 1)))
    assert spark.table(whole.target).count() == 1


def test_upsert_keeps_one_row_per_key(spark, db):
    spec = TableSpec.of({"source": "o", "target": f"{db}.o", "inc_col": "changed", "strategy": "upsert", "keys": "id", "lookback_days": 1})
    source = Source((1, "a", 2), (2, "b", 3))
    sync_table(spark, spec, "2020-01-03", source)
    # an overlap with a changed and a new row, and an older change of a row the target holds
    source.rows = [(1, "new", 4), (2, "old", 2), (2, "older", 1), (3, "c", 4)]
    for _ in range(2):
        sync_table(spark, spec, "2020-01-04", source)
        assert sorted(r[:2] for r in held(spark, spec.target)) == [(1, "new"), (2, "b"), (3, "c")]
    source.rows = [(1, "again", 4)]
    sync_table(spark, TableSpec("o", spec.target, "changed", mode="full", strategy="upsert", keys=("id",)), "2020-01-05", source)
    assert sorted(r[:2] for r in held(spark, spec.target)) == [(1, "again"), (2, "b"), (3, "c")]


def test_a_copy_follows_its_source_into_new_columns(spark, db):
    spec = TableSpec("orders", f"{db}.orders", inc_col="changed", schema_change="widen", max_records=1, block_bytes=1 << 20)
    when = "timestamp'2020-01-0{}' AS changed"
    states = [f"SELECT 1 AS id, {when.format(1)}", f"SELECT 5000000000 AS id, 'new' AS v, {when.format(2)}", f"SELECT 3 AS id, {when.format(3)}"]
    for day, rows in enumerate(states, 1):
        for _ in range(2):  # the second run finds the table as the first one left it
            assert sync_table(spark, spec, f"2020-01-0{day}", lambda *_, rows=rows: spark.sql(rows)).rows == 1
    assert held(spark, spec.target) == [(1, None, "2020-01-01"), (3, None, "2020-01-03"), (5000000000, "new", "2020-01-02")]
    strict = TableSpec("orders", spec.target, inc_col="changed")
    with pytest.raises(ValueError):
        sync_table(spark, strict, "2020-01-04", lambda *_: spark.sql(f"SELECT 4 AS id, 'x' AS v, 1 AS more, {when.format(4)}"))
    assert sync_table(spark, spec, "2020-01-05", lambda *_: spark.sql(f"SELECT 4 AS id, 1 AS more, {when.format(1)}")).rows == 0


def test_a_table_keeps_the_sizes_of_its_files(spark, db):
    spec = TableSpec("orders", f"{db}.orders", mode="full", max_records=10, block_bytes=1 << 20)
    many = lambda *_: spark.range(25).coalesce(1)
    for day in ("2020-01-01", "2020-01-02", "2020-01-02"):
        sync_table(spark, spec, day, many)
    files = spark.table(spec.target).groupBy("dt", F.input_file_name().alias("file")).count().collect()
    assert sorted((r["dt"], r["count"]) for r in files) == [(d, n) for d in ("2020-01-01", "2020-01-02") for n in (5, 10, 10)]


def test_row_groups_have_the_block_size(spark, tmp_path):
    rows = spark.range(200_000).select(F.rand(1).alias("a"), F.rand(2).alias("b")).coalesce(1)
    groups = []
    for name, size in (("small", 1 << 18), ("large", 1 << 27)):
        sink.write_files(rows, str(tmp_path / name), block_bytes=size)
        (file,) = (tmp_path / name).glob("*.parquet")
        groups.append(pq.ParquetFile(file).num_row_groups)
    assert groups[0] > 4 and groups[1] == 1


def test_unknown_modes_are_refused():
    with pytest.raises(ValueError):
        TableSpec("a", "b.a", strategy="upsert")
    with pytest.raises(TypeError):
        TableSpec.of({"source": "a", "target": "b.a", "retention": 3})
    with pytest.raises(ValueError):
        TableSpec("a", "b.a", mode="sometimes")
    with pytest.raises(ValueError):
        TableSpec("a", "b.a", strategy="maybe")
    with pytest.raises(ValueError):
        TableSpec("a", "b.a", schema_change="recreate")  # loses what is stored
    with pytest.raises(ValueError):
        TableSpec("a", "b.a", strategy="upsert", keys=("id",), schema_change="widen")


def test_jdbc_reader_picks_the_known_columns(spark):
    from tests.test_sources import OPTS, Session

    columns = list(SOURCE_TABLES["factories"]["columns"])
    rows = [(i, *("x" * len(columns))) for i in (1, 2)]
    source = Session(spark.createDataFrame(rows, [*columns, "Other"]))
    spec = next(s for s in default_specs() if s.source == "Factories")
    assert jdbc_reader(OPTS)(source, spec).columns == [*columns, "Other"]
    assert jdbc_reader(OPTS, known_columns=True)(source, spec).columns == columns
    jdbc_reader(OPTS, parallel=2)(source, spec)
    assert source.log[-1]["partitionColumn"] == "FactoryID"
    assert jdbc_reader(OPTS)(source, TableSpec("other", "a.other")).count() == 2
    assert (spec.mode, spec.strategy, len(default_specs())) == ("full", "latest_only", 9)


def test_one_failing_table_does_not_stop_the_others(spark, db, tmp_path):
    def read(spark, spec):
        if spec.source == "bad":
            raise ConnectionError("no route\nto the host")
        if spec.source == "mute":
            raise ConnectionError()
        return Source((1, "a", 1))(spark, spec)

    specs = [TableSpec(n, f"{db}.{n}", mode="full", enabled=n != "off") for n in ("good", "bad", "off", "mute", "Fine", "gone")]
    path, existing = str(tmp_path / "summary"), {"good", "bad", "mute", "fine"}
    summary = sync_all(spark, specs, "2020-01-01", read, path, existing=existing)
    got = {r["table_name"]: (r["record_count"], r["status"]) for r in spark.read.parquet(str(tmp_path / "summary")).collect()}
    assert got == {
        f"{db}.good": (1, "SUCCESS"),
        f"{db}.bad": (0, "FAILED: ConnectionError('no route\\nto the host')"),
        f"{db}.mute": (0, "FAILED: ConnectionError()"),
        f"{db}.Fine": (1, "SUCCESS"),
        f"{db}.gone": (0, "SKIPPED: no source table gone"),
    }
    assert summary.columns == ["table_name", "record_count", "status", "processed_date"]


SF_DIR = "/root/testdata/sf0.001"
DAYS = ("2001-07-31", "2001-08-01")


@pytest.fixture(scope="module")
def layout(spark):
    """Raw tables as full snapshots of two days, under names of their own."""
    tag = uuid.uuid4().hex[:8]
    layout = warehouse.Layout(f"ods_{tag}", f"dwd_{tag}", f"dws_{tag}", snapshots=True)
    sink.ensure_database(spark, layout.ods)
    names = {
        "Orders": "ods_orders",
        "OrderDetails": "ods_orderdetails",
        "Customers": "ods_customers",
        "Employees": "ods_employees",
        "Products": "ods_products",
    }
    for day in DAYS:
        for name, adapter in names.items():
            rows = business_table(spark, SF_DIR, adapter).withColumn("dt", F.lit(day))
            sink.replace_partitions(rows, f"{layout.ods}.{name}")
    for name in ("Warehouses", "Factories"):
        rows = business_table(spark, SF_DIR, f"ods_{name.lower()}")
        sink.write_table(rows.withColumn("dt", F.lit(DAYS[0])), f"{layout.ods}.{name}")
    yield layout
    for database in (layout.ods, layout.dwd, layout.dws):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_daily_jobs(spark, layout):
    for day in (*DAYS, DAYS[-1]):
        assert warehouse.build_dwd_orders(spark, day, layout).partitions == {day: 1500}
        assert warehouse.build_dwd_orderdetails(spark, day, layout).partitions == {day: 6000}
        made = warehouse.build_dws_orders(spark, day, layout) + warehouse.build_dws_orderdetails(spark, day, layout)
    assert warehouse.build_dwd_orders(spark, "1990-01-01", layout) is None
    assert len(made) == 6
    for name in made:
        assert sink.list_partitions(spark, f"{layout.dws}.{name}") == list(DAYS)
    assert sink.list_partitions(spark, f"{layout.dwd}.dwd_orders") == list(DAYS)
    # every order once, though it is stored in both snapshots
    customers = spark.table(f"{layout.dws}.dws_customer_analytics").filter(F.col("dt") == DAYS[-1])
    assert customers.agg(F.sum("total_orders")).first()[0] == 1500

    available = {*made, "dwd_orders", "dwd_orderdetails"}
    names = view_plan.register_views(spark, available, DAYS[-1], layout)
    assert len(names) == 23 and "orders_summary" not in names
    view_plan.require_views(spark, names)
    for name in names:
        assert spark.table(name).columns
    # both snapshots are stored, a view sees one
    states = spark.table("dwd_orders_status_summary")
    assert states.agg(F.sum("order_count")).first()[0] == 1500
    one = spark.table(f"{layout.dwd}.dwd_orders").filter(F.col("dt") == DAYS[0])
    assert spark.table("dwd_orders_high_value").count() == order_views.orders_high_value(one).count()
    trend = spark.table("dws_orders_weekly_trend")
    assert trend.count() == trend.select("order_date").distinct().count() > 0
    with pytest.raises(LookupError, match="no_such"):
        view_plan.require_views(spark, ["no_such"])
    few = view_plan.register_views(spark, ["dws_orders_daily_summary"], DAYS[-1], layout)
    assert few == ["dws_orders_weekly_trend", "dws_daily_kpi"]


def test_daily_jobs_over_increments(spark):
    """A load holds its own day: earlier days stay, and the window adds them up once each."""
    tag = uuid.uuid4().hex[:8]
    layout = warehouse.Layout(f"ods_{tag}", f"dwd_{tag}", f"dws_{tag}", snapshots=False)
    sink.ensure_database(spark, layout.ods)
    orders = business_table(spark, SF_DIR, "ods_orders").withColumn("dt", F.col("OrderDate").cast("string"))
    sink.replace_partitions(orders.filter("dt >= '2001-06-01'"), f"{layout.ods}.Orders", rebalance=True)
    for name in ("Customers", "Employees"):
        rows = business_table(spark, SF_DIR, f"ods_{name.lower()}").withColumn("dt", F.lit("2001-07-01"))
        sink.replace_partitions(rows, f"{layout.ods}.{name}")
    try:
        days = sink.list_partitions(spark, f"{layout.ods}.Orders")[-4:]
        for day in days:
            warehouse.build_dwd_orders(spark, day, layout)
            made = warehouse.build_dws_orders(spark, day, layout)
        assert "dws_orders_daily_summary" in made
        stored = spark.table(f"{layout.dwd}.dwd_orders")
        assert sorted(r["dt"] for r in stored.select("dt").distinct().collect()) == days
        customers = spark.table(f"{layout.dws}.dws_customer_analytics").filter(F.col("dt") == days[-1])
        assert customers.agg(F.sum("total_orders")).first()[0] == stored.count()
        daily = spark.table(f"{layout.dws}.dws_orders_daily_summary")
        assert daily.count() == len(days) and daily.filter("order_date != dt").isEmpty()
        # the customers of another day stand in for a date without a snapshot of its own
        assert not stored.filter("CustomerName != 'Unknown Customer'").isEmpty()
    finally:
        for database in (layout.ods, layout.dwd, layout.dws):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_changed_and_late_orders_count_once(spark):
    """Three loads of increments: an order of the first one is changed, and one of its dates comes late."""
    tag = uuid.uuid4().hex[:8]
    layout = warehouse.Layout(f"ods_{tag}", f"dwd_{tag}", f"dws_{tag}", snapshots=False)
    sink.ensure_database(spark, layout.ods)
    all_orders = business_table(spark, SF_DIR, "ods_orders").filter("OrderDate >= '2001-06-01'").drop("UpdatedDate")
    all_orders = all_orders.withColumn("Status", F.lit("Processing")).cache()
    late, changed = (r["OrderID"] for r in all_orders.orderBy("OrderDate", "OrderID").limit(2).collect())
    day_of_late = all_orders.filter(F.col("OrderID") == late).first()["OrderDate"].isoformat()
    on_that_day = all_orders.filter(F.col("OrderDate").cast("string") == day_of_late).count()
    loads = {
        "2001-08-01": all_orders.filter(F.col("OrderID") != late),
        "2001-08-02": all_orders.filter(F.col("OrderID") == late),
        "2001-08-03": all_orders.filter(F.col("OrderID") == changed).withColumn("Status", F.lit("Canceled")),
    }
    for name in ("Customers", "Employees"):
        rows = business_table(spark, SF_DIR, f"ods_{name.lower()}").withColumn("dt", F.lit("2001-07-01"))
        sink.replace_partitions(rows, f"{layout.ods}.{name}")
    try:
        for day, rows in loads.items():
            sink.replace_partitions(rows.withColumn("dt", F.lit(day)), f"{layout.ods}.Orders")
            warehouse.build_dwd_orders(spark, day, layout)
            warehouse.build_dws_orders(spark, day, layout)
        expected = all_orders.count()
        for day in loads:
            view_plan.register_views(spark, ["dwd_orders", "dws_orders_daily_summary"], day, layout)
            known = expected - (day == "2001-08-01")
            states = {r["OrderStatus"]: r["order_count"] for r in spark.table("dwd_orders_status_summary").collect()}
            assert sum(states.values()) == known and states.get("Cancelled", 0) == (day == "2001-08-03")
            kpi = spark.table("dws_daily_kpi")
            assert kpi.agg(F.sum("total_orders")).first()[0] == known
            of_day = kpi.filter(F.col("order_date") == day_of_late).agg(F.sum("total_orders")).first()[0]
            assert (of_day or 0) == on_that_day - (day == "2001-08-01")
        customers = spark.table(f"{layout.dws}.dws_customer_analytics").filter("dt = '2001-08-03'")
        assert customers.agg(F.sum("total_orders")).first()[0] == expected
        # the last load turns out to be empty: its partitions go, and what was known before counts
        spark.sql(f"ALTER TABLE {layout.ods}.Orders DROP PARTITION (dt='2001-08-03')")
        assert warehouse.build_dwd_orders(spark, "2001-08-03", layout) is None
        warehouse.build_dws_orders(spark, "2001-08-03", layout)
        daily = f"{layout.dws}.dws_orders_daily_summary"
        assert sink.list_partitions(spark, daily) == ["2001-08-01", "2001-08-02"]
        view_plan.register_views(spark, ["dwd_orders"], "2001-08-03", layout)
        assert spark.table("dwd_orders_status_summary").filter("OrderStatus = 'Cancelled'").isEmpty()
    finally:
        all_orders.unpersist()
        for database in (layout.ods, layout.dwd, layout.dws):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_the_kind_of_loads_must_be_said():
    with pytest.raises(TypeError):
        warehouse.Layout()
