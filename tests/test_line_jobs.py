"""Line jobs at size: what is moved, what stays on disk, and that the rows are those of the plain way."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from registry import jobs
from registry.adapters import business_table
from tallyhouse.operators import dwd, sieve, snapshots, summaries
from tallyhouse.operators.snapshots import latest_per_key
from tallyhouse.plans import states as state_plan
from tallyhouse.plans import warehouse
from tallyhouse.sinks import held
from tallyhouse.sinks import tables as sink

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("orderdetails", "orders", "customers", "products", "warehouses", "factories")


@pytest.fixture
def layout(spark):
    tag = uuid.uuid4().hex[:8]
    layout = warehouse.Layout(f"ods_{tag}", f"dwd_{tag}", f"dws_{tag}", snapshots=False, keys=jobs.KEYS)
    yield layout
    for database in (layout.ods, layout.dwd, layout.dws):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


def same(some, other):
    return some.columns == other.columns and some.exceptAll(other).isEmpty() and other.exceptAll(some).isEmpty()


# ------------------------------------------------------------ F1 - F7
def test_writes_leave_no_shuffles(spark, layout, monkeypatch):
    seen, before = [], spark.conf.get(sink.RELEASED)
    for path in ("saveAsTable", "insertInto"):
        plain = getattr(DataFrameWriter, path)
        monkeypatch.setattr(DataFrameWriter, path, lambda self, name, plain=plain, **more: seen.append(spark.conf.get(sink.RELEASED)) or plain(self, name, **more))
    sink.ensure_database(spark, layout.dws)
    rows = spark.range(9).repartition(3, "id").withColumn("dt", F.lit("d1"))
    for _ in range(2):
        sink.replace_partitions(rows, f"{layout.dws}.a").require_complete()
        sink.write_table(rows, f"{layout.dws}.b").require_complete()
    assert seen == ["true"] * 4 and spark.conf.get(sink.RELEASED) == before


def test_a_sieve_misses_no_key(spark):
    rows = spark.range(20_000).selectExpr("if(id % 1000 = 0, null, id) AS a", "concat('x', id % 7000) AS b", "id")
    keys = rows.filter("id % 5 = 0").select("a", "b")
    bits = sieve.bits_for(keys.count())
    sure, maybe = sieve.sifted(rows, sieve.sieve_of(keys, bits), ["a", "b"], bits)
    assert same(sure.unionByName(maybe), rows) and sure.filter("id % 5 = 0").isEmpty()
    assert maybe.filter("id % 5 > 0").count() < 0.2 * 16_000


@pytest.mark.parametrize("bits", [1 << 28, 0])
def test_rows_that_no_later_load_brings_again_stay(spark, layout, monkeypatch, bits):
    name, of = f"{layout.dwd}.dwd_orderdetails", warehouse.held_of(layout, "orderdetails")
    sink.ensure_database(spark, layout.dwd)
    day = lambda i: date(2001, 7, 1 + i % 5)
    first = [(f"l{i}", i // 3, day(i // 3), i, "2001-07-20") for i in range(500)] + [(None, None, None, -1, "2001-07-20")]
    second = [(f"l{i}", i // 3, day(i // 3), 1000 + i, "2001-07-25") for i in range(450, 550)]
    third = [(f"l{i}", i // 3, day(i // 3), 2000 + i, "2001-07-30") for i in range(400, 520, 2)] + [(None, None, None, -3, "2001-07-30")]
    kinds = "OrderDetailID string, OrderID long, OrderDate date, Quantity int, dt string"
    for rows in (first, second, third):
        held.replace_and_describe(spark.createDataFrame(rows, kinds), name, of)
    monkeypatch.setattr(warehouse, "FEW_ROWS", 0)
    monkeypatch.setattr(snapshots, "MOST_BITS", bits)
    want = latest_per_key(spark.table(name), ["OrderDetailID"], "dt")
    recent = layout.recent(spark, name, "2001-07-30")
    assert same(recent, want) and want.count() == 551
    assert same(layout.of_changed_days(spark, name, "2001-07-30"), want)
    assert layout.recent(spark, name, "2001-07-25").agg(F.sum("Quantity")).first()[0] == sum(range(450)) + sum(1000 + i for i in range(450, 550)) - 1
    plan = recent._jdf.queryExecution().optimizedPlan().toString()
    assert ("Window" in plan) == (bits == 0) and "LeftAnti" not in plan
    if bits:  # the rows of a load are sifted before they meet the keys
        assert plan.index("Join LeftOuter") < plan.index("Join Inner", plan.index("Join LeftOuter"))


def test_lines_are_numbered_where_they_meet_their_orders(spark, no_broadcast):
    plan = jobs.line_loads(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("hashpartitioning(OrderID") == 2 == plan.count("hashpartitioning(")


def test_lines_meet_narrow_dimensions_first(spark, no_broadcast):
    parts = [business_table(spark, SF_DIR, f"ods_{n}") for n in NAMES]
    moved = dwd.dwd_orderdetails(*parts, batch_date="2001-08-01")
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    dims = [dwd.DimSpec(df, (key, key), of) for df, key, of in ((parts[1], "OrderID", dwd.ORDER), (parts[3], "ProductID", dwd.PRODUCT))]
    assert [d.on[0] for d in dwd.narrow_first(dims)] == ["ProductID", "OrderID"] and plan.count("Join LeftOuter") >= 4
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [d.on[0] for d in dwd.narrow_first(dims)] == ["OrderID", "ProductID"]
    other = dwd.dwd_orderdetails(*parts, batch_date="2001-08-01")
    assert sorted(moved.columns) == sorted(other.columns) and same(moved, other.select(moved.columns))


def test_distinct_counts_of_warehouses_move_no_names(spark):
    names = [(1, "a", None, "f", "x"), (1, None, "a", "f", "x"), (1, "a", "a", "f", None), (None, None, None, None, None), (2, "ab", "c", "f", "x"), (2, "a", "bc", "f", "x")]
    rows = [(i % 7, i % 3, *names[i % 6], 1, 1, 1, "Delivered", 1) for i in range(60)]
    lines = spark.createDataFrame(rows, "OrderID long, ProductID long, WarehouseID long, WarehouseName string, WarehouseManager string, FactoryName string, FactoryLocation string, q int, n int, u int, OrderDetailStatus string, e int")
    lines = lines.selectExpr("*", "cast(q as decimal(10,2)) Quantity", "cast(n as decimal(20,2)) NetAmount", "cast(u as decimal(10,2)) UnitPrice", "cast(e as decimal(10,4)) WarehouseEfficiency")
    got = summaries.warehouse_analytics(lines)
    found = {tuple(r[c] for c in summaries.WAREHOUSE_KEYS): (r["unique_orders"], r["unique_products"]) for r in got.collect()}
    want = {n: (len({r[0] for r in rows if r[2:7] == n}), len({r[1] for r in rows if r[2:7] == n})) for n in names}
    assert found == want
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert not any("WarehouseName" in line for line in plan.splitlines() if "Expand" in line)


def test_orders_of_a_large_load_of_lines_are_not_looked_up(spark, layout):
    orders, lines = (business_table(spark, SF_DIR, f"ods_{n}") for n in ("orders", "orderdetails"))
    jobs.store(orders.filter("OrderID % 2 = 0"), layout, "Orders", "2001-07-30")
    jobs.store(orders, layout, "Orders", "2001-07-31")
    few = lines.filter("OrderID = 4")
    assert "LeftSemi" not in warehouse.known_orders(spark, layout, "2001-07-31", lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in warehouse.known_orders(spark, layout, "2001-07-31", few)._jdf.queryExecution().optimizedPlan().toString()
    assert same(warehouse.known_orders(spark, layout, "2001-07-31", lines).drop("dt"), orders)


def test_keys_that_are_there_twice_are_found_by_hash(spark):
    rows = spark.createDataFrame([(1, None, "d1"), (None, 1, "d1"), (1, 1, "d2"), (1, 1, "d3"), (None, 2, "d4"), (None, 2, "d4")], "a int, b int, dt string")
    assert held.repeated(rows, ["a", "b"]) == ["d4"] and held.repeated(rows.filter("dt < 'd4'"), ["a", "b"]) == []


@pytest.mark.parametrize("many", [0, 1000])
def test_summaries_of_many_lines_are_written_one_by_one(spark, layout, monkeypatch, many):
    name = f"{layout.dwd}.dwd_orderdetails"
    sink.ensure_database(spark, layout.dwd)
    rows = spark.range(5).selectExpr("id OrderDetailID", "id OrderID", "date '2001-07-01' OrderDate", "'2001-07-30' dt")
    held.replace_and_describe(rows, name, warehouse.held_of(layout, "orderdetails"))
    asked = []
    monkeypatch.setattr(warehouse, "_write", lambda *of, many=False: asked.append(many))
    monkeypatch.setattr(warehouse, "MANY_ROWS", many)
    warehouse.build_dws_orderdetails(spark, "2001-07-30", layout)
    assert asked == [many < 5]
    monkeypatch.undo()
    running, most, plain = [], [], sink.replace_partitions
    monkeypatch.setattr(sink, "replace_partitions", lambda *of, **named: (running.append(1), most.append(len(running)), plain(*of, **named), running.pop())[2])
    made = {f"dws_{x}": lambda: spark.range(3) for x in "abc"}
    assert warehouse._write(spark, layout, "2001-07-30", made, many=True) == [*made] and max(most) == 1


# ------------------------------------------------------------ F1, F2
def test_states_of_many_rows_are_written_at_once(spark, layout, monkeypatch):
    orders = business_table(spark, SF_DIR, "ods_orders")
    for name in ("Customers", "Employees"):
        jobs.store(business_table(spark, SF_DIR, f"ods_{name.lower()}"), layout, name, "2001-07-30")
    plain, beside = sink.write_table, []
    monkeypatch.setattr(sink, "write_table", lambda df, name, **named: beside.append(name) or plain(df, name, **named))
    monkeypatch.setattr(state_plan, "FEW_ROWS", 0)
    undated = F.when(F.col("OrderID") % 10 > 0, F.col("OrderDate"))
    orders = orders.withColumn("OrderDate", undated)
    for day, rows in (("2001-07-30", orders), ("2001-07-31", orders.filter("OrderID % 50 = 0 OR OrderDate > '2001-06-01'").withColumn("TotalAmount", F.col("TotalAmount") + 1))):
        jobs.store(rows, layout, "Orders", day)
        warehouse.build_dwd_orders(spark, day, layout)
        state_plan.build_states(spark, day, layout, "monthly", "customers")
    fact = layout.recent(spark, f"{layout.dwd}.dwd_orders", "2001-08-01")
    got, want = state_plan.monthly_summary(spark, "2001-08-01", layout), summaries.orders_monthly_summary(fact)
    assert not beside and same(got.select(want.columns), want) and not want.filter("year_month IS NULL").isEmpty()
    got, want = state_plan.customer_analytics(spark, "2001-08-01", layout), summaries.customer_analytics(fact, "2001-08-01")
    assert same(got.select(want.columns), want)
