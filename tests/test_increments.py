"""Increments: verified writes, buckets, described partitions, closed intervals, resumed runs, states, ranges of dates, reports."""

import re
import threading
import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from registry import jobs
from registry.adapters import business_table
from registry.queries import AS_OF, QUERIES
from tallyhouse.operators import dwd, states, summaries
from tallyhouse.operators.snapshots import latest_per_key
from tallyhouse.plans import ledger, warehouse
from tallyhouse.plans import reports as report_plan
from tallyhouse.plans import states as state_plan
from tallyhouse.plans.sync import JdbcReader, TableSpec, sync_all, sync_table
from tallyhouse.sinks import buckets, held
from tallyhouse.sinks import tables as sink
from tallyhouse.sources import jdbc

SF_DIR = "/root/testdata/sf0.001"
ROWS = "id int, v string, changed timestamp"


@pytest.fixture
def db(spark):
    name = f"i{uuid.uuid4().hex[:8]}"
    sink.ensure_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture
def layout(spark):
    tag = uuid.uuid4().hex[:8]
    layout = warehouse.Layout(f"ods_{tag}", f"dwd_{tag}", f"dws_{tag}", snapshots=False, keys=jobs.KEYS)
    yield layout
    for database in (layout.ods, layout.dwd, layout.dws, f"pub_{layout.dws}"):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def load(spark, dt, *ids):
    return spark.createDataFrame([(i, f"v{i}", dt) for i in ids], "id int, v string, dt string")


def source(spark, *rows):
    return spark.createDataFrame([(i, v, datetime(2020, 1, day)) for i, v, day in rows], ROWS)


def files(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


# ------------------------------------------------------------ K20
@pytest.mark.parametrize("harm", [lambda df: df.filter("id != 2"), lambda df: df.withColumn("v", F.when(F.col("id") == 2, "x").otherwise(F.col("v"))), lambda df: df.filter("id > 99"), lambda df: df.withColumn("id", F.lit(1))])
def test_a_write_that_stores_other_rows_fails(spark, db, monkeypatch, harm):
    plain = sink.writer
    monkeypatch.setattr(sink, "writer", lambda df, *more, **named: plain(harm(df), *more, **named))
    for write in (sink.write_table, sink.replace_partitions):
        done = write(load(spark, "d1", 1, 2, 3), f"{db}.{write.__name__}")
        assert done.rows == 3 and not done.complete
        with pytest.raises(RuntimeError, match="3 rows written"):
            done.require_complete()
    # a table that is there keeps its rows
    monkeypatch.setattr(sink, "writer", plain)
    sink.write_table(load(spark, "d1", 7), f"{db}.kept").require_complete()
    monkeypatch.setattr(sink, "writer", lambda df, *more, **named: plain(harm(df), *more, **named))
    assert not sink.write_table(load(spark, "d1", 1, 2, 3), f"{db}.kept").complete
    assert [r["id"] for r in spark.table(f"{db}.kept").collect()] == [7]


def test_digests_see_content_not_order(spark, db):
    schema = "a int, b int, c map<string,int>, d double, e array<string>, dt string"
    rows = [(1, None, {"x": 1}, 0.5, ["p"], "d"), (None, 1, None, float("nan"), None, "d"), (1, None, {"x": 1}, 0.5, ["p"], "d")]
    df = spark.createDataFrame(rows, schema)
    of = lambda x: x.agg(sink.digest(sink.types_of(df))).first()[0]
    assert of(df) == of(spark.createDataFrame(rows[::-1], schema).repartition(3))
    assert len({of(df), of(df.dropDuplicates(["a", "b"])), of(df.withColumns({"a": F.col("b"), "b": F.col("a")})), of(df.limit(0))}) == 4
    assert sink.replace_partitions(df, f"{db}.t").complete and sink.write_table(df, f"{db}.u").complete
    got = sink.verify_write(spark, f"{db}.t", df.withColumn("d", F.col("d") * 2)).first()
    assert (got["expected"], got["stored"], got["passed"]) == (3, 3, False)
    assert sink.verify_write(spark, f"{db}.t", df).first()["passed"]
    assert not sink.WriteResult("t", 5, {}).complete and sink.WriteResult("t", 0, {}).complete
    # rows are compared in the types of the table
    assert sink.replace_partitions(df.withColumn("a", F.col("a").cast("tinyint")), f"{db}.t").complete


# ------------------------------------------------------------ I7
def test_an_upsert_rewrites_the_buckets_it_touches(spark, db):
    name = f"{db}.t"
    rows = spark.range(2000).select("id", F.lit("old").alias("v"), F.lit(1).alias("at"))
    assert buckets.upsert_table(rows, name, ["id"], "at", buckets=32).rows == 2000
    before = files(spark, name)
    changes = spark.createDataFrame([(5, "new", 2), (5, "newer", 3), (7, "stale", 0), (9000, "more", 1)], "id long, v string, at int")
    done = buckets.upsert_table(changes, name, ["id"], "at", buckets=8).require_complete()
    touched = {r[0] for r in changes.select(buckets.bucket_of(["id"], 32)).collect()}
    assert set(done.partitions) == touched and 1 < len(touched) <= 3
    gone = before - files(spark, name)
    assert {int(f.split(f"{buckets.BUCKET}=")[1].split("/")[0]) for f in gone} == touched
    got = {r["id"]: (r["v"], r["at"]) for r in buckets.upserted(spark, name).collect()}
    assert len(got) == 2001 and got[5] == ("newer", 3) and got[7] == ("old", 1) and got[9000] == ("more", 1)
    assert buckets.upsert_table(changes.limit(0), name, ["id"], "at").rows == 0 and buckets.buckets_of(spark, name) == 32
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["t"]
    # a failing change leaves the table; a table without buckets is stored anew once
    kept = files(spark, name)
    with pytest.raises(Exception, match="broken"):
        buckets.upsert_table(changes.withColumn("v", F.raise_error(F.lit("broken")).cast("string")), name, ["id"], "at")
    assert files(spark, name) == kept
    sink.write_table(rows, f"{db}.plain")
    buckets.upsert_table(changes, f"{db}.plain", ["id"], "at", buckets=4)
    assert {r["id"]: (r["v"], r["at"]) for r in buckets.upserted(spark, f"{db}.plain").collect()} == got


# ------------------------------------------------------------ P2, P3
def scanned(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "PartitionFilters" in x]


def test_only_loads_that_hold_a_changed_day_are_read(spark, layout):
    orders = business_table(spark, SF_DIR, "ods_orders")
    days = [("2001-08-01", "1995"), ("2001-08-02", "1996"), ("2001-08-03", "1997"), ("2001-08-04", "1998")]
    for name in ("Customers", "Employees"):
        jobs.store(business_table(spark, SF_DIR, f"ods_{name.lower()}"), layout, name, "2001-08-01")
    late = orders.filter("year(OrderDate) = 1995").orderBy("OrderID").limit(1)
    for day, year in days:
        rows = orders.filter(f"year(OrderDate) = {year}")
        jobs.store(rows.unionByName(late.withColumn("Status", F.lit("Canceled"))) if year == "1998" else rows, layout, "Orders", day)
        warehouse.build_dwd_orders(spark, day, layout)
    table = f"{layout.dwd}.dwd_orders"
    near = layout.of_changed_days(spark, table, "2001-08-04")
    assert all("2001-08-01" in x and "2001-08-04" in x and "2001-08-02" not in x and "2001-08-03" not in x for x in scanned(near) if "dwd_orders`" in x or "IN" in x)
    assert any("IN (2001-08-01,2001-08-04)" in x for x in scanned(near))
    want = orders.filter("year(OrderDate) = 1998").count() + orders.join(late.select("OrderDate"), "OrderDate", "left_semi").filter("year(OrderDate) = 1995").count()
    assert near.count() == want and near.filter("OrderStatus = 'Cancelled'").count() >= 1
    # a load without a description is read as well
    sink.drop_partitions(spark, held.table_of(table), ["2001-08-02"])
    assert any("IN (2001-08-01,2001-08-02,2001-08-04)" in x for x in scanned(layout.of_changed_days(spark, table, "2001-08-04")))
    described = {r["dt"]: r["n"] for r in spark.table(held.table_of(f"{layout.ods}.Orders")).groupBy("dt").agg(F.sum("rows").alias("n")).collect()}
    assert described == {r["dt"]: r["count"] for r in spark.table(f"{layout.ods}.Orders").groupBy("dt").count().collect()}


def test_keys_name_their_loads(spark, db):
    name = f"{db}.t"
    for k, day in enumerate(("d1", "d2", "d3", "d4")):
        rows = spark.range(1000 * k, 1000 * k + 1000).select("id", F.lit(None).cast("date").alias("day"), F.lit(day).alias("dt"))
        held.replace_and_describe(rows, name, held.Held("day", "id"))
    keys = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    assert held.dates_of_keys(spark, name, keys(5, 2999, None), "d4") == ["d1", "d3"]
    assert held.dates_of_keys(spark, name, keys(5, 3999), "d3") == ["d1"]
    assert held.dates_of_keys(spark, name, keys(2500), "d4", cells=2) == ["d3"]
    assert held.dates_of_keys(spark, name, keys(0, 3999), "d4", cells=1) == ["d1", "d2", "d3", "d4"]
    assert held.dates_of_keys(spark, name, keys(None), "d4") == [] and held.dates_of_keys(spark, name, keys(-5, 9999), "d4") == []
    assert held.dates_of_keys(spark, name, spark.createDataFrame([("x",)], "id string"), "d4") == ["d1", "d2", "d3", "d4"]


# ------------------------------------------------------------ I1, I2, I4, S9
def test_a_source_that_grows_gives_the_same_interval(spark, db):
    spec = TableSpec("o", f"{db}.o", inc_col="changed")
    now = [(1, "a", 1), (2, "b", 2)]
    read = lambda session, _: source(session, *now)
    stored = lambda: sorted((r["id"], r["v"], r["dt"]) for r in spark.table(spec.target).collect())
    sync_table(spark, spec, "2020-01-02", read)
    first = stored()
    now += [(3, "c", 3), (4, "d", 4)]
    sync_table(spark, spec, "2020-01-02", read)
    assert stored() == first
    sync_table(spark, spec, "2020-01-04", read)
    now += [(5, "e", 5)]
    sync_table(spark, spec, "2020-01-04", read)
    sync_table(spark, spec, "2020-01-05", read)
    assert stored() == [(1, "a", "2020-01-02"), (2, "b", "2020-01-02"), (3, "c", "2020-01-04"), (4, "d", "2020-01-04"), (5, "e", "2020-01-05")]
    marks = [(e.dt, e.low, e.high, e.rows, e.state) for e in ledger.entries(spark, spec.target)]
    assert marks == [
        ("2020-01-02", None, "2020-01-02 00:00:00", 2, "complete"),
        ("2020-01-04", "2020-01-02 00:00:00", "2020-01-04 00:00:00", 2, "complete"),
        ("2020-01-05", "2020-01-04 00:00:00", "2020-01-05 00:00:00", 1, "complete"),
    ]


def test_the_source_is_read_once(spark, db):
    seen = spark.sparkContext.accumulator(0)

    def each(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    spec = TableSpec("o", f"{db}.o", mode="full")
    sync_table(spark, spec, "2020-01-02", lambda session, _: source(session, (1, "a", 1), (2, "b", 2)).mapInArrow(each, ROWS))
    assert seen.value == 2


def test_a_stopped_run_goes_on(spark, db):
    def reader(broken, log):
        def read(session, spec):
            log.append(spec.source)
            if spec.source in broken:
                raise ConnectionError("stopped")
            return source(session, *[(i, spec.source, 1) for i in range(int(spec.source))])

        return read

    specs = [TableSpec(str(n), f"{db}.t{n}", mode="full") for n in (1, 2, 3, 4, 5)]
    log = []
    sync_all(spark, specs, "2020-01-01", reader(("3", "4", "5"), log), resume=True)
    log.clear()
    got = sync_all(spark, specs, "2020-01-01", reader((), log), resume=True)
    assert sorted(log) == ["3", "4", "5"]
    whole = [replace(s, target=s.target.replace(".t", ".w")) for s in specs]
    want = sync_all(spark, whole, "2020-01-01", reader((), log))
    short = lambda df: [(r["table_name"][-1], r["record_count"], r["status"], r["processed_date"]) for r in df.collect()]
    assert short(got) == short(want) and [r[1] for r in short(got)] == [1, 2, 3, 4, 5]


# ------------------------------------------------------------ S4
class Database:
    """Answers JDBC reads from temporary views; no database is started."""

    def __init__(self, spark):
        self.spark, self.parts, self.asked = spark, [], 0

    @property
    def read(self):
        return Reads(self)

    def range(self, *args):
        return self.spark.range(*args)


class Reads:
    def __init__(self, database):
        self.database, self.table = database, None

    def format(self, _):
        return self

    def option(self, key, value):
        self.table = value if key == "dbtable" else self.table
        return self

    def options(self, **_):
        return self

    def load(self):
        self.database.asked += 1
        return self.database.spark.sql(f"SELECT * FROM {self.table}")

    def jdbc(self, url, table, predicates, properties):
        assert properties["fetchsize"] == "10000"
        parts = [self.database.spark.sql(f"SELECT * FROM {table} WHERE {p}") for p in predicates]
        self.database.parts = [p.count() for p in parts]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out


def test_ranges_are_even_over_the_delta(spark):
    low = spark.range(0, 60000, 1, 4).withColumn("id", F.when(F.col("id") < 50000, F.col("id")).otherwise(F.col("id") * 1_000_000))
    rows = low.unionAll(spark.range(3).select(F.lit(None).cast("long"))).withColumn("changed", F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.lit(1)))
    rows.createOrReplaceTempView("skewed_source")
    opts = jdbc.JdbcOptions("jdbc:x:y")
    for where, wanted in ((None, rows), ("changed > 2", rows.filter("changed > 2")), ("changed > 9", rows.limit(0))):
        database = Database(spark)
        got = jdbc.read_even(database, opts, "skewed_source", "id", 8, where)
        assert got.count() == wanted.count() and got.exceptAll(wanted).isEmpty()
        assert max(database.parts) <= 2 * max(1, sum(database.parts) / len(database.parts)) and database.asked < 12
        assert len(database.parts) == (8 if wanted.count() else 1)
    spark.catalog.dropTempView("skewed_source")
    assert [jdbc.literal(x) for x in (3, "o'x", datetime(2020, 1, 2), datetime(2020, 1, 2).date())] == ["3", "'o''x'", "TIMESTAMP '2020-01-02 00:00:00'", "DATE '2020-01-02'"]


def test_an_interval_is_read_in_even_parts(spark):
    rows = spark.createDataFrame([(i, datetime(2020, 1, 1 + i % 5) if i % 7 else None) for i in range(200)], "FactoryID int, UpdatedDate timestamp")
    rows.createOrReplaceTempView("Factories")
    database, spec = Database(spark), TableSpec("Factories", "x.f", "UpdatedDate")
    reader = JdbcReader(jdbc.JdbcOptions("jdbc:x:y"), parallel=4)
    of = ledger.Entry("x.f", "d", "2020-01-01 00:00:00", "2020-01-03 00:00:00")
    for entry, days in ((of, 0), (replace(of, low=None), 0), (of, 1), (replace(of, low=None, high=None), 0)):
        got = reader.within(database, spec, rows, entry, ) if not days else reader.within(database, replace(spec, lookback_days=1), rows, entry)
        assert got.exceptAll(ledger.within(rows, "UpdatedDate", entry, days)).isEmpty() and got.count() == ledger.within(rows, "UpdatedDate", entry, days).count()
        assert len(database.parts) == 4 and max(database.parts) < 2 * sum(database.parts) / 4
    spark.catalog.dropTempView("Factories")


# ------------------------------------------------------------ J2, K3
def test_facts_in_equal_buckets_are_joined_where_they_lie(spark, db):
    for name, rows in (("Orders", "ods_orders"), ("OrderDetails", "ods_orderdetails")):
        for _ in range(2):
            dated = business_table(spark, SF_DIR, rows).withColumn("dt", F.lit("d1"))
            sink.replace_partitions(dated, f"{db}.{name}", bucket_by=("OrderID", 6)).require_complete()
        assert sink.bucket_spec(spark, f"{db}.{name}") == ("OrderID", 6)
    lines, orders = (spark.table(f"{db}.{n}").filter("dt = 'd1'") for n in ("OrderDetails", "Orders"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = dwd.dwd_orderdetails(lines, orders, None, None, None, None, batch_date="2001-08-01")
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not re.search(r"\bExchange\b", plan)
        assert len(files(spark, f"{db}.OrderDetails")) == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    raw = dwd.dwd_orderdetails(business_table(spark, SF_DIR, "ods_orderdetails"), business_table(spark, SF_DIR, "ods_orders"), None, None, None, None, batch_date="2001-08-01")
    columns = [c for c in raw.columns if c != "etl_created_date"]
    assert fact.select(columns).exceptAll(raw.select(columns)).isEmpty() and fact.count() == raw.count()
    assert sink.compact_partitions(spark, f"{db}.Orders") == {}


# ------------------------------------------------------------ K9
def test_compaction(spark, db, monkeypatch):
    name = f"{db}.t"
    many = spark.range(400, numPartitions=8).select("id", F.lit("d1").alias("dt"))
    sink.replace_partitions(many, name)
    sink.replace_partitions(spark.range(5).coalesce(1).select("id", F.lit("d2").alias("dt")), name)
    kinds = sink.types_of(spark.table(name))
    before, other = spark.table(name).agg(sink.digest(kinds)).first()[0], files(spark, name)
    plain = sink.writer
    monkeypatch.setattr(sink, "writer", lambda df, *more, **named: plain(df.withColumn("id", F.raise_error(F.lit("broken")).cast("long")), *more, **named))
    with pytest.raises(Exception, match="broken"):
        sink.compact_partitions(spark, name)
    monkeypatch.setattr(sink, "writer", plain)
    assert files(spark, name) == other
    assert sink.compact_partitions(spark, name) == {"d1": (8, 1)}
    assert spark.table(name).agg(sink.digest(kinds)).first()[0] == before and len(files(spark, name)) == 2
    assert len(files(spark, name) & other) == 1 and sink.compact_partitions(spark, name) == {}


# ------------------------------------------------------------ K22
@pytest.mark.parametrize(
    "old, new, wide",
    [
        ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"), ("int", "double", "double"),
        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("int", "decimal(12,2)", "decimal(12,2)"), ("int", "decimal(9,2)", None),
        ("decimal(12,2)", "decimal(12,4)", None), ("bigint", "double", None), ("string", "int", None), ("double", "float", "double"),
        ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("struct<a:int>", "struct<a:string>", None),
    ],
)
def test_wider_types(old, new, wide):
    kind = lambda text: T._parse_datatype_string(text)
    got = sink.widened(kind(old), kind(new))
    assert (got and got.simpleString()) == wide


def test_a_table_grows_into_a_wider_type(spark, db):
    name = f"{db}.t"
    sink.replace_partitions(spark.sql("SELECT 1 AS id, cast(1.5 as float) AS x, named_struct('a', 1) AS s, 'd1' AS dt"), name)
    rows = spark.sql("SELECT 5000000000 AS id, 2.25D AS x, named_struct('a', 6000000000, 'b', 'q') AS s, 7 AS more, 'd2' AS dt")
    with pytest.raises(ValueError, match="changed"):
        sink.evolve_schema(spark, rows, name)
    sink.replace_partitions(sink.evolve_schema(spark, rows, name, "widen"), name).require_complete()
    narrow = spark.sql("SELECT 3 AS id, cast(0.5 as float) AS x, named_struct('a', 2) AS s, 8 AS more, 'd3' AS dt")
    sink.replace_partitions(sink.evolve_schema(spark, narrow, name, "widen"), name).require_complete()
    got = sorted((r["id"], r["x"], r["s"]["a"], r["s"]["b"], r["more"], r["dt"]) for r in spark.table(name).collect())
    assert got == [(1, 1.5, 1, None, None, "d1"), (3, 0.5, 2, None, 8, "d3"), (5000000000, 2.25, 6000000000, "q", 7, "d2")]
    with pytest.raises(ValueError, match="no wider type"):
        sink.evolve_schema(spark, narrow.withColumn("id", F.lit("x")), name, "widen")


# ------------------------------------------------------------ states
def test_merged_states_equal_the_summaries(spark):
    lines = dwd.dwd_orderdetails(*(business_table(spark, SF_DIR, f"ods_{n}") for n in ("orderdetails", "orders", "customers", "products", "warehouses", "factories")), batch_date=AS_OF)
    kind = states.kinds()["warehouses"]
    got = summaries.warehouse_profile(states.merged(states.states(lines, kind), kind))
    want = summaries.warehouse_analytics(lines)
    key = lambda r: tuple(str(r[c]) for c in summaries.WAREHOUSE_KEYS)
    theirs = {key(r): r.asDict() for r in want.collect()}
    mine = {key(r): r.asDict() for r in got.collect()}
    assert mine.keys() == theirs.keys()
    for k, row in mine.items():
        for c, value in row.items():
            if c in ("unique_orders", "unique_products"):
                assert value == pytest.approx(theirs[k][c], rel=0.03)
            else:
                assert value == theirs[k][c]


def test_states_of_a_changed_day_are_replaced(spark, layout):
    orders = business_table(spark, SF_DIR, "ods_orders").filter("year(OrderDate) = 2000")
    for name in ("Customers", "Employees"):
        jobs.store(business_table(spark, SF_DIR, f"ods_{name.lower()}"), layout, name, "2001-08-01")
    one = orders.orderBy("OrderDate", "OrderID").limit(1)
    for day, rows in (("2001-08-01", orders), ("2001-08-02", one.withColumn("TotalAmount", F.col("TotalAmount") + 1000))):
        jobs.store(rows, layout, "Orders", day)
        warehouse.build_dwd_orders(spark, day, layout)
        state_plan.build_states(spark, day, layout, "customers", "monthly")
    fact = layout.recent(spark, f"{layout.dwd}.dwd_orders", "2001-08-02")
    for got, want in (
        (state_plan.customer_analytics(spark, "2001-08-02", layout), summaries.customer_analytics(fact, "2001-08-02")),
        (state_plan.monthly_summary(spark, "2001-08-02", layout), summaries.orders_monthly_summary(fact)),
        (state_plan.customer_analytics(spark, "2000-06-30", layout, days=30), summaries.customer_analytics(fact.filter("OrderDate BETWEEN '2000-05-31' AND '2000-06-30'"), "2000-06-30")),
    ):
        assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == want.count() > 0


# ------------------------------------------------------------ I6, I8, R2 - R7, K16
def test_a_range_of_loads_equals_the_loads_one_by_one(spark, layout):
    days = ("2001-08-01", "2001-08-02", "2001-08-04")
    for name, key in (("Customers", "CustomerName"), ("Employees", "EmployeeName")):
        rows = business_table(spark, SF_DIR, f"ods_{name.lower()}")
        for day in days[:2]:
            jobs.store(rows.withColumn(key, F.concat(key, F.lit(f" as of {day}"))), layout, name, day)
    orders = business_table(spark, SF_DIR, "ods_orders")
    for k, day in enumerate(days):
        jobs.store(orders.filter(F.col("OrderID") % 3 == k), layout, "Orders", day)
    table = f"{layout.dwd}.dwd_orders"
    for day in days:
        warehouse.build_dwd_orders(spark, day, layout)
    columns = [c for c in spark.table(table).columns if c != "etl_created_date"]
    sink.write_table(spark.table(table).select(columns), f"{layout.dwd}.one_by_one")
    sink.drop_objects(spark, tables=[table, held.table_of(table)])
    done = warehouse.build_dwd_orders_range(spark, days, layout)
    assert set(done.partitions) == set(days)
    got, want = spark.table(table).select(columns), spark.table(f"{layout.dwd}.one_by_one")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    assert held.described(spark, table)[1] == set(days)
    near = replace(layout, most_drift=2)
    with pytest.raises(ValueError, match="2 days from 2001-08-04"):
        warehouse.build_dwd_orders_range(spark, days, near)
    with pytest.raises(ValueError, match="2 days"):
        warehouse.build_dwd_orders(spark, days[2], near)
    with pytest.raises(ValueError, match="ratio"):
        warehouse.build_dwd_orders(spark, days[0], replace(layout, limits=True))
    assert warehouse.build_dwd_orders_range(spark, ["1990-01-01"], layout) is None


def test_reports_are_saved_and_views_outlive_the_session(spark, layout):
    orders = business_table(spark, SF_DIR, "ods_orders")
    for name in ("Customers", "Employees"):
        jobs.store(business_table(spark, SF_DIR, f"ods_{name.lower()}"), layout, name, AS_OF)
    jobs.store(orders, layout, "Orders", AS_OF)
    warehouse.build_dwd_orders(spark, AS_OF, layout)
    warehouse.build_dws_orders(spark, AS_OF, layout)
    names = ("kpi_window", "segments", "customer_status", "growth", "metrics")
    for _ in range(2):
        done = report_plan.build_reports(spark, AS_OF, layout, *names)
    assert list(done) == list(names) and all(r.rows and set(r.partitions) == {AS_OF} for r in done.values())
    database = f"pub_{layout.dws}"
    made = report_plan.publish_views(spark, ["dwd_orders", "dws_orders_daily_summary"], AS_OF, layout, database)
    assert len(made) == 6
    other = spark.newSession()
    assert other.table(f"{database}.dws_daily_kpi").count() == spark.table(f"{layout.dws}.dws_orders_daily_summary").count()
    assert "dt" not in other.table(f"{database}.dwd_orders_status_summary").columns


def test_jobs_leave_nothing_in_the_session(spark):
    names = lambda: sorted(t.name for t in spark.catalog.listTables("default"))
    before = names()
    QUERIES["jobs_increments_daily_kpi"](spark, SF_DIR)
    assert names() == before


# ------------------------------------------------------------ versions
def test_versions_of_loads_that_hold_a_key_once_move_only_the_columns_read(spark, layout):
    orders = business_table(spark, SF_DIR, "ods_orders")
    for name in ("Customers", "Employees"):
        jobs.store(business_table(spark, SF_DIR, f"ods_{name.lower()}"), layout, name, "2001-07-30")
    # some versions of the second load are newer, some older, some of unknown age
    later = orders.filter("OrderID % 3 = 0").withColumns({"Status": F.lit("Canceled"), "UpdatedDate": F.expr("CASE OrderID % 4 WHEN 0 THEN date_add(UpdatedDate, 1) WHEN 1 THEN date_sub(UpdatedDate, 1) WHEN 2 THEN UpdatedDate END")})
    table, keys = f"{layout.dwd}.dwd_orders", ("OrderID",)
    jobs.store(orders, layout, "Orders", "2001-07-30")
    warehouse.build_dwd_orders(spark, "2001-07-30", layout)
    first = layout.recent(spark, table, "2001-07-30")
    assert "Window" not in (plan := first._jdf.queryExecution().optimizedPlan().toString()) and "Aggregate" not in plan
    jobs.store(later, layout, "Orders", "2001-07-31")
    warehouse.build_dwd_orders(spark, "2001-07-31", layout)
    assert held.holding_once(spark, table, keys) == {"2001-07-30", "2001-07-31"} and held.holding_once(spark, table, ("CustomerID",)) == set()
    by_hand = latest_per_key(spark.table(table), keys, "UpdatedDate", "dt")
    for rows in (layout.recent(spark, table, "2001-07-31"), layout.newest(spark.table(table), table)):
        assert rows.exceptAll(by_hand).isEmpty() and by_hand.exceptAll(rows).isEmpty()
    recent = layout.recent(spark, table, "2001-07-31").groupBy("OrderStatus").count()
    assert scanned(recent) and not any("ShippingAddress" in x for x in scanned(recent))
    # a load that holds a key twice: all columns decide again
    jobs.store(later.unionByName(later.limit(2).withColumn("Status", F.lit("Processing"))), layout, "Orders", "2001-08-01")
    warehouse.build_dwd_orders(spark, "2001-08-01", layout)
    assert held.holding_once(spark, table, keys) == {"2001-07-30", "2001-07-31"}
    by_hand, recent = latest_per_key(spark.table(table), keys, "UpdatedDate", "dt"), layout.recent(spark, table, "2001-08-01")
    assert recent.exceptAll(by_hand).isEmpty() and by_hand.exceptAll(recent).isEmpty()
    assert layout.of_changed_days(spark, table, "2001-08-01").groupBy("OrderID").count().filter("count > 1").isEmpty()


def test_a_month_of_recent_rows_moves_only_its_orders(spark, layout, monkeypatch):
    """A month is that of the newest version; of other orders no row is moved, and without descriptions nothing changes."""
    name, of = f"{layout.dwd}.dwd_orders", warehouse.held_of(layout, "orders")
    sink.ensure_database(spark, layout.dwd)
    kinds = "OrderID long, OrderDate date, UpdatedDate date, TotalAmount int, dt string"
    day = lambda text: text and datetime.fromisoformat(text).date()
    first = [(i, "2001-06-10", "2001-06-10", i) for i in range(100, 200)]
    first += [(1, "2001-07-02", "2001-07-02", 1), (2, "2001-07-03", "2001-07-03", 2), (3, "2001-06-30", "2001-06-30", 3)]
    first += [(4, "2001-07-31", "2001-08-05", 4), (5, None, "2001-07-01", 5), (None, "2001-07-04", "2001-07-04", 6)]
    second = [(1, "2001-07-02", "2001-07-09", 10), (2, "2001-06-01", "2001-07-09", 20), (3, "2001-07-01", None, 30), (4, "2001-07-31", "2001-07-31", 40)]
    second += [(6, "2001-08-01", "2001-08-01", 60), (None, "2001-06-04", "2001-07-09", 70)]
    for dt, rows in (("2001-07-30", first), ("2001-07-31", second)):
        held.replace_and_describe(spark.createDataFrame([(k, day(o), day(u), v, dt) for k, o, u, v in rows], kinds), name, of)
    month = lambda: layout.recent_in_month(spark, name, "2001-07-31", "2001-07")
    told = lambda rows: sorted(((r["OrderID"], r["TotalAmount"]) for r in rows.collect()), key=repr)
    assert told(month()) == [(1, 10), (4, 4)]
    assert held.rows_between(spark, name, ["2001-07-30", "2001-07-31"], "2001-07-01", "2001-08-01") == 7
    plan = month()._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Window") < plan.index("LeftSemi")  # orders of other months leave below the window
    monkeypatch.setattr(warehouse, "SENT_KEYS", 0)
    assert told(month()) == [(1, 10), (4, 4)]
    monkeypatch.undo()
    again = spark.createDataFrame([(1, day("2001-07-02"), day("2001-07-10"), v, "2001-07-31") for v in (7, 8)], kinds)
    held.replace_and_describe(again, name, of)  # a load that holds a key twice
    want = told(layout.recent(spark, name, "2001-07-31").filter("OrderDate between '2001-07-01' and '2001-07-31'"))
    assert told(month()) == want and (1, 8) in want
    sink.drop_objects(spark, tables=[held.table_of(name)])
    assert told(month()) == want


def test_descriptions_without_uniqueness_are_brought_up_to_date(spark, db):
    rows, name, of = spark.range(4).select("id", F.lit("1990-01-01").cast("date").alias("day"), F.lit("d1").alias("dt")), f"{db}.t", held.Held("day", "id")
    held.replace_and_describe(rows, name, of)
    old = spark.table(held.table_of(name)).drop("once").localCheckpoint()
    sink.drop_objects(spark, tables=[held.table_of(name)])
    sink.replace_partitions(old, held.table_of(name))
    assert held.holding_once(spark, name, ("id",)) == set()
    held.replace_and_describe(rows.withColumn("dt", F.lit("d2")), name, replace(of, once=("id",)))
    held.replace_and_describe(rows.unionAll(rows.limit(1)).withColumn("dt", F.lit("d3")), name, replace(of, once=("id",)))
    assert held.holding_once(spark, name, ("id",)) == {"d2"}


def test_all_loads_of_lines_come_from_one_pass(spark):
    loads = jobs.line_loads(spark, SF_DIR)
    plan = loads._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Join ") == 1
    lines = business_table(spark, SF_DIR, "ods_orderdetails").join(business_table(spark, SF_DIR, "ods_orders").select("OrderID", "OrderDate", "RequiredDate"), "OrderID", "left")
    first = "coalesce(year(OrderDate) < 2001 AND RequiredDate IS NOT NULL, false)"
    want = [lines.filter(x).count() for x in (first, f"NOT {first}", "year(OrderDate) = 2000")]
    got = {r["dt"]: r["count"] for r in loads.groupBy("dt").count().collect()}
    assert [got.get(day, 0) for day in jobs.LOADS] == want
    assert loads.filter("dt < '2001-08-01'").groupBy("OrderDetailID").count().filter("count > 1").isEmpty()
    changed = loads.filter("dt < '2001-08-01'").join(loads.filter("dt = '2001-08-01'").select("OrderDetailID"), "OrderDetailID", "left_semi")
    assert {r[0] for r in changed.select("Status").distinct().collect()} == {"Backorder"}


def test_the_first_states_are_stored_once(spark, layout, monkeypatch):
    orders = business_table(spark, SF_DIR, "ods_orders")
    for name in ("Customers", "Employees"):
        jobs.store(business_table(spark, SF_DIR, f"ods_{name.lower()}"), layout, name, "2001-07-30")
    plain, beside = sink.write_table, []
    monkeypatch.setattr(sink, "write_table", lambda df, name, **named: beside.append(name) or plain(df, name, **named))
    for day, rows in (("2001-07-30", orders), ("2001-07-31", orders.filter("OrderID % 50 = 0"))):
        jobs.store(rows, layout, "Orders", day)
        warehouse.build_dwd_orders(spark, day, layout)
        state_plan.build_states(spark, day, layout, "monthly")
        assert len(beside) == (day == "2001-07-31")
    merged = state_plan.monthly_summary(spark, "2001-07-31", layout)
    assert merged.agg(F.sum("total_orders")).first()[0] == orders.filter("OrderDate <= '2001-07-31' OR OrderDate IS NULL").count()
    assert not sink.table_exists(spark, f"{state_plan.table_of(layout, 'monthly')}__delta")


# ------------------------------------------------------------ cost of verified writes
def test_rows_of_a_few_dates_are_not_sorted_to_be_written(spark, db, monkeypatch):
    seen = []
    for path in ("saveAsTable", "insertInto"):
        plain = getattr(DataFrameWriter, path)
        monkeypatch.setattr(DataFrameWriter, path, lambda self, name, plain=plain, **more: seen.append(spark.conf.get(sink.OPEN_FILES)) or plain(self, name, **more))
    before, name, many = spark.conf.get(sink.OPEN_FILES), f"{db}.t", 3 * sink.MOST_OPEN
    rows = spark.range(0, 5 * many, 1, 1).selectExpr("id", f"cast(id % {many} as string) AS dt")  # more dates in a task than are kept open
    for _ in range(2):
        done = sink.replace_partitions(rows, name).require_complete()
        assert done.partitions == {str(i): 5 for i in range(many)} and rows.exceptAll(spark.table(name)).isEmpty()
    assert seen == [str(sink.MOST_OPEN)] * 2 and spark.conf.get(sink.OPEN_FILES) == before
    insert = f"EXPLAIN INSERT OVERWRITE {name} SELECT id, 'x' || id % 2 AS dt FROM range(9)"
    with sink.unsorted_writes(spark):
        assert "Sort" not in spark.sql(insert).first()[0]


def test_hashes_add_up_exactly(spark):
    hashes = [-(1 << 63), (1 << 63) - 1, (1 << 63) - 1, -1, 0, 1, -(1 << 42), (1 << 42) - 1, (1 << 21) - 1, -(1 << 63), 123456789012345678]
    for some in (hashes, hashes[:1], []):
        rows = spark.createDataFrame([(h,) for h in some], "h long")
        assert int(rows.agg(sink.sum_of_hashes(F.col("h"))).first()[0]) == sum(some)


def test_summaries_of_a_date_are_written_side_by_side(spark, layout, monkeypatch):
    met, plain = threading.Barrier(3, timeout=60), sink.replace_partitions
    monkeypatch.setattr(sink, "replace_partitions", lambda *rows, **named: met.wait() + 1 and plain(*rows, **named))
    some = spark.range(3)
    made = {"dws_a": lambda: some, "dws_none": lambda: some.limit(0), "dws_b": lambda: some}
    assert warehouse._write(spark, layout, "2001-07-30", made) == ["dws_a", "dws_b"]
    assert spark.table(f"{layout.dws}.dws_b").count() == 3
