"""Writing tables: replacing partitions, repeating runs, cleaning up."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallyhouse.sinks import tables as sink


@pytest.fixture
def db(spark):
    name = f"t{uuid.uuid4().hex[:8]}"
    sink.ensure_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def load(spark, dt, *ids):
    return spark.createDataFrame([(i, f"v{i}", dt) for i in ids], "id int, v string, dt string")


def held(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "dt").collect())


def test_replacing_a_partition_keeps_the_others(spark, db):
    name = f"{db}.t"
    first = sink.replace_partitions(load(spark, "d1", 1, 2), name)
    second = sink.replace_partitions(load(spark, "d2", 3), name)
    assert (first.rows, first.partitions) == (2, {"d1": 2}) and second.partitions == {"d2": 1}
    sink.replace_partitions(load(spark, "d1", 9), name)
    assert held(spark, name) == [(3, "d2"), (9, "d1")]
    again = sink.replace_partitions(load(spark, "d1", 9), name)
    assert again.complete and held(spark, name) == [(3, "d2"), (9, "d1")]
    assert sink.list_partitions(spark, name) == ["d1", "d2"]


def test_an_empty_load_changes_nothing(spark, db):
    name = f"{db}.t"
    nothing = load(spark, "d1", 1).filter("1 = 0")
    assert sink.replace_partitions(nothing, name).partitions == {}
    sink.replace_partitions(load(spark, "d1", 1), name)
    done = sink.replace_partitions(load(spark, "d1", 2).filter("id > 9"), name)
    assert (done.rows, done.partitions, done.complete) == (0, {}, True)
    assert held(spark, name) == [(1, "d1")]
    # unless the load stands for that partition
    sink.replace_partitions(load(spark, "d2", 2), name)
    sink.replace_partitions(load(spark, "d1", 2).filter("id > 9"), name, dates=["d1"])
    assert held(spark, name) == [(2, "d2")]


def test_a_failing_overwrite_leaves_the_table(spark, db, tmp_path):
    for path in (None, str(tmp_path / "ext")):
        name = f"{db}.{'plain' if path is None else 'ext'}"
        sink.write_table(load(spark, "d", 1), name, path=path)
        broken = load(spark, "d", 5).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
        with pytest.raises(Exception, match="broken"):
            sink.write_table(broken, name, path=path)
        assert held(spark, name) == [(1, "d")]
        sink.write_table(spark.table(name).withColumn("id", F.col("id") + 1), name, path=path)
        assert held(spark, name) == [(2, "d")]
        assert sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary) == sorted({"plain", name.split(".")[1]})


def test_incomplete_writes_are_errors():
    with pytest.raises(RuntimeError, match="2 rows written"):
        sink.WriteResult("t", 2, {"d": 1}).require_complete()
    assert sink.WriteResult("t", 2, {"d": 2}).require_complete().rows == 2


def test_columns_are_matched_by_name(spark, db):
    name = f"{db}.t"
    sink.replace_partitions(load(spark, "d1", 1), name)
    sink.replace_partitions(load(spark, "d2", 2).select("dt", "v", "id"), name)
    assert held(spark, name) == [(1, "d1"), (2, "d2")]
    with pytest.raises(ValueError, match="extra"):
        sink.replace_partitions(load(spark, "d2", 2).withColumn("extra", F.lit(1)), name)


def test_a_repeated_run_of_an_external_table_does_not_double_it(spark, db, tmp_path):
    name = f"{db}.t"
    for _ in range(2):
        sink.replace_partitions(load(spark, "d1", 1, 2), name, path=str(tmp_path / "t"))
    assert held(spark, name) == [(1, "d1"), (2, "d1")]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_a_failing_write_leaves_the_table(spark, db):
    name = f"{db}.t"
    sink.replace_partitions(load(spark, "d1", 1), name)
    broken = load(spark, "d1", 5).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sink.replace_partitions(broken, name)
    assert held(spark, name) == [(1, "d1")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"


def test_a_read_table_may_be_replaced_from_a_stored_result(spark, db):
    name = f"{db}.t"
    sink.replace_partitions(load(spark, "d1", 1, 2), name)
    sink.write_table(spark.table(name).filter("id > 1"), f"{db}.staged")
    sink.replace_partitions(spark.table(f"{db}.staged"), name)
    assert held(spark, name) == [(2, "d1")]


def test_retention_drops_only_older_partitions(spark, db):
    name = f"{db}.t"
    for dt in ("2020-01-01", "2020-01-30", "2020-01-31", "2020-03-01"):
        sink.replace_partitions(load(spark, dt, 1), name)
    gone = sink.drop_old_partitions(spark, name, keep_days=30, as_of="2020-03-01")
    assert gone == ["2020-01-01", "2020-01-30"]
    assert sink.list_partitions(spark, name) == ["2020-01-31", "2020-03-01"]
    assert sink.drop_old_partitions(spark, name, keep_days=30, as_of="2020-03-01") == []


def test_plain_tables(spark, db, tmp_path):
    name = f"{db}.plain"
    assert not sink.table_exists(spark, name)
    assert sink.write_table(load(spark, "d", 1, 2), name).rows == 2
    sink.write_table(load(spark, "d", 3), name, mode="append")
    assert spark.table(name).count() == 3 and sink.list_partitions(spark, name) is None
    sink.write_table(load(spark, "d", 4), name)
    assert held(spark, name) == [(4, "d")]
    sink.write_table(load(spark, "d", 5), f"{db}.ext", path=str(tmp_path / "ext"))
    assert spark.read.parquet(str(tmp_path / "ext")).count() == 1
    sink.refresh_and_analyze(spark, name)
    sink.drop_objects(spark, tables=[name], views=["no_such_view"])
    assert not sink.table_exists(spark, name)


def test_files_are_sized(spark, tmp_path):
    path = str(tmp_path / "f")
    sink.write_files(spark.range(100).coalesce(1), path, max_records=30, codec="snappy")
    files = [p.name for p in (tmp_path / "f").iterdir() if p.name.endswith(".snappy.parquet")]
    assert len(files) == 4 and spark.read.parquet(path).count() == 100


def test_file_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    sink.replace_file_partitions(load(spark, "d1", 1, 2).unionAll(load(spark, "d2", 3)), path, rebalance=True)
    sink.replace_file_partitions(load(spark, "d2", 4), path)
    got = sorted((r["id"], r["dt"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "d1"), (2, "d1"), (4, "d2")]


def test_rebalanced_rows_make_one_file_per_small_partition(spark, db, tmp_path):
    rows = spark.range(1000, numPartitions=8).select(
        F.col("id").cast("int"), F.lit("v").alias("v"), F.concat(F.lit("d"), F.col("id") % 3).alias("dt")
    )
    for _ in range(2):
        sink.replace_partitions(rows, f"{db}.t", path=str(tmp_path / "t"), rebalance=True)
    files = list((tmp_path / "t").glob("dt=*/*.parquet"))
    assert len(files) == 3 and spark.table(f"{db}.t").count() == 1000


def test_verification_compares_by_partition(spark, db):
    name = f"{db}.t"
    sink.replace_partitions(load(spark, "d1", 1, 2), name)
    wanted = load(spark, "d1", 1, 2).unionAll(load(spark, "d2", 3))
    got = {r["dt"]: (r["expected"], r["stored"], r["passed"]) for r in sink.verify_write(spark, name, wanted).collect()}
    assert got == {"d1": (2, 2, True), "d2": (1, 0, False)}


def test_schema_policies(spark, db):
    name = f"{db}.t"
    sink.replace_partitions(load(spark, "d1", 1), name)
    wider = load(spark, "d2", 2).withColumn("extra", F.lit(7)).drop("v")
    with pytest.raises(ValueError, match="new"):
        sink.evolve_schema(spark, wider, name, "fail")
    sink.replace_partitions(sink.evolve_schema(spark, wider, name), name)
    got = {tuple(r) for r in spark.table(name).select("id", "v", "extra").collect()}
    assert got == {(1, "v1", None), (2, None, 7)}
    retyped = load(spark, "d3", 3).withColumn("id", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="changed"):
        sink.evolve_schema(spark, retyped, name)
    rows = sink.evolve_schema(spark, retyped, name, "recreate", backup=f"{db}.t_backup")
    sink.replace_partitions(rows, name)
    assert spark.table(name).count() == 1 and spark.table(f"{db}.t_backup").count() == 2
    assert sink.list_partitions(spark, f"{db}.t_backup") == ["d1", "d2"]
    with pytest.raises(ValueError, match="unknown"):
        sink.evolve_schema(spark, rows, name, "guess")


def test_databases_come_from_the_table_names(spark, db):
    assert sink.databases_of(["a.x", "a.y", "b.z", "plain"]) == {"a", "b"}
