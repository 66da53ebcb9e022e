"""Sources.  No database is started: the JDBC reader's requests are checked on a stand-in."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import jdbc, tables


class Reader:
    """Records the options of a read and answers with the rows of a DataFrame."""

    def __init__(self, log, answer):
        self.log, self.answer, self.options_seen = log, answer, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, key, value):
        self.options_seen[key] = value
        return self

    def options(self, **more):
        self.options_seen.update(more)
        return self

    def load(self):
        self.log.append(self.options_seen)
        return self.answer


class Session:
    def __init__(self, answer):
        self.log, self.answer = [], answer

    @property
    def read(self):
        return Reader(self.log, self.answer)


OPTS = jdbc.JdbcOptions("jdbc:x:y", {"user": "u", "password": "secret"}, fetch_size=5000)


@pytest.fixture
def session(spark):
    rows = [(i, f"n{i}", datetime(2020, 1, i)) for i in range(1, 11)]
    return Session(spark.createDataFrame(rows, "id int, name string, changed timestamp"))


def test_requests(session):
    assert jdbc.read_table(session, OPTS, "t").count() == 10
    assert session.log[0] == {
        "url": "jdbc:x:y", "fetchsize": 5000, "user": "u", "password": "secret", "dbtable": "t",
    }
    assert jdbc.read_columns(session, OPTS, "t", ["id"]).columns == ["id"]
    assert jdbc.read_since(session, OPTS, "t", "changed", datetime(2020, 1, 8)).count() == 2
    assert jdbc.read_since(session, OPTS, "t", "changed", None).count() == 10
    assert jdbc.sample_scan(session, OPTS, "t", 3).count() == 3


def test_parallel_read_takes_its_bounds_from_the_table(session):
    jdbc.read_partitioned(session, OPTS, "t", "id", 4)
    asked = session.log[-1]
    assert (asked["partitionColumn"], asked["lowerBound"], asked["upperBound"], asked["numPartitions"]) == (
        "id", "1", "10", 4,
    )
    one = Session(session.answer.filter(F.col("id") == 1))
    jdbc.read_partitioned(one, OPTS, "t", "id", 4)
    assert "numPartitions" not in one.log[-1]


def test_credentials_are_not_printed():
    assert "secret" not in repr(OPTS)


def test_tables_are_found_in_any_case(spark):
    rows = [("shop", "Orders"), ("shop", "CUSTOMERS"), ("other", "gone")]
    listed = Session(spark.createDataFrame(rows, "TABLE_SCHEMA string, TABLE_NAME string"))
    names = jdbc.existing_tables(listed, OPTS, "shop")
    assert jdbc.existing_tables(listed, OPTS) == names | {"gone"}
    assert jdbc.select_existing(["orders", "Customers", "gone"], names) == (["orders", "Customers"], ["gone"])


def test_stored_and_literal_rows(spark, tmp_path):
    rows = tables.literal_rows(spark, [(1, "a")], "id int, v string")
    rows.write.parquet(str(tmp_path / "p"))
    assert tables.parquet_files(spark, str(tmp_path / "p")).collect() == rows.collect()
    rows.createOrReplaceTempView("literal_rows_view")
    assert tables.catalog_table(spark, "literal_rows_view").count() == 1


def test_source_tables_name_their_key_and_change_column():
    for spec in tables.SOURCE_TABLES.values():
        columns = spec["columns"]
        assert spec["key"] in columns and spec["changed"] in columns
