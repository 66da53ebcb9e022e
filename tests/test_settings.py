"""Session settings and the folder registered queries write to."""

from registry.queries import scratch
from tallyhouse.plans.settings import settings_for


def partitions(*args):
    return int(settings_for(*args)["spark.sql.shuffle.partitions"])


def test_partitions_follow_the_data():
    assert partitions(0, 8) == 16
    assert partitions(10 * 1024**4, 4000) == 40960
    assert partitions(100 * 1024**4, 4000) == 409600
    assert partitions(100 * 1024**4, 4000, 100_000) == 100_000


def test_settings_are_known_to_spark(spark):
    before = {key: spark.conf.get(key) for key in settings_for(1, 8)}
    for key, value in settings_for(1, 8).items():
        spark.conf.set(key, value)
    for key, value in before.items():
        spark.conf.set(key, value)


class Conf:
    def __init__(self, folder):
        self.folder, self.conf = folder, self

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.folder, "spark.sql.warehouse.dir": "hdfs://x/warehouse"}[key] or default


def test_queries_write_to_the_shared_folder():
    shared = scratch(Conf("hdfs://x/checkpoints/"), "orders")
    assert shared.startswith("hdfs://x/checkpoints/orders-")
    assert scratch(Conf("hdfs://x/checkpoints"), "orders") != shared
    assert scratch(Conf(None), "orders").startswith("hdfs://x/warehouse/orders-")
