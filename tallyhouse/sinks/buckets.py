"""One row per key, stored by hash bucket of the key, so that an upsert rewrites the buckets it touches only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.snapshots import latest_per_key, upsert
from tallyhouse.sinks import tables as sink

BUCKET = "__bucket"
#: Property of a table that says how many buckets it has.
PROPERTY = "upsert.buckets"


def bucket_of(keys: Iterable[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, name: str) -> int | None:
    """The number of buckets of a table, None if it is not stored by bucket."""
    if BUCKET not in spark.table(name).columns:
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {sink.quoted(name)}").collect()}
    return int(found[PROPERTY])


def upserted(spark: SparkSession, name: str) -> DataFrame:
    """The rows of such a table without their bucket."""
    return spark.table(name).drop(BUCKET)


def upsert_table(changes: DataFrame, name: str, keys: Iterable[str], order_col: str, *, buckets: int = 64, path: str | None = None) -> sink.WriteResult:
    """Merge changes into a table that holds the newest row of each key.

    The changes are stored first, reduced to one row a key: they name their buckets, and the merge
    reads just what named them, however the source moves on.  Of the target only these buckets
    are read, merged and replaced; the files of all others stay.  A table keeps the number of buckets it
    was made with; one that was stored without buckets is rewritten once.  No changes change nothing.
    Choose the number so that a bucket fills a few files: the delta touches at most one bucket a key.
    """
    spark, keys = changes.sparkSession, list(keys)
    staged = f"{name}__delta"
    exists = sink.table_exists(spark, name)
    held = buckets_of(spark, name) if exists else None
    number = held or buckets
    if exists:
        kinds = {f.name: f.dataType for f in spark.table(name).schema.fields if f.name != BUCKET}
        sink.require_same_columns(changes, list(kinds), name)
        changes = changes.select(*(F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()))
    newest = latest_per_key(changes, keys, order_col).withColumn(BUCKET, bucket_of(keys, number))
    sink.drop_objects(spark, tables=[staged])
    try:
        taken = sink.write_table(newest, staged).require_complete().rows
        delta = spark.table(staged)
        if not taken:
            return sink.WriteResult(name, 0)
        if not exists:
            done = sink.replace_partitions(delta, name, part_col=BUCKET, path=path, rebalance=True)
            _mark(spark, name, number)
            return done
        if held is None:
            return _rewritten(spark, name, delta, keys, order_col, number)
        touched = [r[0] for r in delta.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
        target = spark.table(name).filter(F.col(BUCKET).isin(touched))
        merged = upsert(target, delta.select(*target.columns), [BUCKET, *keys], order_col)
        return sink.replace_partitions(merged, name, part_col=BUCKET, rebalance=True)
    finally:
        sink.drop_objects(spark, tables=[staged])


def _mark(spark: SparkSession, name: str, buckets: int) -> None:
    spark.sql(f"ALTER TABLE {sink.quoted(name)} SET TBLPROPERTIES ('{PROPERTY}' = '{buckets}')")


def _rewritten(spark: SparkSession, name: str, delta: DataFrame, keys: list[str], order_col: str, buckets: int) -> sink.WriteResult:
    """A table without buckets, merged and stored anew; one with a folder of its own loses that folder's place."""
    target = spark.table(name)
    new = f"{name}__new"
    sink.drop_objects(spark, tables=[new])
    merged = upsert(target, delta.drop(BUCKET).select(*target.columns), keys, order_col).withColumn(BUCKET, bucket_of(keys, buckets))
    sink.replace_partitions(merged, new, part_col=BUCKET, rebalance=True).require_complete()
    done = sink.replace_partitioned_table(spark, new, name, BUCKET)
    _mark(spark, name, buckets)
    return done
