"""Writing files and catalog tables, and looking after them."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructField, StructType

from tallyhouse.operators.snapshots import days_before

CODEC = "snappy"


@dataclass(frozen=True)
class WriteResult:
    """What one write did: rows handed over, and rows found afterwards, by partition or (``found``) in the whole table.

    ``digests`` are those of the rows handed over and of the rows found, None where they were not taken.
    """

    table: str
    rows: int
    partitions: dict[str, int] = field(default_factory=dict)
    found: int | None = None
    digests: tuple[int, int] | None = None

    @property
    def complete(self) -> bool:
        found = sum(self.partitions.values()) if self.found is None else self.found
        return found == self.rows and (self.digests is None or self.digests[0] == self.digests[1])

    def require_complete(self) -> WriteResult:
        """Fail if the table holds other rows than it was given."""
        if not self.complete:
            found = dict(self.partitions) if self.found is None else self.found
            raise RuntimeError(f"{self.table}: {self.rows} rows written, found {found}, digests {self.digests}")
        return self


def digest(kinds: Mapping[str, DataType]) -> Column:
    """The sum of 64-bit hashes of rows, whatever their order, over columns cast to these types; 0 without rows.

    A row that is lost, doubled or changed, or whose values change places, changes the sum.
    """
    return sum_of_hashes(row_hash(kinds))


def row_hash(kinds: Mapping[str, DataType]) -> Column:
    cols = [F.col(f"`{c}`").cast(relaxed(kind)) for c, kind in kinds.items()]
    plain = [F.to_json(F.struct(c)) if "map<" in kind.simpleString() else c for c, kind in zip(cols, kinds.values())]
    nulls = F.concat(*(F.when(c.isNull(), "0").otherwise("1") for c in cols))  # a hash passes over null values
    return F.xxhash64(nulls, *plain)


def sum_of_hashes(hashes: Column) -> Column:
    """The exact sum, added up as whole numbers of 22, 21 and 21 bits: one decimal a row would cost more than the hash."""
    total = F.lit(0).cast("decimal(38,0)")
    for part, worth in ((F.shiftright(hashes, 42), 1 << 42), (_low_bits(F.shiftright(hashes, 21)), 1 << 21), (_low_bits(hashes), 1)):
        total = total + F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * F.lit(worth).cast("decimal(14,0)")
    return total.cast("decimal(38,0)")


def _low_bits(whole: Column) -> Column:
    return whole.bitwiseAND(F.lit((1 << 21) - 1).cast("long"))


def observed(rows: DataFrame, seen: Observation, kinds: Mapping[str, DataType], *also: Column) -> DataFrame:
    """The rows, whose number and, if there are ``kinds``, digest are observed as they pass: hashed below the observation,
    whose own expressions are slow."""
    counts = [F.count(F.lit(1)).alias("rows"), *also]
    if not kinds:
        return rows.observe(seen, *counts)
    hashed = rows.withColumn("__hash", row_hash(kinds))
    return hashed.observe(seen, *counts, sum_of_hashes(F.col("__hash")).alias("digest")).drop("__hash")


def relaxed(kind: DataType) -> DataType:
    """A type whose parts may all be NULL, as they may in a stored table."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, relaxed(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(relaxed(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(relaxed(kind.keyType), relaxed(kind.valueType))
    return kind


def types_of(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in sorted(df.schema.fields, key=lambda f: f.name)}


# ------------------------------------------------------------ catalog
def ensure_database(spark: SparkSession, name: str) -> None:
    """K11."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")
    if not spark.catalog.databaseExists(name):
        raise RuntimeError(f"database {name} was not created")


def databases_of(tables: Iterable[str]) -> set[str]:
    """The databases named by ``database.table`` names."""
    return {name.split(".")[0] for name in tables if "." in name}


def table_exists(spark: SparkSession, name: str) -> bool:
    """K12."""
    return spark.catalog.tableExists(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def list_partitions(spark: SparkSession, name: str, part_col: str = "dt") -> list[str] | None:
    """The dates a table has, sorted; None for a table that is not partitioned."""
    if part_col not in partition_columns(spark, name):
        return None
    found = spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()
    specs = (dict(part.split("=", 1) for part in row[0].split("/")) for row in found)
    return sorted({spec[part_col] for spec in specs})


def drop_objects(spark: SparkSession, *, tables: Iterable[str] = (), views: Iterable[str] = ()) -> None:
    """Drops a table with its history.  Never part of a normal run."""
    for name in views:
        spark.sql(f"DROP VIEW IF EXISTS {quoted(name)}")
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def refresh_and_analyze(spark: SparkSession, name: str, noscan: bool = False) -> None:
    """K19.  ``noscan`` takes the size from the files without counting rows."""
    spark.catalog.refreshTable(name)
    spark.sql(f"ANALYZE TABLE {quoted(name)} COMPUTE STATISTICS{' NOSCAN' if noscan else ''}")


def quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


# ------------------------------------------------------------ writing
def sized(df: DataFrame, *by: str) -> DataFrame:
    """K9: files of the advised size, whatever the number of tasks before.

    Spark joins small pieces and splits a large partition into several files while
    the job runs, so one partition with most of the rows is no single task.  This
    moves all rows once: worth it for rows of many partitions in every task, not for
    one partition written by well-filled tasks.
    """
    return df.hint("rebalance", *by)


def writer(df: DataFrame, mode: str, codec: str = CODEC, max_records: int | None = None, path: str | None = None, block_bytes: int | None = None):
    """K9: a Parquet writer; ``block_bytes`` is the size of a row group.  A table keeps the options that it is made with."""
    out = df.write.format("parquet").mode(mode).option("compression", codec)
    if max_records is not None:
        out = out.option("maxRecordsPerFile", max_records)
    if block_bytes is not None:
        out = out.option("parquet.block.size", block_bytes)
    return out if path is None else out.option("path", path)


def write_files(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    codec: str = CODEC,
    max_records: int | None = None,
    block_bytes: int | None = None,
    partition_by: Iterable[str] = (),
) -> None:
    """K1: Parquet files."""
    writer(df, mode, codec, max_records, block_bytes=block_bytes).partitionBy(*partition_by).save(path)


def replace_partitioned_table(spark: SparkSession, new: str, name: str, part_col: str, bucket_by: tuple[str, int] | None = None) -> WriteResult:
    """A table in partitions takes the rows, and the columns, of a new one beside it, which is dropped last: a run that
    fails in between leaves them there.  Copied, as a catalog need not move the partitions of a table that it renames."""
    drop_objects(spark, tables=[name])
    done = replace_partitions(spark.table(new), name, part_col=part_col, rebalance=bucket_by is None, bucket_by=bucket_by).require_complete()
    drop_objects(spark, tables=[new])
    return done


def replace_file_partitions(
    df: DataFrame, path: str, *, part_col: str = "dt", codec: str = CODEC, rebalance: bool = False
) -> None:
    """K4 on plain files: write the partitions in ``df`` in place of their old contents."""
    ready = sized(df, part_col) if rebalance else df
    out = writer(ready, "overwrite", codec).option("partitionOverwriteMode", "dynamic")
    out.partitionBy(part_col).save(path)


def write_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    path: str | None = None,
    codec: str = CODEC,
    max_records: int | None = None,
    block_bytes: int | None = None,
    rebalance: bool = False,
    verify: bool = True,
    keep_if_empty: bool = False,
) -> WriteResult:
    """A table without partitions, external if ``path`` is given.

    A table that is there is replaced only when all new rows are written and found again: they go
    to a table beside it, ``<name>__new``, which then takes its name.  So a failing task leaves
    the table as it was, and the rows may be read from the table itself.  An external
    table keeps its folder and takes a copy of the new rows; should that fail,
    ``<name>__new`` still holds them.  ``verify`` reads what was written once and compares its
    digest; without it, and when rows are appended, they are counted from the file footers.
    ``keep_if_empty`` leaves a table that is there as it is if there are no rows.
    """
    spark = df.sparkSession
    exists = table_exists(spark, name)
    swapped = mode == "overwrite" and exists
    to = f"{name}__new" if swapped else name
    if swapped:
        drop_objects(spark, tables=[to])
    before = spark.table(name).count() if exists and not swapped else 0
    kinds = types_of(df) if verify and not before else {}
    seen = Observation()
    ready = sized(df) if rebalance else df
    # counted in the writing stage itself: a stage run again would count its rows again
    counted = observed(ready, seen, kinds)
    with released_shuffles(spark):
        writer(counted, mode, codec, max_records, None if swapped else path, block_bytes).saveAsTable(to)
    rows = seen.get["rows"]
    if kinds:
        hashes = spark.table(to).select(row_hash(kinds).alias("__hash"))
        number, sum_ = hashes.agg(F.count(F.lit(1)), sum_of_hashes(F.col("__hash"))).first()
        done = WriteResult(name, rows, found=number, digests=(int(seen.get["digest"]), int(sum_)))
    else:
        done = WriteResult(name, rows, found=spark.table(to).count() - before)
    if swapped and (not done.complete or keep_if_empty and not rows):
        drop_objects(spark, tables=[to])
    elif swapped and path is not None:
        writer(spark.table(to), mode, codec, max_records, path, block_bytes).saveAsTable(name)
        drop_objects(spark, tables=[to])
    elif swapped:
        swap(spark, to, name)
    return done


def swap(spark: SparkSession, new: str, name: str) -> None:
    """A table takes the name of another one, which is dropped last."""
    old = f"{name}__old"
    drop_objects(spark, tables=[old])
    spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(old)}")
    spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(name)}")
    drop_objects(spark, tables=[old])
    spark.catalog.refreshTable(name)


def replace_partitions(
    df: DataFrame,
    name: str,
    *,
    part_col: str = "dt",
    path: str | None = None,
    codec: str = CODEC,
    max_records: int | None = None,
    block_bytes: int | None = None,
    rebalance: bool = False,
    dates: Iterable[str] = (),
    verify: bool = True,
    bucket_by: tuple[str, int] | None = None,
) -> WriteResult:
    """Write the partitions in ``df`` in place of their old contents.

    All other partitions stay, so a run can be repeated.  Spark moves the new files
    in when every task has finished; a run that fails leaves the table as it was.
    ``rebalance`` sizes the files of rows that belong to many partitions.  ``dates`` are
    the partitions the rows stand for: one that gets no rows is dropped, so that a run
    repeated over a corrected source leaves nothing stale.  ``verify`` reads the new
    partitions once and compares their digest with that of the rows handed over; without
    it their rows are counted from the file footers.  ``bucket_by`` (a column and a number)
    stores a new table in sorted buckets of a key, one file each: tables with equal buckets are joined
    by that key where they lie.  Later writes keep the buckets.
    """
    spark = df.sparkSession
    exists = table_exists(spark, name)
    buckets = bucket_spec(spark, name) if exists else bucket_by
    if exists:
        table = spark.table(name)
        columns = table.columns
        require_same_columns(df, columns, name)
    else:
        table = df
        columns = [*(c for c in df.columns if c != part_col), part_col]
    kinds = types_of(table) if verify else {}
    ordered = df.select(*columns)
    ready = sized(ordered, part_col) if rebalance else ordered
    if buckets is not None:
        ready = ordered.repartition(buckets[1], buckets[0])
    seen = Observation()
    # counted in the writing stage, see write_table; the dates of a load are a handful
    part = F.col(part_col)
    counted = observed(ready, seen, kinds, F.count(part).alias("dated"), F.collect_set(part).alias("dates"))
    if exists:
        with dynamic_overwrite(spark), unsorted_writes(spark), released_shuffles(spark):
            writer(counted, "overwrite", codec, max_records, block_bytes=block_bytes).insertInto(name)
    else:
        out = writer(counted, "errorifexists", codec, max_records, path, block_bytes).partitionBy(part_col)
        if buckets is not None:
            out = out.bucketBy(buckets[1], buckets[0]).sortBy(buckets[0])
        with unsorted_writes(spark), released_shuffles(spark):
            out.saveAsTable(name)
    written, rows = seen.get["dates"], seen.get["rows"]
    drop_partitions(spark, name, [d for d in dates if d not in written], part_col)
    spark.catalog.refreshTable(name)
    some = part.isin(written) if rows == seen.get["dated"] else part.isin(written) | part.isNull()
    stored = spark.table(name).filter(some)
    if verify:
        hashes = stored.select(part, row_hash(kinds).alias("__hash"))
        held = hashes.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), sum_of_hashes(F.col("__hash")).alias("digest")).collect()
    else:
        held = stored.groupBy(part).agg(F.count(F.lit(1)).alias("rows")).collect()
    digests = (int(seen.get["digest"]), sum(int(r["digest"]) for r in held)) if verify else None
    return WriteResult(name, rows, {r[0]: r["rows"] for r in held}, digests=digests)


def bucket_spec(spark: SparkSession, name: str) -> tuple[str, int] | None:
    """The column and number of a table's buckets, None without any."""
    found = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()}
    number = int(found.get("Num Buckets") or 0)
    if not number:
        return None
    return found["Bucket Columns"].strip("[]").replace("`", "").split(",")[0].strip(), number


def drop_partitions(spark: SparkSession, name: str, dates: Iterable[str], part_col: str = "dt") -> None:
    specs = ", ".join(f"PARTITION (`{part_col}` = '{d}')" for d in dates)
    if specs:
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {specs}")


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Partitions of a table that a task writes side by side; rows of further ones are sorted by partition first.
MOST_OPEN = 8
_lock = threading.Lock()
_writing: dict[str, list] = {}


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """The session overwrites only the partitions it writes, inside the block.

    A setting of the session, because ``insertInto`` ignores the writer's option.
    """
    with _while_writing(spark, OVERWRITE_MODE, "dynamic"):
        yield


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """K9: rows of a few partitions go to their files as they come, inside the block: Spark would sort, and spill, all rows by
    partition first, those of a single date too."""
    with _while_writing(spark, OPEN_FILES, str(MOST_OPEN)):
        yield


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """What an action inside the block moves between its stages leaves the disk when the action ends: Spark would keep it until the
    driver's memory is cleaned, and a job of many writes holds that of all of them."""
    with _while_writing(spark, RELEASED, "true"):
        yield


@contextmanager
def _while_writing(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session. Several threads may write at once: the first one in sets it, the last one out takes it back."""
    with _lock:
        if key not in _writing:
            _writing[key] = [0, spark.conf.get(key, None)]
            spark.conf.set(key, value)
        _writing[key][0] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[key][0] -= 1
            if not _writing[key][0]:
                before = _writing.pop(key)[1]
                if before is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before)


def require_same_columns(df: DataFrame, columns: list[str], name: str) -> None:
    if set(df.columns) != set(columns):
        odd = sorted(set(df.columns) ^ set(columns))
        raise ValueError(f"columns differ from table {name}: {', '.join(odd)} (see evolve_schema)")


# ------------------------------------------------------------ checking and cleaning
def count_partitions(spark: SparkSession, name: str, dates: Iterable[str], part_col: str = "dt") -> dict[str, int]:
    """Stored rows of some partitions; from the file footers, no column is read."""
    wanted = spark.table(name).filter(F.col(part_col).isin(list(dates)))
    return {row[0]: row[1] for row in wanted.groupBy(part_col).count().collect()}


def verify_write(spark: SparkSession, name: str, expected: DataFrame, part_col: str = "dt") -> DataFrame:
    """(dt, expected, stored, passed) for the rows handed to a write, which pass if counts and digests are equal."""
    table = spark.table(name)
    kinds = types_of(table)
    want = expected.groupBy(part_col).agg(F.count(F.lit(1)).alias("expected"), digest(kinds).alias("__want"))
    have = table.groupBy(part_col).agg(F.count(F.lit(1)).alias("stored"), digest(kinds).alias("__have"))
    both = want.join(have, part_col, "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
    equal = (F.col("expected") == F.col("stored")) & F.coalesce(F.col("__want") == F.col("__have"), F.lit(False))
    return both.withColumn("passed", equal).drop("__want", "__have")


def drop_old_partitions(
    spark: SparkSession, name: str, *, part_col: str = "dt", keep_days: int, as_of: str
) -> list[str]:
    """Drop partitions older than ``keep_days`` before the date; returns their dates.

    Of an external table only the catalog entries go, the files are the owner's.
    """
    oldest = days_before(as_of, keep_days)
    old = [d for d in list_partitions(spark, name, part_col) or [] if d < oldest]
    drop_partitions(spark, name, old, part_col)
    return old


def file_sizes(spark: SparkSession, name: str, part_col: str = "dt") -> DataFrame:
    """K9: (dt, files, bytes) of a table's partitions, from the names of the stored files alone."""
    file = F.col("_metadata")
    each = spark.table(name).select(part_col, file["file_path"].alias("path"), file["file_size"].alias("size")).distinct()
    return each.groupBy(part_col).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def compact_partitions(
    spark: SparkSession, name: str, *, part_col: str = "dt", file_bytes: int = 128 << 20, most: int = 1
) -> dict[str, tuple[int, int]]:
    """K9: rewrite partitions of many small files; returns the numbers of files before and after, by date.

    Chosen are partitions with more files than their bytes need, by more than ``most``.  Each is written beside the table, its
    digest is compared, then it takes the place of the old files in one dynamic overwrite: a task
    that fails, or a digest that differs, leaves the partition as it was.  Tables in buckets are left alone, a bucket is a file.
    """
    if bucket_spec(spark, name) is not None:
        return {}
    needed = F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)).cast("int")
    chosen = file_sizes(spark, name, part_col).withColumn("needed", needed).filter(F.col("files") > F.col("needed") + most)
    done, beside = {}, f"{name}__compact"
    for row in chosen.orderBy(part_col).collect():  # a row per partition to be rewritten
        part, files, wanted = row[part_col], row["files"], row["needed"]
        old = spark.table(name).filter(F.col(part_col) == part)
        drop_objects(spark, tables=[beside])
        write_table(old.repartition(wanted), beside).require_complete()
        replace_partitions(spark.table(beside).coalesce(wanted), name, part_col=part_col).require_complete()
        drop_objects(spark, tables=[beside])
        done[part] = (files, file_sizes(spark, name, part_col).filter(F.col(part_col) == part).first()["files"])
    return done


#: Widenings of a type that lose no value, by the names of the types; decimals and structs have rules of their own.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "decimal", "double"),
    "smallint": ("int", "bigint", "decimal", "double"),
    "int": ("bigint", "decimal", "double"),
    "bigint": ("decimal",),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}
#: Digits of a whole number of a type.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widened(old: DataType, new: DataType) -> DataType | None:
    """The type that holds all values of both, if it is one of the two; of structs, field by field, fields of either
    one kept.  None if there is none."""
    old, new = relaxed(old), relaxed(new)
    if old == new:
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        kinds = {f.name: f.dataType for f in old.fields}
        for f in new.fields:
            kinds[f.name] = widened(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
        return None if None in kinds.values() else StructType([StructField(n, k) for n, k in kinds.items()])
    for narrow, wide in ((old, new), (new, old)):
        if _holds(narrow, wide):
            return wide
    return None


def _holds(narrow: DataType, wide: DataType) -> bool:
    if isinstance(wide, DecimalType) and isinstance(narrow, DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    name = narrow.simpleString()
    if isinstance(wide, DecimalType):
        return "decimal" in WIDER.get(name, ()) and wide.precision - wide.scale >= DIGITS[name]
    return wide.simpleString() in WIDER.get(name, ())


def evolve_schema(
    spark: SparkSession, df: DataFrame, name: str, policy: str = "add_columns", backup: str | None = None
) -> DataFrame:
    """Bring a table and the rows to be written to one schema; returns the rows.

    ``add_columns`` adds new columns to the table and fills columns the rows lack
    with NULL, ``widen`` does so too and brings a changed type to the wider one of both (see
    ``widened``), ``recreate`` drops the table (after copying it to ``backup``, if
    given), ``fail`` raises.  Any other changed type is only accepted by ``recreate``.
    """
    if policy not in ("add_columns", "widen", "recreate", "fail"):
        raise ValueError(f"unknown schema policy {policy}")
    if not table_exists(spark, name):
        return df
    stored = spark.table(name).schema
    new, missing, changed = schema_difference(df.schema, stored)
    if not (new or missing or changed):
        return df
    if policy == "recreate":
        if backup is not None:
            writer(spark.table(name), "overwrite").partitionBy(*partition_columns(spark, name)).saveAsTable(backup)
        drop_objects(spark, tables=[name])
        return df
    if policy == "widen" and changed:
        df = _widen(spark, df, name, changed)
        stored, changed = spark.table(name).schema, []
    if policy == "fail" or changed:
        raise ValueError(f"schema of {name} differs: new {new}, missing {missing}, changed {changed}")
    if new:
        added = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in new)
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({added})")
    return df.withColumns({c: F.lit(None).cast(stored[c].dataType) for c in missing})


def _widen(spark: SparkSession, df: DataFrame, name: str, changed: list[str]) -> DataFrame:
    """The rows in the wider types.  Old files keep their own types: if the table's become wider, it is stored anew once, with
    the old values in the new types, and takes the place of the old one when its digest is right."""
    table = spark.table(name)
    kinds = {c: widened(table.schema[c].dataType, df.schema[c].dataType) for c in changed}
    if odd := [c for c, kind in kinds.items() if kind is None]:
        raise ValueError(f"schema of {name} differs: no wider type for {odd}")
    grown = {c: kind for c, kind in kinds.items() if kind != table.schema[c].dataType}
    if grown:
        new, parts = f"{name}__new", partition_columns(spark, name)
        rows = table.withColumns({c: as_type(F.col(c), table.schema[c].dataType, kind) for c, kind in grown.items()})
        drop_objects(spark, tables=[new])
        if parts:
            by = bucket_spec(spark, name)
            replace_partitions(rows, new, part_col=parts[0], bucket_by=by).require_complete()
            replace_partitioned_table(spark, new, name, parts[0], by)
        else:
            write_table(rows, new).require_complete()
            swap(spark, new, name)
    return df.withColumns({c: as_type(F.col(c), df.schema[c].dataType, kind) for c, kind in kinds.items()})


def as_type(column: Column, old: DataType, new: DataType) -> Column:
    """A column in a wider type; fields that a struct lacks are NULL."""
    if old == new:
        return column
    if not isinstance(new, StructType):
        return column.cast(new)
    held = {f.name: f.dataType for f in old.fields}
    fields = [as_type(column[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType) for f in new.fields]
    return F.when(column.isNotNull(), F.struct(*(c.alias(f.name) for c, f in zip(fields, new.fields))))


def schema_difference(rows: StructType, table: StructType) -> tuple[list[str], list[str], list[str]]:
    have, want = ({f.name: f.dataType for f in s.fields} for s in (rows, table))
    new = [c for c in have if c not in want]
    missing = [c for c in want if c not in have]
    changed = [c for c in have if c in want and relaxed(have[c]) != relaxed(want[c])]
    return new, missing, changed
