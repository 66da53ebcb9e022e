"""Copying source tables into the lake."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.snapshots import high_water_mark, stamp
from tallyhouse.plans import ledger
from tallyhouse.sinks import tables as sink
from tallyhouse.sinks.buckets import upsert_table
from tallyhouse.sinks.held import Held, replace_and_describe
from tallyhouse.sources.jdbc import JdbcOptions, literal, read_even, read_partitioned, read_table, select_existing
from tallyhouse.sources.tables import SOURCE_TABLES

MODES = ("incremental", "full")
KEPT = ("keep_history", "latest_only", "upsert")
# Those that lose nothing
SCHEMA_CHANGES = ("fail", "add_columns", "widen")


@dataclass(frozen=True)
class TableSpec:
    """One table to copy; the defaults are those of a spec that names only the tables.

    Strategy ``upsert`` keeps one row per ``keys``, stored in that many ``buckets`` of the key.
    ``held`` names the date and key columns by which the partitions of a fact are described, ``bucket_by`` the column and
    number of the buckets its partitions are stored in.  ``schema_change`` says what a source does to its target when its
    columns have changed (K22); ``max_records`` a file and ``block_bytes`` a row group size the files of a new table (K9).
    """

    source: str
    target: str
    inc_col: str = "update_time"
    part_col: str | None = "dt"
    mode: str = "incremental"
    strategy: str = "keep_history"
    keep_days: int | None = None
    lookback_days: int = 0
    enabled: bool = True
    path: str | None = None
    keys: tuple[str, ...] = ()
    buckets: int = 64
    held: Held | None = None
    bucket_by: tuple[str, int] | None = None
    schema_change: str = "fail"
    max_records: int | None = None
    block_bytes: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown sync mode {self.mode} for {self.source}")
        if self.strategy not in KEPT:
            raise ValueError(f"unknown strategy {self.strategy} for {self.source}")
        if self.strategy == "upsert" and not self.keys:
            raise ValueError(f"strategy upsert of {self.source} needs keys")
        if self.schema_change not in SCHEMA_CHANGES:
            raise ValueError(f"unknown schema change {self.schema_change} for {self.source}")
        if self.strategy == "upsert" and self.schema_change != "fail":
            raise ValueError(f"strategy upsert of {self.source} keeps the columns of its table")

    @classmethod
    def of(cls, options: Mapping[str, object]) -> TableSpec:
        """A spec from plain options, such as a configuration file holds; unknown names are errors."""
        keys = options.get("keys", ())
        return cls(**{**options, "keys": (keys,) if isinstance(keys, str) else tuple(keys)})


# Opens the source of a spec; the rows wanted are filtered on the result, so that a
# database does the filtering.
Reader = Callable[[SparkSession, TableSpec], DataFrame]


@dataclass(frozen=True)
class JdbcReader:
    """Reads a spec's source over JDBC.

    With ``parallel`` a known table is read in that many ranges of its key, an interval of it in as many even parts.  All
    columns are copied; with ``known_columns`` those of a known table that ``SOURCE_TABLES`` lists.
    """

    opts: JdbcOptions
    parallel: int = 1
    known_columns: bool = False

    def __call__(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        known = SOURCE_TABLES.get(spec.source.split(".")[-1].lower())
        if known is None:
            return read_table(spark, self.opts, spec.source)
        if self.parallel > 1:
            rows = read_partitioned(spark, self.opts, spec.source, known["key"], self.parallel)
        else:
            rows = read_table(spark, self.opts, spec.source)
        return rows.select(*known["columns"]) if self.known_columns else rows

    def within(self, spark: SparkSession, spec: TableSpec, source: DataFrame, of: ledger.Entry) -> DataFrame | None:
        """The rows of an interval in even parts; None if the table's key is not known."""
        known = SOURCE_TABLES.get(spec.source.split(".")[-1].lower())
        if known is None or self.parallel < 2:
            return None
        low, high = ledger.bounds(source, spec.inc_col, of, spec.lookback_days)
        asked = [f"{spec.inc_col} > {literal(low)}"] if low is not None else []
        if high is not None:
            upto = f"{spec.inc_col} <= {literal(high)}"
            asked.append(upto if low is not None else f"({upto} OR {spec.inc_col} IS NULL)")
        rows = read_even(spark, self.opts, spec.source, known["key"], self.parallel, " AND ".join(asked) or None)
        return rows.select(*known["columns"]) if self.known_columns else rows


def jdbc_reader(opts: JdbcOptions, parallel: int = 1, known_columns: bool = False) -> Reader:
    return JdbcReader(opts, parallel, known_columns)


def default_specs(database: str = "ods") -> list[TableSpec]:
    """The tables of the business, each copied as full snapshots or as its newest state."""

    def snapshots(name: str, keep_days: int | None = None) -> TableSpec:
        changed = SOURCE_TABLES[name.lower()]["changed"]
        return TableSpec(name, f"{database}.{name}", changed, mode="full", keep_days=keep_days)

    def newest(name: str) -> TableSpec:
        return replace(snapshots(name), strategy="latest_only")

    # ---- Fixed values: days of history kept, all without a number
    return [
        replace(snapshots("Orders"), held=Held("OrderDate", "OrderID")),
        snapshots("OrderDetails"),
        snapshots("InventoryTransactions"),
        snapshots("Customers", 90),
        snapshots("Products", 180),
        newest("Warehouses"),
        snapshots("Employees", 365),
        newest("Factories"),
        newest("Inventory"),
    ]


def mark_before(spark: SparkSession, spec: TableSpec, as_of: str) -> object | None:
    """The newest change a target without entries in the ledger holds from earlier runs, None for a full read.

    Rows of a run on the same date are left out: they are about to be replaced, and a
    repeated run must read them again.
    """
    if spec.mode != "incremental" or not sink.table_exists(spark, spec.target):
        return None
    held = spark.table(spec.target)
    if spec.part_col and spec.strategy != "upsert":
        held = held.filter(F.col(spec.part_col) < as_of)
    return high_water_mark(held, spec.inc_col).first()["hwm"]


def fitted(spark: SparkSession, spec: TableSpec, rows: DataFrame) -> DataFrame:
    """The rows in the columns of their target, which first takes new columns and wider types if the spec allows it."""
    return rows if spec.schema_change == "fail" else sink.evolve_schema(spark, rows, spec.target, spec.schema_change)


def sync_table(spark: SparkSession, spec: TableSpec, as_of: str, read: Reader) -> sink.WriteResult:
    """Copy one table for one date; a repeated run gives the same table.

    =============  ============  ==========================================
    mode           strategy      effect
    =============  ============  ==========================================
    incremental    (any)         rows of the date's interval become partition ``as_of``
    full           keep_history  all rows become partition ``as_of``
    full           latest_only   all rows replace the table
    (any)          upsert        rows newer than the table's replace them by key
    =============  ============  ==========================================

    Without a partition column an increment is appended and a full copy replaces.  The interval of
    a date is fixed and stored before its rows are read, so a source that goes on changing gives a
    repeated run, or a task that runs again, the same rows; rows are read once.  A source without rows
    changes no rows.
    """
    for database in sink.databases_of([spec.target]):
        sink.ensure_database(spark, database)
    exists, source = sink.table_exists(spark, spec.target), read(spark, spec)
    if spec.mode == "incremental":
        begun = ledger.interval(spark, spec.target, as_of, source, spec.inc_col, mark_before(spark, spec, as_of))
        ranged = read.within(spark, spec, source, begun) if isinstance(read, JdbcReader) else None
        rows = ledger.within(source, spec.inc_col, begun, spec.lookback_days) if ranged is None else ranged
    else:
        begun, rows = ledger.record(spark, ledger.Entry(spec.target, as_of)), source
    if spec.part_col:
        rows = stamp(rows, as_of, spec.part_col)
    files = {"path": spec.path, "max_records": spec.max_records, "block_bytes": spec.block_bytes}
    if spec.strategy == "upsert":
        done = upsert_table(rows, spec.target, spec.keys, spec.inc_col, buckets=spec.buckets, path=spec.path)
    elif spec.part_col and (spec.mode == "incremental" or spec.strategy == "keep_history"):
        if spec.held is not None:
            done = replace_and_describe(fitted(spark, spec, rows), spec.target, spec.held, part_col=spec.part_col, bucket_by=spec.bucket_by, **files)
        else:
            done = sink.replace_partitions(fitted(spark, spec, rows), spec.target, part_col=spec.part_col, bucket_by=spec.bucket_by, **files)
    elif spec.mode == "incremental":
        done = sink.write_table(fitted(spark, spec, rows), spec.target, mode="append", **files)
    else:
        done = sink.write_table(rows, spec.target, keep_if_empty=True, **files)
    if not done.rows:
        if not exists:
            sink.drop_objects(spark, tables=[spec.target])
        done = sink.WriteResult(spec.target, 0)
    elif spec.mode == "full" and spec.strategy == "keep_history" and spec.part_col and spec.keep_days:
        sink.drop_old_partitions(
            spark, spec.target, part_col=spec.part_col, keep_days=spec.keep_days, as_of=as_of
        )
    if done.complete:
        digest = None if done.digests is None else str(done.digests[0])
        ledger.record(spark, replace(begun, rows=done.rows, digest=digest, state=ledger.COMPLETE))
    return done


def sync_all(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    as_of: str,
    read: Reader,
    summary_path: str | None = None,
    *,
    existing: set[str] | None = None,
    at_once: int = 3,
    resume: bool = False,
) -> DataFrame:
    """Copy every enabled table, some at once; one failing table does not stop the others.

    Returns (table_name, record_count, status, processed_date) in the order of the specs
    and saves it as Parquet if a path is given.  ``existing`` are the lower-case names of
    the tables the source has (S8): others are skipped and reported as missing.  With ``resume`` a
    table whose copy of the date is complete in the ledger is not copied again but reported from there,
    so that a run that was stopped goes on where it ended.
    """
    specs = [spec for spec in specs if spec.enabled]

    def copy(spec: TableSpec) -> tuple[str, int, str]:
        if existing is not None and not select_existing([spec.source.split(".")[-1]], existing)[0]:
            return spec.target, 0, f"SKIPPED: no source table {spec.source}"
        try:
            known = ledger.entry(spark, spec.target, as_of) if resume else None
            if known is not None and known.state == ledger.COMPLETE:
                return spec.target, known.rows, "SUCCESS"
            result = sync_table(spark, spec, as_of, read)
            return spec.target, result.rows, "SUCCESS" if result.complete else "INCOMPLETE"
        except Exception as problem:  # reported in the summary, by table
            return spec.target, 0, f"FAILED: {problem!r}"

    with ThreadPoolExecutor(max_workers=at_once) as workers:
        done = list(workers.map(copy, specs))
    rows = spark.createDataFrame(done, "table_name string, record_count bigint, status string")
    summary = rows.withColumn("processed_date", F.lit(as_of).cast("timestamp"))
    if summary_path is not None:
        sink.write_files(summary, summary_path)
    return summary
