"""Reading operational databases over JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcOptions:
    """Where to read from.  Credentials come in through ``properties`` and are not printed."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    fetch_size: int = 10000

    def reader(self, spark: SparkSession):
        return (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("fetchsize", self.fetch_size)
            .options(**self.properties)
        )


def read_table(spark: SparkSession, opts: JdbcOptions, table: str) -> DataFrame:
    """S1.  Filters and column choices made on the result are sent to the database."""
    return opts.reader(spark).option("dbtable", table).load()


def read_columns(spark: SparkSession, opts: JdbcOptions, table: str, columns: Iterable[str]) -> DataFrame:
    """Only these columns leave the database."""
    return read_table(spark, opts, table).select(*columns)


def read_since(
    spark: SparkSession, opts: JdbcOptions, table: str, inc_col: str, hwm: object | None
) -> DataFrame:
    """S3: rows changed after the mark, filtered in the database."""
    rows = read_table(spark, opts, table)
    return rows if hwm is None else rows.filter(F.col(inc_col) > F.lit(hwm))


def read_partitioned(
    spark: SparkSession, opts: JdbcOptions, table: str, key: str, n: int = 4
) -> DataFrame:
    """``n`` parallel reads over ranges of a number, date or timestamp column.

    The bounds come from one MIN/MAX query in the database.  They only place the
    ranges: rows outside them, and NULL keys, are read as well.
    """
    low, high = read_table(spark, opts, table).agg(F.min(key), F.max(key)).first()
    if low is None or low == high:
        return read_table(spark, opts, table)
    return (
        opts.reader(spark)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", n)
        .load()
    )


#: Cells that a range is cut into at a time, as a power of two, and the share of a range that a cell may hold.
CUT, FINE = 4, 8


def literal(value: object) -> str:
    """A value as standard SQL text."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    text = str(value).replace("'", "''")
    return f"'{text}'"


def even_ranges(spark: SparkSession, opts: JdbcOptions, table: str, key: str, n: int, where: str | None = None) -> list[str]:
    """Conditions that cut the wanted rows into about ``n`` even parts by a whole-number key.

    The database counts the rows of cells of the key; heavy cells are cut again until each holds a small share of a part,
    or one key. Cells in a row then make the parts. Every key, those outside the counted range and NULL included, meets exactly
    one condition. Each round is one query that returns a number of cells in proportion to ``n``.
    """
    source = f"{table} WHERE {where}" if where else table
    ask = lambda text: opts.reader(spark).option("dbtable", f"({text}) q").load()
    first = ask(f"SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT({key}) AS keyed FROM {source}").first()
    low, high, number = (first[i] for i in range(3))
    if low is None or low == high:
        return [where] if where else ["1 = 1"]
    low, high, number = int(low), int(high), int(number)
    most = max(1, number // (n * FINE))
    power = max(0, (high - low + 1).bit_length() - n.bit_length() - CUT)
    heavy: list[tuple[int, int]] = [(low, high)]
    cells: list[tuple[int, int]] = []  # first key and rows
    while heavy:
        some = " OR ".join(f"{key} BETWEEN {a} AND {b}" for a, b in heavy)
        cell = f"FLOOR(({key} - {low}) / {1 << power})"
        found = ask(f"SELECT {cell} AS cell, COUNT(*) AS held FROM {table} WHERE ({some}){f' AND ({where})' if where else ''} GROUP BY {cell}").collect()
        heavy = []
        for at, held in sorted((int(r[0]), int(r[1])) for r in found):
            begin = low + (at << power)
            if held > most and power:
                heavy.append((begin, begin + (1 << power) - 1))
            else:
                cells.append((begin, held))
        power = max(0, power - CUT)
    bounds, before = [], 0
    for begin, held in sorted(cells):
        if before * n >= (len(bounds) + 1) * number:
            bounds.append(begin)
        before += held
    edges = [None, *bounds, None]
    parts = []
    for a, b in zip(edges, edges[1:]):
        inner = " AND ".join([*([f"{key} >= {a}"] if a is not None else []), *([f"{key} < {b}"] if b is not None else [])]) or "1 = 1"
        condition = f"({inner} OR {key} IS NULL)" if a is None else inner
        parts.append(f"{condition} AND ({where})" if where else condition)
    return parts


def read_even(spark: SparkSession, opts: JdbcOptions, table: str, key: str, n: int = 4, where: str | None = None) -> DataFrame:
    """S4 over the wanted rows: about ``n`` parallel reads of the same number of rows, however the keys lie."""
    parts = even_ranges(spark, opts, table, key, n, where)
    properties = {**opts.properties, "fetchsize": str(opts.fetch_size)}
    return spark.read.jdbc(opts.url, table, predicates=parts, properties=properties)


def sample_scan(spark: SparkSession, opts: JdbcOptions, table: str, n: int = 1000) -> DataFrame:
    """The first ``n`` rows the database returns.  Only ever on request."""
    return read_table(spark, opts, table).limit(n)


def existing_tables(spark: SparkSession, opts: JdbcOptions, schema: str | None = None) -> set[str]:
    """Lower-case names of the tables the database lists, of one schema if given."""
    listed = read_table(spark, opts, "information_schema.tables")
    if schema is not None:
        listed = listed.filter(F.col("table_schema") == schema)
    return {row[0].lower() for row in listed.select("table_name").collect()}


def select_existing(wanted: Iterable[str], existing: set[str]) -> tuple[list[str], list[str]]:
    """The wanted names that exist, in any case, and those that do not."""
    wanted = list(wanted)
    found = [name for name in wanted if name.lower() in existing]
    return found, [name for name in wanted if name not in found]
