"""Helpers shared by the corpus operators: table reads, the shared folder, words and 64-bit hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: blank, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Ids that are broadcast at most; in memory they take some 50 bytes each.
MOST_BROADCAST = 1_000_000

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder's URI below spark.checkpoint.dir; only where that is unset and Spark is local, below a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base:
        base = f"file://{base}"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings, and with its own ones again afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here and lost executors lose nothing. Shuffle
    files of the job go with it."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ids_of(rows: DataFrame) -> DataFrame:
    """Stored rows of one long each. Up to MOST_BROADCAST of them, counted, go to every executor, so that what they are
    joined with stays where it is; beyond that Spark chooses the join."""
    ids = stored(rows)
    return F.broadcast(ids) if ids.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else ids


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null and for texts without a word."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once a row, however often body names it."""
    return F.transform(F.array(value), body)[0]


def windows(of: Column, n: int) -> Column:
    """The 64-bit hash of each run of n elements of an array, in order; empty for shorter arrays."""
    return F.when(F.size(of) >= n, F.transform(F.sequence(F.lit(1), F.size(of) - (n - 1)), lambda i: F.xxhash64(F.slice(of, i, n)))).otherwise(F.array().cast("array<bigint>"))


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def sliced(batches: Iterator, rows: int = 512) -> Iterator:
    """The rows of Arrow batches, so many at a time: a task never holds the Python objects of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def strings(column) -> list[str]:
    """Python strings of an Arrow column, nulls as empty ones."""
    return ["" if x is None else x for x in column.to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of words."""

    def __init__(self, remember: int = 120_000):
        super().__init__()
        self.remember = remember

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < self.remember:
            self[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words of a text, in order."""
        parts = text.split() if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") else WORD.findall(text)
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


@lru_cache(maxsize=1)
def memory(make: Callable, *args):
    """What make(*args) builds, for all tasks of a worker until one asks for another: a worker that serves several
    operators in turn never holds the words of two."""
    return make(*args)


def word_hashes() -> WordHashes:
    return memory(WordHashes)


def runs(h: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash of each run of n word hashes; one of all words for a shorter, non-empty text."""
    if len(h) < n:
        n = len(h)
    if not n:
        return h
    out = np.zeros(len(h) - n + 1, _U)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mix(out + h[k : len(h) - n + 1 + k] + _U(0x9E3779B97F4A7C15))
    return out


def rooted(labels: DataFrame) -> DataFrame:
    """node, root of pointers that always lead to a lesser node, each followed to its end by jumps of doubling length."""
    labels = stored(labels)
    while True:
        far = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = stored(labels.join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        labels = after.select("node", "root")
        if after.where("moved").isEmpty():
            return labels


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node that edges lead to) of every node of edges a, b (longs).

    Each node points at its least neighbour, pointers are followed to their ends, and edges then lead between these
    ends only; again, until no edge is left. Edges that fall together become one, so each round moves far fewer than the
    one before. Each round is stored, nothing but whether rows are left reaches the driver.
    """
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    levels = []
    while not left.isEmpty():
        labels = rooted(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")))
        levels.append(labels)
        low, high = (labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("lo", "hi"))
        ends = left.join(high, "hi").join(low, "lo", "left").select(F.coalesce("lo_root", "lo").alias("a"), F.col("hi_root").alias("b"))
        left = stored(ends.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    if not levels:
        return left.select(F.col("lo").alias("node"), F.col("hi").alias("root"))
    found = levels.pop()  # a node points somewhere in one level only
    while levels:
        far = found.select(F.col("node").alias("root"), F.col("root").alias("far"))
        found = stored(levels.pop().join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root")).union(found))
    return found.union(found.select(F.col("root").alias("node"), "root").distinct())
