"""Which keys may be among many others: bits of their hashes, sent to every task, so that rows without a match stay where they lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a sieve, at most: 32 MB.
MOST_BITS = 1 << 28
#: Bits for each key that it is made for.
BITS_A_KEY = 8
#: A row of a sieve holds so many words of 64 bits.
WORDS = 1 << 9


def bits_for(keys: int) -> int:
    """A power of two, so many bits that a key that is not there passes in about one of nine cases; more with more than
    ``MOST_BITS`` bits wanted."""
    return min(MOST_BITS, max(64 * WORDS, 1 << (BITS_A_KEY * max(keys, 1) - 1).bit_length()))


def _bit(names: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*names).bitwiseAND(F.lit(bits - 1).cast("long"))


def _low(at: Column, values: int) -> Column:
    return at.bitwiseAND(F.lit(values - 1).cast("long")).cast("int")


def sieve_of(keys: DataFrame, bits: int) -> DataFrame:
    """A row per ``64 * WORDS`` bits, whatever the keys: its number and its words."""
    at = _bit(keys.columns, bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), _low(at, 64))
    held = keys.select(F.shiftright(at, 6).alias("word"), one.alias("bits"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = held.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    number = F.shiftright("word", WORDS.bit_length() - 1).alias("__part")
    parts = words.groupBy(number).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    return parts.select("__part", F.col("words.bits").alias("__words"))


def sifted(rows: DataFrame, sieve: DataFrame, names: Sequence[str], bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is surely not in a sieve, and those whose key may be."""
    at = _bit(names, bits)
    with_words = rows.withColumn("__part", F.shiftright(at, 5 + WORDS.bit_length())).join(F.broadcast(sieve), "__part")
    word = F.col("__words")[_low(F.shiftright(at, 6), WORDS)]
    maybe = _low(F.call_function("shiftright", word, _low(at, 64)), 2) == 1
    return with_words.filter(~maybe).select(*rows.columns), with_words.filter(maybe).select(*rows.columns)
