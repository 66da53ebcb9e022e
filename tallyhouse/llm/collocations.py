"""Phrase collocations from a weighted de Bruijn graph of words.

Only the longest grams are counted in the texts: a gram of `longest` words is an edge between the two nodes that are its
first and its last words, and its weight is the number of its occurrences. A node's own count is the weight that flows out
of it plus its occurrences at the end of a piece, where no edge begins; nodes of one word less follow in the same way,
down to single words. A phrase all of whose count goes on through one edge lies inside a unary path of the graph, which
is compacted into its longer label: the phrase is dropped.

Phrases below the least count are not asked for, and none that is holds a pair of neighbours below it. So pieces are cut
between such rare pairs before grams are made. Pairs are counted exactly by 64-bit hash; the frequent ones set bits of a
sieve of fixed size. Two pairs that share a bit cost work, never a count: a cut piece ends there, and ends are counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.common import memory, mix, stored

LONGEST, LEAST, TOP = 5, 100, 2000
#: Bits of the sieve, as a power of two: 8 MB, whatever the tables.
SIEVE = 26
#: Entries that a task sums before it passes them on.
HELD_PAIRS, HELD_GRAMS = 1 << 21, 200_000
#: Partial ranks of a language before the final one.
SALTS = 32

_U = np.uint64
#: Bytes of a text: A to Z in lower case, ends of pieces as commas, blanks as they are. No word holds a comma.
_PLAIN = bytes(ord(",") if c in b".,;:!?\n\x0b\x0c\r" else ord(" ") if c in b" \t" else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Hashes(dict):
    """Hash of each word, never 0, remembered up to a number of words; 0 for the end of a piece."""

    def __init__(self, remember: int = 150_000):
        super().__init__({b",": 0})
        self.remember = remember

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word) | 1
        if len(self) < self.remember:
            self[word] = found
        return found


def _tokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of some texts with commas at the ends of pieces, their hashes, and the number of tokens by text."""
    known = memory(_Hashes)
    each = [[*t.translate(_PLAIN).replace(b",", b" , ").split(), b","] for t in texts]
    sizes = np.array([len(x) for x in each], np.int64)
    flat = [w for x in each for w in x]
    return flat, np.fromiter(map(known.__getitem__, flat), _U, len(flat)), sizes


def _pairs(hashes: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hash of each token with the next one, by language."""
    with np.errstate(over="ignore"):
        return mix(mix(hashes[:-1] + salt[:-1]) * _U(3) + hashes[1:])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Languages, tokens, their hashes, number of the text and hash of the language by token; some hundred texts at a time."""
    for batch in batches:
        at, sizes = 0, pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        while at < batch.num_rows:
            number, size = 0, 0
            while at + number < batch.num_rows and number < 256 and size < 1 << 20:
                size += sizes[at + number]
                number += 1
            part = batch.slice(at, number)
            at += number
            langs = part.column(0).to_pylist()
            flat, hashes, counts = _tokens([t or b"" for t in part.column(1).to_pylist()])
            salts = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in langs], _U)
            yield langs, flat, hashes, np.repeat(np.arange(len(langs)), counts), np.repeat(salts, counts)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))


def sieve(texts: DataFrame, least: int, bits: int = SIEVE) -> np.ndarray:
    """Bytes with a bit for each pair of neighbours that occurs `least` times in its language, and for few others.

    What reaches the driver is the sieve itself, at most 2 ** (bits - 6) numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        number = 0

        def summed() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(n)], names=["pair", "n"])

        for _, _, hashes, _, salt in _slices(batches):
            held.append(_pairs(hashes, salt)[(hashes[:-1] != 0) & (hashes[1:] != 0)])
            number += len(held[-1])
            if number >= HELD_PAIRS:
                yield summed()
                held, number = [], 0
        if held:
            yield summed()

    pairs = texts.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bit = F.shiftrightunsigned("pair", 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    cells = pairs.groupBy(F.shiftright(bit, 6).cast("int").alias("cell")).agg(F.bit_or(one).alias("of"))
    out = np.zeros(max(1, 1 << bits >> 6), np.int64)
    table = cells.toArrow()
    out[table.column("cell").to_numpy()] = table.column("of").to_numpy()
    return out.view(np.uint8)


def grams(texts: DataFrame, passed: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """lang, gram, size, n: the edges (size `longest`), and for each end of a piece or cut the words before it, at most
    longest - 1 of them."""
    shared = texts.sparkSession.sparkContext.broadcast(passed)
    shift = _U(64 - (len(passed) * 8 - 1).bit_length())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, Counter()

        def summed() -> pa.RecordBatch:
            langs, spelled, sizes = zip(*seen, strict=True)
            cols = [pa.array(langs, pa.string()), pa.array(spelled, pa.binary()), pa.array(sizes, pa.int32()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["lang", "gram", "size", "n"])

        for langs, flat, hashes, text, salt in _slices(batches):
            bit = _pairs(hashes, salt) >> shift
            on = (bits[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1
            on = np.append(on.astype(bool) & (hashes[:-1] != 0) & (hashes[1:] != 0), False)  # goes on to the next token
            word = np.flatnonzero(hashes != 0)
            before = np.append(False, on[:-1])
            first = np.maximum.accumulate(np.where(before, 0, np.arange(len(flat))))  # where the token's stretch begins
            edges = word[word - first[word] >= longest - 1] - (longest - 1)
            ends = word[~on[word]]
            begins = np.maximum(first[ends], ends - longest + 2)
            of = [langs[k] for k in text[edges].tolist()]
            seen.update(zip(of, (b" ".join(flat[i : i + longest]) for i in edges.tolist()), [longest] * len(of), strict=True))
            of = [langs[k] for k in text[ends].tolist()]
            spelled = (flat[b] if a == b else b" ".join(flat[a : b + 1]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True))
            seen.update(zip(of, spelled, (ends - begins + 1).tolist(), strict=True))
            if len(seen) >= HELD_GRAMS:
                yield summed()
                seen.clear()
        if seen:
            yield summed()

    rows = texts.mapInArrow(make, "lang string, gram binary, size int, n long")
    return rows.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n")).select("lang", F.col("gram").cast("string").alias("gram"), "size", "n")


def _some(phrase: str, number: Column | int) -> Column:
    """The first words of a phrase, or with a negative number the last ones."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), number if isinstance(number, Column) else F.lit(number))


def flows(counted: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """The phrases (lang, phrase, size, f) that occur `least` times, and lang, n of all words, from edges and ends.

    The count of a phrase of some size is the sum of the counts of the phrases of one word more that begin with it, and of the
    ends whose last words it is.
    """
    counted = stored(counted)
    level = counted.where(F.col("size") == longest).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("f"))
    kept = level.where(F.col("f") >= least).withColumn("size", F.lit(longest))
    for size in range(longest - 1, 0, -1):
        on = level.select("lang", _some("phrase", size).alias("phrase"), "f")
        ends = counted.where((F.col("size") >= size) & (F.col("size") < longest)).select("lang", _some("gram", -size).alias("phrase"), F.col("n").alias("f"))
        level = stored(on.union(ends).groupBy("lang", "phrase").agg(F.sum("f").alias("f")))
        kept = kept.unionByName(level.where(F.col("f") >= least).withColumn("size", F.lit(size)))
    return stored(kept.select("lang", "phrase", "size", "f")), stored(level.groupBy("lang").agg(F.sum("f").alias("n")))


def compacted(phrases: DataFrame) -> DataFrame:
    """The phrases of two words or more of which no longer one has the same count.

    One word more is enough to look at: a phrase between the two has the same count. Of phrases that pass wholly into a
    longer one only the longest is left, dropped ones in between included.
    """
    shorter = F.array(_some("phrase", F.col("size") - 1), _some("phrase", 1 - F.col("size")))
    longer = phrases.where("size > 2").select("lang", "f", F.explode(shorter).alias("phrase"))
    return phrases.where("size > 1").join(longer.distinct(), ["lang", "phrase", "f"], "left_anti").select("lang", "phrase", "size", "f")


def scored(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the cut with the lowest score, the earliest one of several; whole numbers of up
    to 38 digits throughout."""
    part = lambda name: phrases.select("lang", F.col("phrase").alias(f"{name}_part"), F.col("f").alias(name))
    cuts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("l_part", _some("phrase", F.col("k"))).withColumn("r_part", _some("phrase", F.col("k") - F.col("size")))
    cuts = cuts.join(part("l"), ["lang", "l_part"]).join(part("r"), ["lang", "r_part"]).join(totals, "lang")
    exact = F.expr("(1000BD * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    best = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, bits: int = SIEVE, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language.

    Null texts are empty, a null language is `und`. Repeated rows and ids count each, other columns are not read, texts
    are taken whole. Equal scores are ordered by count, then by the phrase's bytes. An empty table has no row.
    """
    texts = _texts(docs, text_col, lang_col)
    phrases, totals = flows(grams(texts, sieve(texts, least, bits), longest), least, longest)
    found = scored(compacted(phrases), phrases, totals)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
