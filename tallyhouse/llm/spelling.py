"""Spelling variants: words one edit from a far more frequent word, by dense prefix-suffix tiling.

Two words are one inserted, deleted or replaced character apart exactly if their common prefix and common suffix reach
together the length of the longer one less one. One of the two then reaches half of that, so words meet under the first
half or under the last half of the longer word. The words of such a key are cut into blocks; each pair of blocks is a
tile, compared at once as two padded matrices of code points. A pair that meets under both halves counts under the first.
Tiles return a number of near words and the best one for each word, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import rooted, stored

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One of so many occurrences loses a character.
ONE_IN = 199
#: Words of a block, rows of a task, and elements of a comparison at a time.
BLOCK, TASK, ELEMENTS = 256, 8192, 1 << 22


def counted(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = ONE_IN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of whole texts with their occurrences, after one in `one_in` (by the hash of id and word) lost a
    character. Null texts have none; a null id is spelled as an empty one. Occurrences are summed before they are shuffled."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(own.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= least_length)
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _keys() -> Column:
    """The keys of a word, as the longer (or equally long) word of a pair and as the shorter one."""
    def key(side: str, longer: int) -> Column:
        length = F.length("word") + longer
        half = F.floor(length / 2).cast("int")  # at least half of the length less one
        part = F.substring("word", 1, half) if side == "p" else F.right("word", half)
        return F.struct(F.lit(side).alias("side"), length.alias("length"), part.alias("part"))

    return F.array(*(key(side, longer) for side in "ps" for longer in (0, 1)))


def _tile(words: list[str], lengths: np.ndarray, one: np.ndarray, two: np.ndarray, longer: int, side: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, one of `one` and one of `two`, that are one edit apart; the first is of the longer length."""
    one = one[lengths[one] == longer]
    if not len(one) or not len(two):
        return
    width = longer

    def matrix(rows: np.ndarray, step: int) -> np.ndarray:
        wide = np.array([words[i][::step] for i in rows], f"<U{width}").view("<u4").reshape(len(rows), width)
        return wide.astype(np.uint8) if wide.max() < 256 else wide

    heads, tails = (matrix(one, step) for step in (1, -1))
    near_heads, near_tails = (matrix(two, step) for step in (1, -1))
    if heads.dtype != near_heads.dtype:
        heads, tails, near_heads, near_tails = (m.astype(np.uint32) for m in (heads, tails, near_heads, near_tails))
    step = max(1, ELEMENTS // width)
    for b in range(0, len(two), step):
        cols = slice(b, b + step)
        many = max(1, step // len(two[cols]))
        for a in range(0, len(one), many):
            rows = slice(a, a + many)
            head = heads[rows, None, :] != near_heads[None, cols, :]
            prefix = head.argmax(axis=2)
            some = prefix < longer // 2 if side == "s" else prefix >= longer // 2
            i, j = np.nonzero(some & (one[rows, None] != two[None, cols]))
            suffix = (tails[rows][i] != near_tails[cols][j]).argmax(axis=1)
            fit = prefix[i, j] + suffix >= longer - 1
            yield one[rows][i[fit]], two[cols][j[fit]]


def _compared(table: pa.Table) -> pa.Table:
    """word, n_near, best_n, best of the tiles of a task; a word comes once a tile in which it has near words."""
    words, counts = table.column("word").to_pylist(), np.array(table.column("n").to_pylist(), np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    groups: dict[tuple, tuple[list[int], list[int]]] = {}
    names = ("side", "length", "part", "i", "j", "block")
    for row, (side, length, part, i, j, block) in enumerate(zip(*(table.column(c).to_pylist() for c in names), strict=True)):
        groups.setdefault((side, length, part, i, j), ([], []))[block != i].append(row)
    out: list[tuple[str, int, int, str]] = []
    for (side, longer, _, i, j), (one, two) in groups.items():
        first, second = np.array(one, np.int64), np.array(two, np.int64)
        met = [(first, first)] if i == j else [(first, second), (second, first)]
        own = {}
        for x, y in met:
            for a, b in _tile(words, lengths, x, y, longer, side):
                both = lengths[a] == lengths[b]  # such a pair comes from either side
                for row, other in [*zip(a.tolist(), b.tolist(), strict=True), *zip(b[~both].tolist(), a[~both].tolist(), strict=True)]:
                    seen = own.get(row)
                    if seen is None:
                        own[row] = [1, other]
                    else:
                        seen[0] += 1
                        if (-counts[other], words[other]) < (-counts[seen[1]], words[seen[1]]):
                            seen[1] = other
        out += [(words[r], k, int(counts[b]), words[b]) for r, (k, b) in own.items()]
    cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table({c: pa.array(v, t) for c, v, t in zip(("word", "n_near", "best_n", "best"), cols, kinds, strict=True)})


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n, best (the near word of largest n, the first in code-point order of several) of words (word, n;
    each word once) that have near ones. A frequent key is cut into blocks, whose pairs are dealt out to tasks of their own."""
    keyed = words.select("word", "n", F.explode(_keys()).alias("key")).select("word", "n", "key.*")
    names = ["side", "length", "part"]
    sizes = keyed.groupBy(*names).agg(F.count("*").alias("size"), F.max(F.length("word") == F.col("length")).alias("some")).where("size > 1 and some")
    cut = F.ceil(F.col("size") / block).cast("int")
    placed = keyed.join(sizes.select(*names, "size"), names)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("word"), cut).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), cut - 1)))
    placed = stored(placed.select(*names, "word", "n", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), (cut > 1).alias("cut")))
    tasks = max(1, placed.count() // TASK)
    task = F.when(F.col("cut"), F.xxhash64(*names, "i", "j")).otherwise(F.pmod(F.xxhash64(*names), F.lit(tasks)))
    found = placed.withColumn("task", task).drop("cut").groupBy("task").applyInArrow(_compared, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    sums = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return sums.select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best"))


def variants(words: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of words (word, n; each word once).

    A word's form is its near word of largest n, if that is at least `times` its own; root is where forms lead to, the
    word itself without a form. An empty table has no row.
    """
    words = stored(words)
    near = stored(words.join(near_words(words, block), "word", "left"))
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))
    formed = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n"))
    roots = rooted(formed.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("root")))
    led = formed.join(roots.withColumnRenamed("node", "word"), "word", "left")
    return led.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """variants() of the words of documents."""
    return variants(counted(docs, least_length, least_count, one_in))
