"""Texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8, by banded MinHash LSH.

Texts with the same words are one node. Each node has `trees` labels of MinHash values, as long as a pair at the threshold
still matches in some label with the target probability; this length is worked out once and is the same for all texts, so
labels are single hashes and no forest of tries is kept. Texts that share a label, directly or by way of others, are a
candidate group; only groups of two or more go on. A group is cut into blocks, and each pair of blocks is verified by
exact set intersections in a task of its own, so that no group, however large, meets in one task and no pair becomes a
row: a task returns a node's number of links and a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import SIMILARITY, components, mix, runs, sliced, stored, strings, word_hashes

TREES, LONGEST, TARGET, BLOCK = 24, 8, 0.9999, 128
_U, _U32 = np.uint64, np.uint32


def prefix_length(trees: int = TREES, longest: int = LONGEST, target: float = TARGET, similarity: float = SIMILARITY) -> int:
    """The longest prefix at which a pair of that similarity matches in some tree with the target probability."""
    for n in range(longest, 1, -1):
        if 1 - (1 - similarity**n) ** trees >= target:
            return n
    return 1


def signatures(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values of each stretch of shingles; stretches must not be empty."""
    rng = np.random.Generator(np.random.PCG64(20))
    low = mix(shingles).astype(_U32)
    out = np.empty((len(starts), n), _U32)
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(rng.integers(0, 1 << 31, n), rng.integers(0, 1 << 32, n), strict=True)):
            v = (low ^ _U32(b)) * _U32(2 * a + 1)
            out[:, k] = np.minimum.reduceat(v ^ (v >> _U32(15)), starts)
    return out


def node_of(words: np.ndarray) -> int | None:
    """A hash of the words of a text in order, None without words."""
    if not len(words):
        return None
    with np.errstate(over="ignore"):
        return int(mix(mix(words * np.arange(1, 2 * len(words), 2, dtype=_U)).sum(dtype=_U) + _U(len(words)) * _U(0x9E3779B97F4A7C15)).astype(np.int64))


def nodes(docs: DataFrame, trees: int = TREES, longest: int = LONGEST, target: float = TARGET, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node (hash of the words in order; null without words), keys (of the prefix in each tree) per document."""
    depth = prefix_length(trees, longest, target, similarity)
    kinds = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for part in sliced(batches):
            of = [known.of(t) for t in strings(part.column(1))]
            sets = [runs(h) for h in of]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = [[]] * len(sets)
            if full:
                sizes = np.array([len(sets[i]) for i in full])
                sig = signatures(np.concatenate([sets[i] for i in full]), np.cumsum(sizes) - sizes, trees * depth)
                value = np.broadcast_to(np.arange(trees, dtype=_U), (len(full), trees))
                with np.errstate(over="ignore"):
                    for k in range(depth):
                        value = mix(value * _U(0x100000001B3) + sig[:, k::depth].astype(_U) + _U(1))
                for i, row in zip(full, value.astype(np.int64), strict=True):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(node_of, of), pa.int64()), pa.array(keys, pa.list_(pa.int64()))], schema=kinds)

    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, node long, keys array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """node and its sorted distinct shingles as 64-bit numbers in bytes, a row per row."""
    kinds = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for part in sliced(batches):
            of = [known.of(t) for t in strings(part.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, of), pa.int64()), pa.array([np.unique(runs(h)).tobytes() for h in of], pa.binary())], schema=kinds)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(each, "node long, shingles binary")


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set in a with each in b."""
    if len(a) * len(b) <= 64:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b] for x in a]).reshape(len(a), len(b))
    sizes = [len(x) for x in a + b]
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, col, often = np.unique(np.concatenate(a + b), return_inverse=True, return_counts=True)
    keep = np.flatnonzero(often[col] > 1)  # the rest is in one set only
    order = keep[np.argsort(col[keep], kind="stable")]
    row, col = row[order], col[order]
    _, col = np.unique(col, return_inverse=True)
    out = np.zeros((len(a), len(b)), np.float64)
    wide = 4096
    cuts = np.searchsorted(col, np.arange(0, (col[-1] if len(col) else 0) + wide + 1, wide))
    for k, (p, q) in enumerate(zip(cuts, cuts[1:], strict=False)):
        m = np.zeros((len(sizes), wide), np.float32)
        m[row[p:q], col[p:q] - k * wide] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return out.astype(np.int64)


def _linked(one: list[np.ndarray], two: list[np.ndarray], nine: int, four: int) -> np.ndarray:
    """Whether the Jaccard similarity is at least four / (nine - four)."""
    sizes = np.add.outer([len(x) for x in one], [len(x) for x in two])
    return nine * shared(one, two) >= four * sizes


def verify(table: pa.Table) -> pa.Table:
    """Links of a task's groups. In: comp, i, j (blocks that meet here), block, node, copies, shingles. Out: node, other (a
    linked node that stands for all it is linked with here; null if none), n (documents linked)."""
    cols = {c: table.column(c).to_numpy() for c in ("comp", "i", "j", "block", "node", "copies")}
    sets = [np.frombuffer(x.as_buffer(), _U) for x in table.column("shingles")]
    order = np.lexsort((cols["j"], cols["i"], cols["comp"]))
    tile = np.stack([cols[c][order] for c in ("comp", "i", "j")])
    starts = np.flatnonzero(np.append(True, (tile[:, 1:] != tile[:, :-1]).any(axis=0))) if len(order) else []
    out: list[tuple[int, int, int]] = []
    for rows in np.split(order, starts[1:]) if len(order) else []:
        i, j = int(cols["i"][rows[0]]), int(cols["j"][rows[0]])
        block, node, copies = (cols[c][rows] for c in ("block", "node", "copies"))
        one = np.flatnonzero(block == i)
        two = one if i == j else np.flatnonzero(block == j)
        link = _linked([sets[rows[x]] for x in one], [sets[rows[x]] for x in two], 9, 4)
        if i == j:
            np.fill_diagonal(link, False)
        n = np.zeros(len(rows), np.int64)
        n[one] += link @ copies[two]
        if i != j:
            n[two] += link.T @ copies[one]
        root = np.arange(len(rows))
        while True:  # the least linked row, again and again
            least = np.where(link, root[two][None, :], len(rows)).min(axis=1, initial=len(rows))
            other = np.where(link, root[one][:, None], len(rows)).min(axis=0, initial=len(rows))
            after = root.copy()
            np.minimum.at(after, one, least)
            np.minimum.at(after, two, other)
            after = after[after]
            if (after == root).all():
                break
            root = after
        out += [(int(node[x]), int(node[root[x]]), int(n[x])) for x in np.flatnonzero(n)]
    a, b, n = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"node": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})


def join(docs: DataFrame, trees: int = TREES, longest: int = LONGEST, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (the least id that links lead to), n_links (other documents at least 0.8 similar), a row per row.

    Words are split at white space and taken as they are. A text of fewer than five words is one shingle of all its
    words; null texts and texts without words are linked to nothing. Copies are links. Rows without an id are linked to
    nothing and have no class; each repeated row counts as a document. Other columns are not read.
    """
    rows = stored(nodes(docs, trees, longest, target))
    classes = stored(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")))
    matches = rows.where("node is not null").select("node", F.explode("keys").alias("key"))
    heads = matches.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").select("key", "head")
    groups = components(matches.join(heads, "key").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")))
    found = links(docs, groups.withColumnRenamed("root", "comp"), classes, block)
    tree = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    n = found.groupBy("node").agg(F.sum("n").alias("n"))
    labelled = classes.join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    marks = labelled.join(least, "root").join(n, "node", "left").select("node", "class_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    joined = rows.select("doc_id", "node").join(marks, "node", "left")
    found = joined.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    nameless = F.lit(None).cast("long")
    return found.unionByName(docs.where(F.col("doc_id").isNull()).select(nameless.alias("doc_id"), nameless.alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def links(docs: DataFrame, groups: DataFrame, classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Verified links of candidate groups (node, comp): node, other, n as verify() returns them."""
    sized = groups.groupBy("comp").agg(F.count("*").alias("size"))
    big = stored(groups.join(sized, "comp").join(classes, "node"))
    cut = F.ceil(F.col("size") / block).cast("int")
    placed = big.withColumn("block", F.when(cut > 1, F.pmod(F.xxhash64("node"), cut).cast("int")).otherwise(0)).withColumn("with", F.explode(F.sequence(F.lit(0), cut - 1)))
    placed = placed.select("node", "copies", "comp", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    # dealt by node once, for its copies and for the join; an id may have several texts, each a node of its own
    sets = shingle_sets(docs.join(big.select("doc_id").distinct(), "doc_id", "left_semi")).dropDuplicates(["node"])
    tasks = max(1, placed.count() // (4 * block))
    # small groups share tasks, about four blocks of rows each; blocks of large groups have tasks of their own
    task = F.when((F.col("i") == F.col("j")) & (F.col("i") == 0), F.pmod(F.xxhash64("comp"), F.lit(tasks))).otherwise(F.xxhash64("comp", "i", "j"))
    full = placed.join(sets, "node").select(task.alias("task"), "comp", "i", "j", "block", "node", "copies", "shingles")
    return stored(full.groupBy("task").applyInArrow(verify, "node long, other long, n long"))
