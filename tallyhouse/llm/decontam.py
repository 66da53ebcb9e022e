"""Benchmark items inside documents by size-partitioned MinHash containment search: built-in functions only.

An item is the set of its five-word shingles, one of fewer words a single shingle of all its words; a document contains it
if at least 80 % of them are in the document. Items
are partitioned by size. The sketch of an item is the shingles with the least hashes among its own, as many as its
size class needs: a document that lacks one shingle more than allowed cannot contain the item, so a sketch of
`size - needed + 1` shingles of which none is in the document rules it out, however long the document is. Every shingle
of every document probes the sketches; each pair that meets is verified by the exact set of shared shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.common import SHINGLE_WORDS, SIMILARITY, let, stored, windows, words


def _shingles(text: Column, n: int) -> Column:
    """Distinct shingles as text: n words with a blank between."""
    spell = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.array_distinct(let(words(text), lambda w: F.when(F.size(w) >= n, spell(w)).otherwise(F.array().cast("array<string>"))))


def _hashes(text: Column, widths: list[int]) -> Column:
    """Hashes of the shingles of a text in each of some numbers of words, equal for equal shingles."""
    return let(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: F.concat(*(windows(h, n) for n in widths)))


def _all_shingles(text: Column, widths: list[int]) -> Column:
    return F.concat(*(_shingles(text, n) for n in widths))


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """item_id, shingle, width, h, size, class, needed, place (of the shingle by its hash): a row per shingle of an item.

    Rows of one item are one item; items without an id or without words have no shingles. width is the number of words.
    """
    text = F.lower(F.col(text_col).cast("string"))
    whole = F.array_join(words(text), " ")
    of = F.when(F.size(words(text)) >= n, _shingles(text, n)).when(whole != "", F.array(whole))
    each = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.explode(of).alias("shingle")).distinct()
    each = each.withColumn("width", F.size(words(F.col("shingle"))))
    each = each.withColumn("h", F.xxhash64(F.transform(words(F.col("shingle")), lambda w: F.xxhash64(w))))
    by_item = Window.partitionBy("item_id")
    sized = each.withColumn("size", F.count("*").over(by_item)).withColumn("place", F.row_number().over(by_item.orderBy(F.xxhash64("h", F.lit(1)), "shingle")))
    return sized.withColumn("class", F.floor(F.log2("size")).cast("int")).withColumn("needed", F.ceil(F.lit(similarity) * F.col("size") - 1e-9).cast("long"))


def sketches(shingled: DataFrame) -> DataFrame:
    """item_id, h: the least-hash shingles of each item; their number is the largest that an item of its size class needs."""
    most = shingled.groupBy("class").agg(F.max(F.col("size") - F.col("needed") + 1).alias("length"))
    return shingled.join(most, "class").where(F.col("place") <= F.col("length")).select("item_id", "h").distinct()


def contained(docs: DataFrame, items: DataFrame, n: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_found, containment: every pair with containment >= similarity.

    Words are lower-cased and split at white space. Null and empty texts contain nothing; documents without an id are
    not reported; rows of one id are one document. No pair is missed: sketches rule out only what cannot be contained.
    """
    items_of = stored(item_shingles(items, n=n, similarity=similarity))
    widths = sorted(r["width"] for r in items_of.select("width").distinct().collect()) or [n]  # n, and those of shorter items
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    probes = texts.select("doc_id", F.explode(_hashes(F.col("text"), widths)).alias("h"))
    pairs = stored(probes.join(sketches(items_of), "h").select("doc_id", "item_id").distinct())
    suspects = texts.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    theirs = suspects.select("doc_id", F.explode(_all_shingles(F.col("text"), widths)).alias("shingle"))
    both = theirs.join(items_of.select("item_id", "shingle", "size", "needed"), "shingle").join(pairs, ["doc_id", "item_id"], "left_semi")
    found = both.groupBy("doc_id", "item_id").agg(F.max("size").alias("n_shingles"), F.max("needed").alias("needed"), F.count_distinct("shingle").alias("n_found"))
    return found.where("n_found >= needed").select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))
