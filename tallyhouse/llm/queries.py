"""Registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import collocations, decontam, jaccard, licences, packing, preference, quality, repeats, secrets, spelling, token_files, toxicity, wrapper
from tallyhouse.llm.common import shared_dir, table


#: Of the hashes of document ids modulo 4, the one whose labels are held out.
HELD_OUT = 2


def held_out(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % 4 == HELD_OUT


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those that are not held out."""
    return table(spark, sf_dir, "labels").where(~held_out())


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, score, rejected = toxicity.judged(table(spark, sf_dir, "documents"), toxicity_labels(spark, sf_dir))
    predicted = (score >= toxicity.THRESHOLD).cast("int")
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score.alias("score"), predicted.alias("predicted"), rejected.alias("rejected"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_replies(table(spark, sf_dir, "conversations"))
    found = preference.preferences(pairs).withColumnRenamed("key", "conv_id")
    spelled = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.withColumns({c: spelled(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", F.round("containment", 6).alias("containment"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    token_files.write_ids(table(spark, sf_dir, "documents"), folder)
    return token_files.read_ids(spark, folder)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.summary(licences.scan(table(spark, sf_dir, "documents")))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_secret_scan,
        op3_best_fit_packing,
        op4_preference_format,
        op5_page_text,
        op6_repeated_bytes,
        op7_jaccard_join,
        op8_quality_rules,
        op9_decontamination,
        op10_token_files,
        op11_license_scan,
        op12_spelling_groups,
        op13_collocations,
    )
}
