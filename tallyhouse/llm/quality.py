"""Quality rules whose cutoffs carry a guarantee: built-in functions only.

Each rule rejects documents whose measure lies above a cutoff. The cutoff of a rule and stratum is chosen on labelled
good documents: cutoffs are tested in turn from the loosest to tighter ones, each by the exact binomial probability of
seeing so few false rejections if their rate were the allowed one, and the last one that passes is taken. Testing in
turn needs no correction among the cutoffs of a rule; among rules and strata the error is divided evenly (Bonferroni).
All strata pooled are tested as one more stratum. A stratum with too few labelled documents for any cutoff takes that of the
pool, loosened until its own labelled good documents are rejected at no more than the allowed rate; one without labelled
good documents takes it as it is. For these the guarantee is that of the pool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.common import let, stored, windows, words

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30

N_RULES = 5


def rules() -> dict[str, Column]:
    """Measure of each rule, from the columns of measures(); all are shares from 0 to 1."""
    share = lambda a, b: F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))
    length = F.least(F.lit(1.0), F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) / 50)
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"), "long_words": length, "short_words": 1 - length}


GRID = 200
MOST_FALSE, ERROR = 0.002, 0.05
#: Rows of cutoffs that are sent to all executors; more are joined by key.
MOST_STRATA = 10_000


def _repeated(of: Column) -> Column:
    """Words in windows whose hash the text holds twice or more."""

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            near = lambda x, k: (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))) | (F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            return F.sort_array(F.transform(F.filter(s, near), lambda x: x["i"]))

        begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last"))
        return F.aggregate(let(ordered, twice), begin, step, lambda acc: acc["n"])

    count = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))
    return let(F.transform(of, lambda w: F.xxhash64(w)), lambda h: let(windows(h, WINDOW), count))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of every whole text; null and empty texts count nothing. Windows are compared by
    64-bit hashes within a text, lines as they are."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    counted = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(stratum).cast("string").alias("stratum"),
        counted.alias("w"),
        by_line.alias("l"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    return found.select("doc_id", "stratum", "w.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")


def so_few(k: Column, n: Column, rate: float) -> Column:
    """Probability of at most k successes of n at this rate, exact up to rounding; for k up to rate * n."""
    begin = F.struct((n * F.log(F.lit(1 - rate))).alias("log"), F.exp(n * F.log(F.lit(1 - rate))).alias("p"))

    def step(acc: Column, i: Column) -> Column:
        log = acc["log"] + F.log((n - i + 1) / i) + F.log(F.lit(rate / (1 - rate)))
        return F.struct(log.alias("log"), (acc["p"] + F.exp(log)).alias("p"))

    upto = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(upto, begin, step, lambda acc: acc["p"])


def _tested(found: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum (null: all of them pooled), rule, n_good, n_tests, level, n_false: a row per cutoff on the grid."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("low"))
    good = found.join(marks.where(F.col("low") == 1), "doc_id", "left_semi").withColumn("stratum", F.coalesce("stratum", F.lit("")))
    levels = F.array(*(F.struct(F.lit(r).alias("rule"), F.ceil(m * GRID).cast("int").alias("level")) for r, m in rules().items()))
    counts = stored(good.select("stratum", F.explode(levels).alias("x")).groupBy("stratum", "x.rule", "x.level").agg(F.count("*").alias("n")))
    # at most (strata + 1) * rules * (GRID + 1) rows from here
    counts = counts.unionByName(counts.groupBy("rule", "level").agg(F.sum("n").alias("n")).withColumn("stratum", F.lit(None).cast("string")))
    grid = counts.groupBy("stratum", "rule").agg(F.sum("n").alias("n_good"), F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("at"))
    grid = grid.withColumn("n_tests", (F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(0)))) + 1) * N_RULES)
    tests = grid.select("stratum", "rule", "n_good", "n_tests", "at", F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("level"))
    above = F.aggregate(F.map_entries("at"), F.lit(0).cast("long"), lambda acc, e: acc + F.when(e["key"] > F.col("level"), e["value"]).otherwise(0))
    return tests.withColumn("n_false", above).drop("at")


def _certified(tests: DataFrame, most_false: float, error: float) -> DataFrame:
    """stratum, rule, level, n_good, n_false of the last cutoff that passes."""
    safe = F.when(F.col("n_false") <= most_false * F.col("n_good"), so_few(F.col("n_false"), F.col("n_good"), most_false) <= error / F.col("n_tests")).otherwise(False)
    in_turn = Window.partitionBy("stratum", "rule").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    passed = tests.withColumn("safe", safe).withColumn("all", F.min("safe").over(in_turn)).where("all")
    return passed.groupBy("stratum", "rule").agg(F.min("level").alias("level"), F.max_by("n_false", -F.col("level")).alias("n_false"), F.max("n_good").alias("n_good"))


def cutoffs(found: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR) -> DataFrame:
    """A row per stratum and rule with a certified cutoff: stratum (null for the pool), rule, cutoff, n_good, n_false.

    labels has doc_id and quality; rows without either are not used, nor documents labelled both ways.
    """
    return _certified(_tested(found, labels), most_false, error).select("stratum", "rule", (F.col("level") / GRID).alias("cutoff"), "n_good", "n_false")


def applied(found: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR) -> DataFrame:
    """stratum (null for those without labelled good documents), cut: the cutoffs in use by rule, certified or taken from
    the pool. A stratum that could certify a rule but did not takes none."""
    tests = stored(_tested(found, labels))
    own = stored(_certified(tests, most_false, error).select("stratum", "rule", "level"))
    pool = own.where("stratum is null").select("rule", F.col("level").alias("least"))
    small = F.col("stratum").isNotNull() & (F.exp(F.col("n_good") * F.log(F.lit(1 - most_false))) > error / F.col("n_tests"))
    near = tests.where(small).join(pool, "rule").where((F.col("level") >= F.col("least")) & (F.col("n_false") <= most_false * F.col("n_good")))
    every = own.unionByName(near.groupBy("stratum", "rule").agg(F.min("level").alias("level")))
    strata = tests.select("stratum").distinct().select("stratum", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("int").alias("level"))
    entry = F.when(F.col("rule").isNotNull(), F.struct("rule", (F.col("level") / GRID).alias("cutoff")))
    return every.unionByName(strata).groupBy("stratum").agg(F.map_from_entries(F.collect_list(entry)).alias("cut"))


def apply_rules(docs: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR, stratum: str = "lang") -> DataFrame:
    """doc_id, the counts, base_failed, failed (names of the rules that reject it) and kept, a row per row of docs.

    Null texts are empty and fail; a null stratum is one of its own; repeated rows and ids give a row each; without
    labels, or with too few in all, no rule has a cutoff and the base alone decides.
    """
    found = stored(measures(docs, stratum=stratum))
    cut = stored(applied(found, labels, most_false, error))
    pool = cut.where("stratum is null").first()
    other = F.create_map(*(F.lit(x) for e in (pool["cut"] if pool else {}).items() for x in e)).cast("map<string,double>")
    small = cut.count() <= MOST_STRATA
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    failed = F.array_compact(F.array(*(F.when(m > F.col("cut")[r], F.lit(r)) for r, m in rules().items())))
    rows = found.withColumn("stratum", F.coalesce("stratum", F.lit(""))).join(F.broadcast(cut) if small else cut, "stratum", "left")
    rows = rows.withColumn("cut", F.coalesce("cut", other)).withColumn("base_failed", base).withColumn("failed", F.coalesce(failed, F.array().cast("array<string>")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop("cut")
