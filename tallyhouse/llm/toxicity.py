"""Toxic texts by a convolutional classifier trained in numpy.

A word is the sum of the embeddings of three hashes: of itself and of its first five and four letters. Filters of width one to three
run over the words of a whole text; the largest value of each filter, over the whole text, enters a logistic layer.
Fitting takes a bounded, documented sample of labelled rows; thresholds are then chosen for each language on all labelled
rows that fitting has not seen, counted by score. Scores depend on the text alone. Long texts are read block by block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import memory, sliced, stored, strings

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 12, 8, (1, 2, 3)
#: Labelled rows that a model is fitted on, at most, of either label: those whose ids have the least hashes.
MOST_TOXIC, MOST_CLEAN = 4000, 6000
#: Words of that sample, at most; rows that would exceed it are left out of fitting.
MOST_WORDS = 8_000_000
#: Characters of a text that are read at a time, up to the next blank.
PART = 1 << 16
#: Share of the sample that is left out of fitting, so that rows for thresholds remain where it holds all labelled ones.
CALIBRATION = 0.25
#: Scores are counted in steps of their log odds from -LIMIT to LIMIT.
LIMIT, STEPS = 30.0, 6000
THRESHOLD = 0.3
_STRIP = re.compile(r"^\W+|\W+$")
_BLANK = re.compile(r"\s")


class _Buckets(dict):
    """Bucket triples of words, remembered up to a number of words."""

    def __missing__(self, word: str) -> bytes:
        w = _STRIP.sub("", word)
        found = np.array([zlib.crc32(f"{k}{x}".encode("utf-8", "surrogatepass")) % BUCKETS for k, x in enumerate((w, w[:5], w[:4]))], "<u2").tobytes()
        if len(self) < 100_000:
            self[word] = found
        return found


def buckets(text: str) -> np.ndarray:
    """A row of three buckets per word of the text."""
    known = memory(_Buckets)
    return np.frombuffer(b"".join(map(known.__getitem__, text.lower().split())), "<u2").reshape(-1, 3)


def parts(text: str) -> Iterator[str]:
    """A text, cut at blanks into stretches of about PART characters."""
    at = 0
    while len(text) - at > 2 * PART and (m := _BLANK.search(text, at + PART)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


@dataclass
class Model:
    """Weights of the classifier, and thresholds by language with the one for all others."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD

    def pooled(self, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest value of each filter over a text and where it begins; texts shorter than a filter are padded."""
        x = self.embedding[words].sum(axis=1) if len(words) else np.zeros((0, DIM), np.float32)
        top, at = [], []
        for width, w, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            y = np.vstack([x, np.zeros((max(0, width - len(x)), DIM), np.float32)]) if len(x) < width else x
            n = len(y) - width + 1
            z = sum(y[k : k + n] @ w[k] for k in range(width))
            i = z.argmax(axis=0)
            top.append(z[i, np.arange(FILTERS)] + b)
            at.append(i)
        return np.maximum(np.concatenate(top), 0), at

    def odds(self, text: str) -> float:
        """The log odds of a whole text. Its parts overlap by the widest filter, so their largest values are the text's."""
        top, held = None, np.zeros((0, 3), "<u2")
        for part in parts(text):
            held = np.concatenate([held, buckets(part)])
            if len(held) >= max(WIDTHS):
                found = self.pooled(held)[0]
                top = found if top is None else np.maximum(top, found)
                held = held[len(held) - max(WIDTHS) + 1 :]
        return float((self.pooled(held)[0] if top is None else top) @ self.out + self.out_bias)


def _score(z: float) -> float:
    return 1 / (1 + np.exp(-max(-LIMIT, min(LIMIT, z))))


def _start(texts: list[np.ndarray], toxic: np.ndarray, rng: np.random.Generator) -> Model:
    """First weights: an embedding's first value is the log odds of its bucket among the training texts, which the first
    filter of each width looks at; all else is small and random."""
    seen = np.zeros((2, BUCKETS))
    for t, y in zip(texts, toxic, strict=True):
        seen[int(y), np.unique(t)] += 1
    odds = np.log((seen[1] + 0.5) / (toxic.sum() + 1)) - np.log((seen[0] + 0.5) / ((~toxic).sum() + 1))
    odds *= (seen.sum(axis=0) / (seen.sum(axis=0) + 2)) / 3
    embedding = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    embedding[:, 0] = np.clip(odds, -1, 2)
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, 0] = 1.0
    out = np.full(FILTERS * len(WIDTHS), 0.1, np.float32)
    return Model(embedding, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, float(np.log((toxic.sum() + 1) / ((~toxic).sum() + 1))))


def fit(texts: list[np.ndarray], toxic: np.ndarray, epochs: int = 3, rate: float = 0.05, seed: int = 7) -> Model:
    """Adagrad on the logistic loss; gradients pass through the places of the largest values only."""
    rng = np.random.Generator(np.random.PCG64(seed))
    toxic = toxic.astype(bool)
    model = _start(texts, toxic, rng)
    params = [model.out, *model.filters, *model.bias]
    slack = [np.full_like(p, 1e-2) for p in params]
    embed_slack, bias_slack = np.full((BUCKETS, 1), 1e-2, np.float32), 1e-2
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(toxic)
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            words = texts[i]
            top, at = model.pooled(words)
            z = float(top @ model.out + model.out_bias)
            g = (1 / (1 + np.exp(-max(-30.0, min(30.0, z)))) - toxic[i]) * min(float(weight[i]), 5.0)
            if abs(g) < 1e-3 or not len(words):
                continue
            grads = [g * top]
            back = np.where(top > 0, g * model.out, 0).reshape(len(WIDTHS), FILTERS).astype(np.float32)
            to_embedding: list[tuple[int, np.ndarray]] = []
            by_filter, by_bias = [], []
            for k, width in enumerate(WIDTHS):
                df = np.zeros_like(model.filters[k])
                for f in np.flatnonzero(back[k]):
                    for o in range(width):
                        if (p := at[k][f] + o) < len(words):
                            df[o, :, f] = back[k, f] * model.embedding[words[p]].sum(axis=0)
                            to_embedding.append((p, back[k, f] * model.filters[k][o, :, f]))
                by_filter.append(df)
                by_bias.append(back[k])
            for p, s, d in zip(params, slack, [*grads, *by_filter, *by_bias], strict=True):
                s += d * d
                p -= rate * d / np.sqrt(s)
            bias_slack += g * g
            model.out_bias -= rate * g / np.sqrt(bias_slack)
            for p, d in to_embedding:
                rows = words[p]
                embed_slack[rows] += float(d @ d) / DIM
                model.embedding[rows] -= rate * d / np.sqrt(embed_slack[rows])
    return model


def best_threshold(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the highest cutoffs with the fewest errors, a false rejection counting as much as a miss, from the
    weight of clean and of toxic rows by step."""
    errors = np.append(np.cumsum(clean[::-1])[::-1], 0) + np.append(0, np.cumsum(toxic))
    best = np.isclose(errors, errors.min(), rtol=1e-9, atol=1e-9)
    top = low = int(np.flatnonzero(best)[-1])
    while low and best[low - 1]:
        low -= 1
    edge = lambda k: 1.0 if k == STEPS else 0.0 if k == 0 else _score(k / STEPS * 2 * LIMIT - LIMIT)
    return float((edge(top) + edge(low)) / 2)


def _with_odds(rows: DataFrame, model: Model, name: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """rows and the log odds of their texts in a column of that name; without the text unless it is to be kept."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # some 1.6 MB, whatever the tables
    text = rows.columns.index(text_col)
    keep = [i for i in range(len(rows.columns)) if keep_text or i != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for i, f in enumerate(rows.schema) if i in keep)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = pa.array([shared.value.odds(t) for t in strings(batch.column(text))], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), found], names=[*(batch.schema.names[i] for i in keep), name])

    return rows.mapInArrow(each, f"{schema}, `{name}` double")


def _judged(odds: Column, lang: Column, model: Model) -> tuple[Column, Column]:
    """The score of log odds, and whether it reaches the threshold of its language."""
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), odds))))
    threshold: Column = F.lit(model.threshold)
    if model.thresholds:
        own = F.create_map(*(F.lit(x) for e in model.thresholds.items() for x in e))
        threshold = F.coalesce(own[F.coalesce(lang.cast("string"), F.lit(""))], threshold)
    return score, score >= threshold


def _thresholds(scored: DataFrame, marks: DataFrame, fitted: DataFrame, model: Model) -> None:
    """Sets the model's thresholds from all rows (doc_id, lang, odds) with a mark (doc_id, toxic) that are not among the
    fitted ids.

    Only ids, languages and steps are shuffled, only counts reach the driver. Rows that were fitted on are made up for by
    weights, so that both labels have their true shares: of a language for its own threshold, of all rows for the common one.
    """
    step = F.least(F.lit(STEPS - 1), F.greatest(F.lit(0), F.floor((F.col("odds") + LIMIT) / (2 * LIMIT) * STEPS).cast("int")))
    rows = scored.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), step.alias("step"))
    rows = rows.join(marks.where("toxic in (0, 1)"), "doc_id").join(F.broadcast(fitted.withColumn("seen", F.lit(True))), "doc_id", "left")
    counts = rows.groupBy("lang", "toxic", F.when(F.col("seen").isNull(), F.col("step")).alias("step")).agg(F.count("*").alias("n")).collect()
    unseen: dict[str, np.ndarray] = {}
    every: dict[str, np.ndarray] = {}
    for r in counts:
        every.setdefault(r["lang"], np.zeros(2))[r["toxic"]] += r["n"]
        if r["step"] is not None:
            unseen.setdefault(r["lang"], np.zeros((2, STEPS)))[r["toxic"], r["step"]] += r["n"]

    def weighed(of: np.ndarray, total: np.ndarray) -> np.ndarray:
        return of * (total / np.maximum(of.sum(axis=1), 1))[:, None]

    common = sum(unseen.values(), np.zeros((2, STEPS)))
    if common[1].any():
        model.threshold = best_threshold(*weighed(common, sum(every.values(), np.zeros(2))))
        model.thresholds = {lang: best_threshold(*weighed(of, every[lang])) for lang, of in sorted(unseen.items()) if of.sum(axis=1).min() >= 5}


def calibrate(docs: DataFrame, marks: DataFrame, fitted: DataFrame, model: Model) -> None:
    """Sets the model's thresholds from documents with a mark; others are not scored."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text")).join(marks.select("doc_id"), "doc_id", "left_semi")
    _thresholds(_with_odds(labelled, model, "odds", keep_text=False), marks, fitted, model)


def _features(docs: DataFrame) -> DataFrame:
    """doc_id, toxic, words: the buckets of whole texts."""
    kinds = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("words", pa.binary())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([buckets(t).tobytes() for t in strings(batch.column(2))], pa.binary())], schema=kinds)

    return docs.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"), F.col("text").cast("string")).mapInArrow(each, "doc_id long, toxic int, words binary")


def _marks(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))


def _fitted(docs: DataFrame, marks: DataFrame, most_toxic: int, most_clean: int, most_words: int) -> tuple[Model, DataFrame | None]:
    """A model without thresholds of its own, and the ids it was fitted on; None without a label of either kind."""
    spark = docs.sparkSession
    least = F.crc32(F.concat(F.lit("sample"), F.col("doc_id").cast("string")))
    picked = marks.where("toxic = 1").orderBy(least, "doc_id").limit(most_toxic).union(marks.where("toxic = 0").orderBy(least, "doc_id").limit(most_clean))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").join(F.broadcast(picked), "doc_id")
    each = stored(_features(ids).groupBy("doc_id").agg(F.min(F.struct("words", "toxic")).alias("of")).select("doc_id", "of.*"))  # one text of each id
    order = lambda i: (zlib.crc32(str(i).encode()), i)
    taken, words = [], 0
    for doc, n in sorted(((r[0], r[1] // 6) for r in each.select("doc_id", F.length("words")).collect()), key=lambda r: order(r[0])):
        if words + n <= most_words:
            taken.append((doc,))
            words += n
    rows = each.join(F.broadcast(spark.createDataFrame(taken, "doc_id long")), "doc_id").collect() if taken else []
    rows.sort(key=lambda r: order(r["doc_id"]))
    texts = [np.frombuffer(r["words"], "<u2").reshape(-1, 3) for r in rows]
    toxic = np.array([r["toxic"] == 1 for r in rows], bool)
    held = np.array([zlib.crc32(f"held{r['doc_id']}".encode()) % 1000 < 1000 * CALIBRATION for r in rows], bool)
    if not toxic[~held].any() or toxic[~held].all():
        return Model(np.zeros((BUCKETS, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32), -3.0, {}, 1.1), None
    model = fit([t for t, h in zip(texts, held, strict=True) if not h], toxic[~held])
    return model, spark.createDataFrame([(r["doc_id"],) for r, h in zip(rows, held, strict=True) if not h], "doc_id long")


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, most_words: int = MOST_WORDS) -> Model:
    """A model fitted and calibrated on documents with a label.

    labels has doc_id and toxic; rows without either are not used, of several labels of a document the larger counts. The
    sample that is fitted on is bounded by most_toxic + most_clean rows and most_words words whatever the table's size,
    thresholds take all other labelled rows; a language with fewer than five of either label among these has the common
    one. Without a label of either kind every text scores the same and nothing is rejected.
    """
    marks = _marks(labels)
    model, fitted = _fitted(docs, marks, most_toxic, most_clean, most_words)
    if fitted is not None:
        calibrate(docs, marks, fitted, model)
    return model


def judged(docs: DataFrame, labels: DataFrame, whole: bool = False) -> tuple[DataFrame, Column, Column]:
    """Rows of docs, the score of each and whether it is rejected, by a model trained as train() does, all in one reading
    of the texts.

    The rows are stored with their log odds, thresholds are then taken from the odds of the labelled ones. They have doc_id
    and lang only, or with `whole` all columns, in their order, and one more.
    """
    marks = _marks(labels)
    model, fitted = _fitted(docs, marks, MOST_TOXIC, MOST_CLEAN, MOST_WORDS)
    name = "odds"
    while name in docs.columns:
        name += "_"
    rows = docs if whole else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text"))
    rows = stored(_with_odds(rows, model, name, keep_text=whole))
    if fitted is not None:
        _thresholds(rows.select("doc_id", "lang", F.col(name).alias("odds")), marks, fitted, model)
    return rows, *_judged(F.col(name), F.col("lang"), model)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, score (0 to 1) of the whole text, rejected (score at or above its language's threshold), a row per row.

    Null and empty texts have the score of no words; a language without a threshold of its own takes the common one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    found, over = _judged(F.col("odds"), F.col("lang"), model)
    return _with_odds(rows, model, "odds", keep_text=False).select("doc_id", found.alias("score"), over.alias("rejected"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text scores below the threshold of their language, with all their columns."""
    name = "odds"
    while name in docs.columns:
        name += "_"
    over = _judged(F.col(name), F.col(lang_col), model)[1]
    return _with_odds(docs, model, name, text_col).where(~over).select(*docs.columns)
