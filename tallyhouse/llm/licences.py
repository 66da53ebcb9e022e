"""Licence notices by a positional index of rare tokens: built-in functions only.

A template is the word sequence of a notice with mandatory key phrases. Words are weighed by their inverse document
frequency over all documents. The index lists each template under the two highest-weighted words of its first key
phrase, with their places in the template. A file's licence words are looked up in it; each posting gives the place at
which the template would begin, and only beginnings that the postings of both words share are kept. There the key
phrases are verified word by word, and the weight of the template's words found near their places is its score.

No notice with its key phrases is missed: these hold the words that are looked up. All work on a document is done in its
own row, in time proportional to its words and matches; nothing is shuffled but counts of the templates' words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words by which a later key phrase or a word may stand beside its place, and the least share of weight of a match.
DRIFT, LEAST = 6, 0.6


@dataclass(frozen=True)
class Template:
    """Words of a notice, and its mandatory phrases in order; the first one is the one that places the template."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]
    base: bool = False


def template(label: str, text: str, *keys: str, base: bool = False) -> Template:
    """Key phrases are parts of the text; without any the whole text is one."""
    words = tuple(text.split())
    at = []
    for key in keys or (text,):
        k = tuple(key.split())
        at.append((next(i for i in range(len(words)) if words[i : i + len(k)] == k), k))
    return Template(label, words, tuple(at), base)


# The base phrases, then openings of well-known notices.
TEMPLATES = (
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
    template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge",
        "deal in the software without restriction",
    ),
    template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "under the apache license", "in compliance with the license"),
    template("gpl-2", "gnu general public license version 2"),
    template("gpl-3", "gnu general public license version 3"),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms",
        "following conditions are met",
    ),
    template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license", "source code form"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "distribute this software for any purpose", "is hereby granted"),
    template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software", "public domain"),
    template("cc-by-sa", "cc by sa"),
    template("cc-by-nd", "cc by nd"),
    template("cc-by-nc", "creative commons attribution noncommercial"),
    template("cc-by-sa", "creative commons attribution sharealike"),
    template("cc0", "cc0 1 0 universal"),
)


def words_of(text: Column) -> Column:
    """The words of a text, A to Z in lower case; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def weights(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text") -> dict[str, float]:
    """Inverse document frequency of each word of the templates over all rows: at most as many numbers as the templates
    have words reach the driver."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_intersect(words_of(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(F.array_append(held, F.lit(""))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    count = {r["word"]: r["n"] for r in rows.collect()}
    total = F.log(1 + (F.lit(count.get("", 0)) + 1.0) / (F.col("n") + 1.0))
    each = docs.sparkSession.createDataFrame([(w, count.get(w, 0)) for w in vocabulary], "word string, n long")
    return {r["word"]: r["w"] for r in each.select("word", total.alias("w")).collect()}


def _postings(templates: tuple[Template, ...], weight: dict[str, float]) -> list[list[tuple[str, int, int]]]:
    """(word, template, place) of the heaviest word of each first key phrase, and of the next heaviest."""
    out: list[list[tuple[str, int, int]]] = [[], []]
    for t, of in enumerate(templates):
        off, phrase = of.keys[0]
        ranked = sorted(set(phrase), key=lambda w: (-weight[w], w))
        for rank, word in enumerate((ranked[0], ranked[min(1, len(ranked) - 1)])):
            out[rank] += [(word, t, off + i) for i, w in enumerate(phrase) if w == word]
    return out


def _starts(words: Column, postings: list[tuple[str, int, int]]) -> Column:
    """Template and place of its first word, for each posting of a word of the file."""
    index = F.array(*(F.struct(F.lit(w).alias("word"), F.lit(t).alias("t"), F.lit(p).alias("p")) for w, t, p in postings))
    heads = sorted({w for w, _, _ in postings})
    found = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(heads))
    begin = lambda x: F.transform(F.filter(index, lambda e: e["word"] == x["w"]), lambda e: F.struct(e["t"].alias("t"), (x["i"] - e["p"]).alias("start")))
    return F.array_distinct(F.flatten(F.transform(found, begin)))


def _stands(words: Column, at: Column, phrase: Column) -> Column:
    """Whether a phrase stands at a place of the file."""
    return F.when(at >= 0, F.slice(words, at + 1, F.size(phrase)) == phrase).otherwise(False)


def _verified(words: Column, starts: Column, templates: tuple[Template, ...], weight: dict[str, float]) -> Column:
    """label, base, start and score of the beginnings where the key phrases stand and the score is high enough."""
    strings = lambda x: F.array(*map(F.lit, x))
    phrases = lambda t: F.array(*(F.struct(F.lit(o).alias("off"), strings(k).alias("words"), F.lit(0 if i == 0 else DRIFT).alias("drift")) for i, (o, k) in enumerate(t.keys)))
    weighed = lambda t: F.array(*(F.struct(F.lit(w).alias("word"), F.lit(weight[w]).alias("weight")) for w in t.words))
    known = F.array(*(F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), phrases(t).alias("keys"), weighed(t).alias("words"), F.lit(sum(weight[w] for w in t.words)).alias("all")) for t in templates))

    def near(start: Column, key: Column) -> Column:
        return F.exists(F.sequence(-key["drift"], key["drift"]), lambda d: _stands(words, start + key["off"] + d, key["words"]))

    def share(start: Column, of: Column) -> Column:
        def window(i: Column) -> Column:
            first = F.greatest(start + i - DRIFT, F.lit(0))
            return F.slice(words, first + 1, F.greatest(start + i + DRIFT - first + 1, F.lit(0)))

        held = F.transform(of["words"], lambda e, i: F.when(F.array_contains(window(i), e["word"]), e["weight"]).otherwise(0.0))
        return F.aggregate(held, F.lit(0.0), lambda acc, x: acc + x) / of["all"]

    def match(x: Column, of: Column) -> Column:
        whole = F.size(of["keys"][0]["words"]) == F.size(of["words"])
        score = F.when(whole, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.round(share(x["start"], of), 6)))
        return F.when(F.forall(of["keys"], lambda k: near(x["start"], k)), F.struct(of["label"].alias("label"), of["base"].alias("base"), x["start"].alias("start"), score.alias("score")))

    found = F.transform(starts, lambda x: match(x, known[x["t"]]))
    return F.filter(F.array_compact(found), lambda m: m["score"] >= LEAST)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, matches (label, base, start, score; start is the word at which the template begins, below 0 where
    the file begins within it) of every whole text, a row per row.

    Null and empty texts have no word and no match. Repeated rows and ids give a row each, other columns are not read. A
    place that two templates of a label match is listed twice. Weights depend on all rows, matches of single phrases do not.
    """
    weight = weights(docs, templates, text_col)
    first, second = _postings(templates, weight)

    def starts(words: Column) -> Column:
        shared = lambda one: F.when(F.size(one) > 0, F.array_intersect(one, _starts(words, second))).otherwise(one)
        return let(_starts(words, first), shared)

    def of(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _verified(words, starts(words), templates, weight).alias("matches"))

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), let(words_of(F.col(text_col)), of).alias("found"))
    return found.select("doc_id", "found.n_words", "found.matches")


def summary(found: DataFrame) -> DataFrame:
    """Counts and labels of the rows of scan()."""
    base = lambda: F.filter("matches", lambda m: m["base"])
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")
    starts = F.transform(base(), lambda m: m["start"].cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base()).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base()).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )
