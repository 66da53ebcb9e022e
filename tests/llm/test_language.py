"""Licence notices, spelling variants and collocations against brute force and odd inputs."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import collocations, licences, spelling
from tallyhouse.llm.common import table
from tallyhouse.llm.oracles import ORACLES
from tallyhouse.llm.queries import QUERIES
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
LOW = {c: c + 32 for c in range(65, 91)}


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def con():
    con = connect(SMALL)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    return con


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows and ids, a very long text, a column named like a result."""
    long = "under the MIT license " * 9000 + "x" * 50000
    text = "Released under the MIT license; see Apache License, Version 2.0 and CC BY-NC."
    data = [(1, text, "en", 5), (1, text, "en", 5), (2, "", "en", None), (3, None, None, None), (4, " \n\t ", "de", 4), (5, long, "en", 1), (None, text, None, 1), (6, text, "fr", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, n_words long")


# ------------------------------------------------------------ licences
def plain_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOW))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    found = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_licence_phrases(spark, con, odd):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    for docs in (table(spark, SMALL, "documents"), odd):
        want = sorted([(r["doc_id"], *plain_places(r["text"] or "")) for r in rows(docs)], key=repr)
        got = rows(licences.summary(licences.scan(docs)))
        assert sorted([(r["doc_id"], *(r[n] for n in names)) for r in got], key=repr) == want
        assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got)
    assert differences(QUERIES["op11_license_scan"](spark, SMALL), con, ORACLES["op11_license_scan"]) is None
    assert rows(licences.scan(odd.limit(0))) == []


def test_licence_templates(spark):
    whole = next(t for t in licences.TEMPLATES if t.label == "bsd")
    said = list(whole.words)
    damaged = [*said[:10], "very", *said[11:]]
    shifted = [*said[:12], "and", "only", *said[12:]]
    without = [w for w in said if w not in ("following", "met")]
    half = said[:9] + ["nothing"] * 5 + said[-4:]
    texts = {1: said, 2: damaged, 3: shifted, 4: without, 5: half, 6: said[4:], 7: ["the", "source", "of", "binary"], 8: said * 2}
    docs = spark.createDataFrame([(i, "Here: " + ", ".join(w).title()) for i, w in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(licences.scan(docs))}
    labels = {i: [m["label"] for m in r["matches"]] for i, r in got.items()}
    assert labels[1] == labels[2] == labels[3] == ["bsd"] and labels[8] == ["bsd", "bsd"]
    assert labels[4] == labels[7] == [] and labels[6] == []
    score = {i: max((m["score"] for m in r["matches"]), default=0) for i, r in got.items()}
    assert score[1] == 1 > score[2] > 0.9 and got[1]["matches"][0]["start"] == 1
    more = spark.createDataFrame([(1, "This work is licensed under the GNU General Public License version 3."), (2, "mit license under the")], "doc_id long, text string")
    assert [r["labels"] for r in sorted(rows(licences.summary(licences.scan(more))), key=lambda r: r["doc_id"])] == ["gpl-3", ""]


# ------------------------------------------------------------ spelling
def plain_counts(docs, one_in, least_length, least_count):
    n = collections.Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n, times=5):
    form, near = {}, {}
    for w in n:
        found = [x for x in n if x != w and one_edit(w, x)]
        near[w] = len(found)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    root = {}
    for w in n:
        root[w] = w
        while form[root[w]] is not None:
            root[w] = form[root[w]]
    return {(w, form[w], root[w], n[w], near[w], n[form[w]] if form[w] else None) for w in n}


def as_rows(df):
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows(df)]


def test_spelling_groups(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows(table(spark, SMALL, "documents"))]
    got = as_rows(QUERIES["op12_spelling_groups"](spark, SMALL))
    assert len(got) == len(set(got)) and set(got) == plain_variants(plain_counts(docs, 199, 6, 5))


def test_spelling_of_dense_words(spark, odd):
    """Short words over few letters, so that most have near ones of either length; small blocks, chains of forms, long words."""
    rng = random.Random(5)
    long = "".join(rng.choice("abc") for _ in range(3000))
    words = ["".join(rng.choice("abÉ") for _ in range(rng.randint(2, 6))) for _ in range(400)] + [long, long[:99] + "z" + long[100:], long[:-1]]
    n = {w: rng.choice((1, 2, 6, 31, 160, 900)) for w in words}
    data = spark.createDataFrame(list(n.items()), "word string, n long")
    for block in (7, 256):
        got = as_rows(spelling.variants(data, block=block))
        assert len(got) == len(n) and set(got) == plain_variants(n)
    texts = [(i, " ".join(rng.choice(words[:40]) + rng.choice(("", "É", "q")) for _ in range(60))) for i in range(20)] + [(None, "ABba abba × abba"), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, word string")
    got = {r["word"]: r["n"] for r in rows(spelling.counted(docs, least_length=2, least_count=2, one_in=3))}
    assert got == plain_counts(texts, 3, 2, 2)
    assert rows(spelling.spelling_groups(odd.limit(0))) == [] and {r["word"] for r in rows(spelling.spelling_groups(odd))} >= {"license"}


# ------------------------------------------------------------ collocations
def plain_collocations(docs, least, top=2000, longest=5):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, of in f.items():
        often = {p: a for p, a in of.items() if a >= least and len(p) > 1}
        inside = {p[i:j] for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= of[p[i:j]]}
        found = []
        for p, a in often.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        out |= {(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)}
    return out


def mined(df):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in rows(df)}


def test_collocations(spark, con, odd):
    assert differences(QUERIES["op13_collocations"](spark, SMALL), con, ORACLES["op13_collocations"]) is None
    rng = random.Random(3)
    words = ["a", "B", "été", "The", "x-y", "日本", "c d"]
    texts = [(rng.choice(("en", "de", None)), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r"]) for _ in range(rng.randint(0, 60)))) for _ in range(60)]
    texts += [("en", None), ("en", ""), ("und", "the the the the the the the"), ("fr", "... ,")] + [("en", "one two three four five six seven")] * 9
    docs = spark.createDataFrame([(1, t, lang, 7) for lang, t in texts], "doc_id long, text string, lang string, n long")
    for least, top, bits in ((3, 2000, 26), (2, 12, 26), (8, 2000, 7), (1, 50, 8)):
        assert mined(collocations.collocations(docs, least=least, top=top, bits=bits)) == plain_collocations(texts, least, top)
    assert rows(collocations.collocations(odd.limit(0))) == []
    assert mined(collocations.collocations(odd, least=100)) == plain_collocations([(r["lang"], r["text"]) for r in rows(odd)], 100)


def test_scores_are_exact(spark):
    """Products beyond 64 bits; a cut whose score is the same after flooring does not displace an earlier one."""
    a, n, big = 10**13, 3 * 10**14, 7 * 10**13
    phrases = spark.createDataFrame([("en", "x", 1, big), ("en", "y", 1, big + 1), ("en", "x y", 2, a), ("en", "z", 1, big), ("en", "y z", 2, a + 1), ("en", "x y z", 3, a)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    got = {r["phrase"]: (r["score"], r["l"], r["r"]) for r in rows(collocations.scored(phrases.where("size > 1"), phrases, totals))}
    assert got["x y"] == (1000 * a * n // (big * (big + 1)), big, big + 1)
    cuts = [(1000 * a * n // (big * (a + 1)), 1, big, a + 1), (1000 * a * n // (a * big), 2, a, big)]
    assert got["x y z"] == (min(cuts)[0], *min(cuts)[2:])


def test_flow_counts_equal_counts(spark):
    """Counts that flow out of edges and ends are those of the texts, also where pieces were cut."""
    texts = [("en", "a b c d e f a b c d e g"), ("en", "a b. c d e f, a b c"), ("en", "q a b c z")] * 3
    docs = spark.createDataFrame(texts, "lang string, text string")
    rows_of = collocations._texts(docs, "text", "lang")
    phrases, totals = collocations.flows(collocations.grams(rows_of, collocations.sieve(rows_of, 4)), least=4)
    want = collections.Counter()
    for _, t in texts:
        for p in re.split("[.,]", t):
            w = p.split()
            want.update(" ".join(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    assert {r["phrase"]: r["f"] for r in rows(phrases)} == {p: k for p, k in want.items() if k >= 4}
    assert rows(totals) == [{"lang": "en", "n": 3 * 26}]
    assert rows(phrases.where(F.col("size") != F.size(F.split("phrase", " ")))) == []
