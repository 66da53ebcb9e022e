"""Corpus operators against brute force, exact round trips, held-out accuracy and odd inputs."""

import base64
import collections
import gzip
import hashlib
import os
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import common, decontam, jaccard, packing, preference, quality, repeats, secrets, token_files, toxicity, wrapper
from tallyhouse.llm.common import shared_dir, table
from tallyhouse.llm.oracles import ORACLES
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.tokens import Encoder, tokenizer_path
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak near the quiet river bank"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows and ids, a very long text, a column named like a result."""
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))
    data = [
        (1, PROSE, "en", "a", 1, "x"),
        (1, PROSE, "en", "a", 1, "x"),
        (2, "", "en", None, 0, None),
        (3, None, None, None, None, None),
        (4, " \n\t ", "de", "b", 4, "y"),
        (5, long, "en", "a", len(long), "z"),
        (6, PROSE.replace("oak", "elm"), "fr", "a", 1, "x"),
        (None, PROSE, "en", "a", 1, "x"),
        (7, "a b", "en", "a", 3, "x"),
        (8, "a b", "en", "a", 3, "x"),
    ]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="module")
def small(spark):
    return {r["doc_id"]: r["text"] or "" for r in rows(table(spark, SMALL, "documents"))}


def test_word_ids_equal_those_of_the_whole_text():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["it's I'LL x'RE 'd", "a\x1cb\x85d e\xa0f g　h", "é É́a ÀÉ,. İstanbul ΣΑΣ œuvre ﬁ", "<|endoftext|> a<|startoftext|>b", " \n", "", "12,345.67 x² 日本語 text.", "stop,, a.b,c Word. WORD, word"]
    for forget in (0, 1000):
        for text, ids in zip(texts, Encoder(tokenizer_path(), remember=forget).ids(texts), strict=True):
            assert plain.encode(text, add_special_tokens=False).ids == ids.tolist()


def test_token_files_round_trip(spark, odd, small):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    at = 0
    for r in sorted(rows(QUERIES["op10_token_files"](spark, SMALL)), key=lambda r: r["doc_id"]):
        ids = [*plain.encode(small[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    folder = shared_dir(spark)
    token_files.write_ids(odd, folder)
    back = sorted(rows(token_files.read_ids(spark, folder, with_ids=True)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in back] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert [r["ids"] for r in back if r["doc_id"] in (2, 3, 4)] == [[2]] * 3
    empty = shared_dir(spark)
    token_files.write_ids(odd.limit(0), empty)
    assert rows(token_files.read_ids(spark, empty)) == []


def test_packing_places_every_piece_once(spark, odd):
    for found in (QUERIES["op3_best_fit_packing"](spark, SMALL), packing.pack_documents(odd), packing.pack_documents(odd, capacity=64)):
        got = rows(found)
        most = max(r["length"] for r in got)
        by = collections.defaultdict(list)
        for r in got:
            by[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in by.values():
            ends = np.cumsum([n for _, n in sorted(places)])
            assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= max(most, 4096)
        assert len(by) <= 1.05 * sum(r["length"] for r in got) / (64 if most == 64 else 4096) + 1
    assert collections.Counter(r["doc_id"] for r in rows(packing.pack_documents(odd)))[1] == 2
    assert rows(packing.pack_documents(odd.limit(0))) == []


def test_sweep_takes_the_smallest_gap_that_holds():
    # 5 opens a sequence and leaves 3; 4 opens one and leaves 4; both 3s fit the gap of 3 first, then that of 4; 1 fits what is left
    assert packing.sweep({5: 1, 4: 1, 3: 2, 1: 1}, 8) == [(5, 0, 1, 0, 0), (4, 0, 1, 1, 0), (3, 0, 1, 0, 5), (3, 1, 1, 1, 4), (1, 0, 1, 1, 7)]


def plain_scan(text):
    assign = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(0, *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(2, *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], s[0]))


def test_secrets(spark, odd, small):
    for r in rows(QUERIES["op2_secret_scan"](spark, SMALL)):
        base = plain_scan(small[r["doc_id"]])
        spelled = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest() and r["n_hex"] == sum(k == 2 for k, _, _ in base)
    assert len(rows(secrets.find_secrets(odd))) == odd.count()
    hidden = "api_key: abcdefghijklmnop"
    once = base64.b64encode(gzip.compress(hidden.encode())).decode()
    twice = base64.b64encode(f"see {once} there".encode()).decode()
    quoted = urllib.parse.quote("é secret = 'qwertyuiopas'", safe="")
    text = f"é {twice} and {quoted} and \\u0041\\x4BIAQRSTUVWXYZQRSTUV and &#116;oken=abcdefghijkl end"
    base, every = secrets.secrets(text)
    assert base == []
    assert [text[a:b] for _, a, b in every][0] in twice and [text[a:b] for _, a, b in every][1:] == [quoted[quoted.index("secret") : -3], "\\u0041\\x4BIAQRSTUVWXYZQRSTUV", "&#116;oken=abcdefghijkl"]
    for s in ("token=secret: ABCDEFGHIJKLMNOP", "TOKEN= abcdefghijkl", "ſecret=abcdefghijklm", "%E9%zz%", "&#x110000;", "\\ud800"):
        assert secrets.secrets(s)[0] == plain_scan(s)
    kept = rows(secrets.redact(spark.createDataFrame([(1, "a token=abcdefghijklm b", 23), (2, None, None)], "doc_id long, text string, n_chars long")))
    assert kept == [{"doc_id": 1, "text": "a [secret] b", "n_chars": 12}, {"doc_id": 2, "text": None, "n_chars": None}]


def test_secrets_behind_prefixes_line_ends_escapes_and_members():
    hidden = b"see api_key: abcdefghijklmnop there"
    noise = base64.b64encode(bytes(random.Random(1).randrange(256) for _ in range(150)))
    packed = gzip.compress(hidden)
    wrapped = base64.encodebytes(gzip.compress(noise + hidden)).decode()
    literal = "".join(f"\\x{c:02x}" for c in zlib.compress(hidden))
    payload = base64.b64encode(hidden).decode()
    cases = [f"http://e.example/x/{payload}", f"key-{payload}", f"a/bc_{base64.b64encode(packed).decode()}", f"{payload}/more", wrapped, "pre\n" + wrapped.replace("\n", "\r\n"), base64.encodebytes(noise + hidden).decode()]
    cases += [f"q={urllib.parse.quote(packed)}&z", f"q={urllib.parse.quote_plus(packed)}", literal, repr(packed), base64.b64encode(gzip.compress(b"first") + packed).decode()]
    for case in cases:
        assert secrets.secrets(case)[0] == [] and any(k == 0 for k, _, _ in secrets.secrets(case)[1]), case
    twice = secrets.secrets(f"{payload} and {payload}")[1]
    assert len(twice) == 2 and twice[1][1] > len(payload)
    assert secrets.secrets("a-long-hyphenated-word/and/path_of_words\nnext line %20 \\x41")[1] == []


def plain_repeats(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        data = texts[i].encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(data[p : p + 100])
        out[i] = (len(data), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeats(spark, odd, small):
    rng = np.random.default_rng(3)
    noise = ["".join(map(chr, rng.integers(97, 123, 400))) for _ in range(6)]
    texts = {1: "ab" * 300, 2: noise[0] + noise[1], 3: noise[1][37:290] + noise[0][:150], 4: "x" * 99, 5: "x" * 250, 6: noise[2] + noise[0][200:299] + noise[2], 7: "é" * 200, 8: noise[3][:180] + "!" + noise[1][100:] + "ab" * 60}
    for found, want in ((repeats.digest(repeats.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))), plain_repeats(texts)), (QUERIES["op6_repeated_bytes"](spark, SMALL), plain_repeats(small))):
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(found)} == want
    got = rows(repeats.digest(repeats.remove_repeats(odd)))
    assert len(got) == odd.count() and [r["n_removed"] for r in got if r["doc_id"] in (1, None)] == [0, 0, 0]
    assert rows(repeats.remove_repeats(odd.limit(0))) == []


def test_repeats_return_the_removed_spans_and_the_kept_bytes(spark):
    rng = np.random.default_rng(5)
    first = "".join(map(chr, rng.integers(97, 123, 700)))
    texts = {1: first, 2: "é" + first[50:200] + "-" + first[300:460], 3: "", 4: None, 5: first[:99]}
    got = {r["doc_id"]: r for r in rows(repeats.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))}
    assert got[2]["spans"] == [{"start": 2, "end": 152}, {"start": 153, "end": 313}] and bytes(got[2]["kept"]) == "é-".encode()
    for i, text in texts.items():
        data, r = (text or "").encode(), got[i]
        kept, at = b"", 0
        for span in r["spans"]:
            kept, at = kept + data[at : span["start"]], span["end"]
        assert bytes(r["kept"]) == kept + data[at:] and r["n_bytes"] == len(data)
    assert all(got[i]["spans"] == [] for i in (1, 3, 4, 5))


def plain_links(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root, n = {i: i for i in texts}, collections.Counter()

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                n[a], n[b] = n[a] + 1, n[b] + 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (find(i), n[i]) for i in texts}


def test_components(spark):
    """Chains, stars with great centres, cycles, loops and random edges against labels spread by hand."""
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(1000 - k, 2000) for k in range(40)] + [(2000, 2000)]
    zigzag = list(zip(range(3000, 3040), reversed(range(3040, 3080)), strict=True)) + list(zip(range(3001, 3041), reversed(range(3040, 3080)), strict=True))
    odd = [(-(1 << 63), 7), (7, (1 << 63) - 1), (7, 7), (7, -(1 << 63))]
    loose = [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(110)]
    edges = chain + star + zigzag + odd + loose
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(root) and {r.node: r.root for r in got} == root
    assert common.components(spark.createDataFrame([(5, 5)], "a long, b long")).collect() == []


def test_jaccard_join(spark, odd, small):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
    texts = {0: " ".join(base)}
    for i in range(1, 200):  # copies of one text with a few words changed, linked mostly by way of it
        copy = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            copy[at] = f"x{rng.integers(0, 9)}"
        texts[i] = " ".join(copy)
    texts |= {900: "a b", 901: "a  b\n", 902: "", 903: "a b c"}
    data = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for found, want in ((jaccard.join(data, block=16), plain_links(texts)), (QUERIES["op7_jaccard_join"](spark, SMALL), plain_links(small))):
        assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows(found)} == want
    found = rows(jaccard.join(odd))
    got = {(r["doc_id"], r["class_id"], r["n_links"]) for r in found}
    assert got == {(1, 1, 1), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 6, 0), (7, 7, 1), (8, 7, 1), (None, None, 0)}
    assert len(found) == odd.count()
    assert rows(jaccard.join(odd.limit(0))) == []
    assert jaccard.prefix_length(16, 8, 0.99) == 6 and jaccard.prefix_length(16, 8, 0.9999) == 3


def plain_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    where = collections.defaultdict(list)
    for k in range(len(w) - 7):
        where[tuple(w[k : k + 8])].append(k)
    covered = {k + j for at in where.values() if len(at) > 1 for k in at for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)}


def test_quality_rules(spark, odd, small):
    for r in rows(QUERIES["op8_quality_rules"](spark, SMALL)):
        want = plain_measures(small[r["doc_id"]])
        assert {k: r[k] for k in want} == want and not (r["kept"] and r["base_failed"])
    labels = table(spark, SMALL, "labels")
    assert len(rows(quality.apply_rules(odd, labels))) == odd.count()
    assert rows(quality.apply_rules(odd.limit(0), labels.limit(0))) == []
    assert [r["kept"] for r in rows(quality.apply_rules(odd, labels.limit(0)).orderBy("doc_id"))] == [True, True, True, False, False, False, False, True, False, False]


def test_cutoffs_hold_the_risk(spark):
    from math import comb

    chance = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    got = spark.createDataFrame([(0, 400), (3, 400), (12, 2000)], "k long, n long").select("k", "n", quality.so_few(F.col("k"), F.col("n"), 0.01).alias("p"))
    assert all(abs(r["p"] - chance(r["k"], r["n"], 0.01)) < 1e-9 for r in rows(got))
    good = [(i, "en", 100, 500, 5 if i % 500 == 0 else 0, 10, 0, 0) for i in range(3000)] + [(5000 + i, "rare", 100, 500, 0, 10, 0, 0) for i in range(20)]
    found = spark.createDataFrame(good, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    labels = spark.createDataFrame([(g[0], 1) for g in good] + [(None, 1), (1, None)], "doc_id long, quality int")
    cut = {(r["stratum"], r["rule"]): r for r in rows(quality.cutoffs(found, labels, most_false=0.01))}
    assert cut["en", "symbols"]["cutoff"] == 0 and cut["en", "symbols"]["n_false"] == 6 and not any(s == "rare" for s, _ in cut)
    assert cut["en", "long_words"]["cutoff"] == 0.1 and rows(quality.cutoffs(found, labels, most_false=0.0001)) == []


def test_small_strata_take_the_cutoff_of_the_pool(spark):
    """Rejections on sf0.1, where no stratum alone has enough labels; a small stratum's own good documents loosen a cutoff."""
    sf = "/root/testdata/sf0.1"
    got = rows(quality.apply_rules(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels"), "doc_id").where("not base_failed").groupBy("quality").agg(F.sum((~F.col("kept")).cast("int")).alias("n"), F.count("*").alias("of")))
    by = {r["quality"]: r["n"] / r["of"] for r in got}
    assert by[0] > 0.5 and by[1] <= quality.MOST_FALSE
    good = [(i, "en", 100, 500, 0, 10, 0, 0) for i in range(4000)] + [(5000 + i, "rare", 100, 500, 100 if i < 5 else 0, 10, 0, 0) for i in range(20)]
    found = spark.createDataFrame(good, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    cut = {r["stratum"]: r["cut"] for r in rows(quality.applied(found, spark.createDataFrame([(g[0], 1) for g in good], "doc_id long, quality int")))}
    assert set(cut) == {"en", "rare", None} and cut["en"]["symbols"] == 0 and cut["rare"]["symbols"] == 0.2 and cut["rare"]["dup_lines"] == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = connect(SMALL)
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(1, PROSE), (2, "a b"), (None, PROSE), (3, None), (4, PROSE.upper()), (4, PROSE.upper())], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_found"], r["n_shingles"]) for r in rows(decontam.contained(odd, items))}
    # an item of fewer than five words is one shingle of all its words
    assert got == {(1, 1, 19, 19), (1, 4, 19, 19), (7, 2, 1, 1), (8, 2, 1, 1)}  # a changed word in the middle leaves 14 of 19 shingles
    assert rows(decontam.contained(odd.limit(0), items)) == rows(decontam.contained(odd, items.limit(0))) == []


def test_preferences(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "one"), (0, 0, "user", "yo"), (0, 1, "assistant", "two"), (0, 1, "assistant", "two"), (5, 0, None, None), (None, 0, "user", "x")]
    pairs = preference.swapped_replies(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {r["key"]: r for r in rows(preference.preferences(pairs))}
    assert got[1] == {"key": 1, "n_prompt_turns": 1, "prompt": "<|user|>\nhi<|end|>\n", "chosen": "<|assistant|>\none<|end|>\n", "rejected": "<|assistant|>\ntwo<|end|>\n", "chosen_mask": [{"start": 14, "end": 25}], "rejected_mask": [{"start": 14, "end": 25}]}
    assert got[5]["prompt"] == "<|" + "|>\n<|end|>\n" and got[5]["chosen"] == got[5]["rejected"] == "" and set(got) == {0, 1, 5}
    one = preference.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).where("key = 1")
    alone = rows(preference.preferences(one.select("key", F.col("turns").alias("chosen"), F.lit(None).cast(one.schema["turns"].dataType).alias("rejected"))))
    assert alone[0]["n_prompt_turns"] == 0 and alone[0]["rejected"] == ""


def test_page_text(spark):
    page = '<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li>Home<li>More</ul></nav><div class="ad">Buy</div><article><h1>A &amp; B</h1><p><b>One<br>two\n three<p>Four&nbsp;<i>f</i>ive<aside>no</aside><div class="comments"><p>first!</p></div></article><footer>f</footer>'
    assert wrapper.main_text(page, None, []) == "A & B\n\nOne two three\n\nFour five"
    plain = "<html><body><div class=top>Same notice here</div><div class=text><p>{}</p><p>{}</p></div></body></html>"
    pages = [(i, f"http://a.example/{i}", plain.format(f"p{i}", f"q{i}")) for i in range(5)] + [(9, None, None), (10, "http://b.example/", ""), (11, "x", "just text"), (11, "x", "just text")]
    got = {r["page_id"]: r for r in rows(wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))))}
    assert got[3]["text"] == "p3\n\nq3" and got[3]["n_chars"] == 6 and got[9]["text"] == got[10]["text"] == "" and got[11]["text"] == "just text"
    assert rows(wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string"))) == []


def test_page_text_by_layout(spark):
    """Constant text inside the article goes, text outside teaser cards stays, each layout of a host has its own template."""
    story = "<html><body><main><div class=x>Ask us anything</div><article><h1>h{0}</h1><p>one {0}</p><p><b>Get our letter</b></p><p>two {0}</p></article></main></body></html>"
    cards = "<html><body><div class=lead><h2>Topic {0}</h2><p>essay {0}</p></div><section><article><a href=/>card {0}</a></article></section><div class=foot>Call now</div></body></html>"
    pages = [(i, "http://a.example/s", story.format(i)) for i in range(6)] + [(10 + i, "http://a.example/c", cards.format(i)) for i in range(4)]
    pages += [(20 + i, "http://b.example/", story.format(7)) for i in range(5)] + [(30, "http://c.example/", story.format(8))]
    got = {r["page_id"]: r["text"] for r in rows(wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")))}
    assert got[3] == "h3\n\none 3\n\ntwo 3" and got[12] == "Topic 2\n\nessay 2\n\ncard 2"
    assert got[20] == "h7\n\none 7\n\nGet our letter\n\ntwo 7" and got[30] == "h8\n\none 8\n\nGet our letter\n\ntwo 8"


def test_toxicity_on_held_out_rows(spark, odd):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op1_toxicity"](spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id").toPandas()
    assert ((scored["predicted"] == 1) == (scored["toxic"] == 1)).mean() > 0.97
    model = toxicity.train(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    got = rows(toxicity.score(odd, model))
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got) and len({r["score"] for r in got if r["doc_id"] in (2, 3, 4)}) == 1
    assert toxicity.accepted(odd, model).columns == odd.columns
    none = toxicity.train(odd, table(spark, SMALL, "labels").limit(0))
    assert not any(r["rejected"] for r in rows(toxicity.score(odd, none)))


def test_thresholds_take_all_labelled_rows(spark, monkeypatch):
    """However few rows are fitted on, every other labelled row counts, and both labels keep their true shares."""
    seen, plain = [], toxicity.best_threshold
    monkeypatch.setattr(toxicity, "best_threshold", lambda clean, toxic: seen.append((clean.sum(), toxic.sum())) or plain(clean, toxic))
    docs, labels = table(spark, SMALL, "documents").drop("toxic"), table(spark, SMALL, "labels")
    model = toxicity.train(docs, labels, most_toxic=8, most_clean=8)
    n = dict(docs.join(labels, "doc_id").where("toxic is not null").groupBy("toxic").count().collect())
    assert seen[0] == pytest.approx((n[0], n[1])) and n[0] > 20
    docs = spark.createDataFrame([(i, "en", "x") for i in range(30)], "doc_id long, lang string, text string")
    marks = spark.createDataFrame([(i, int(i >= 20)) for i in range(30)], "doc_id long, toxic int")
    seen.clear()
    toxicity.calibrate(docs, marks, marks.where("doc_id < 5").select("doc_id"), model)
    assert seen == [pytest.approx((20, 10))] * 2
    clean, toxic = np.zeros(toxicity.STEPS), np.zeros(toxicity.STEPS)
    clean[2900], toxic[3100] = 9, 3
    assert plain(clean, toxic) == pytest.approx((1 / (1 + np.exp(0.99)) + 1 / (1 + np.exp(-1))) / 2)


def test_pipeline(spark, odd):
    docs = table(spark, SMALL, "documents")
    kept, want = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SMALL)
        assert name == "best_fit_packing" or kept.columns == want
    packed = rows(corpus_pipeline.run(spark, SMALL))
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows(kept)} and 100 < len(packed) < 250
    once = [(r["doc_id"], r["text"]) for r in rows(corpus_pipeline.one_of_each_group(spark, odd, SMALL))]
    assert sorted(x for x, _ in once if x is not None) == [1, 2, 3, 4, 5, 6, 7]
    for _, stage in corpus_pipeline.STAGES:
        assert rows(stage(spark, odd.limit(0), SMALL)) == []


def test_entry_without_the_package(tmp_path):
    import shutil
    import subprocess
    import sys

    here = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copytree(here, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
