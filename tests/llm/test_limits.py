"""Cases that once were lost, capped or crashed: layouts, deep pages, short items, long texts, layers, ids of two texts."""

import base64
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from tallyhouse.llm import decontam, jaccard, secrets, toxicity, wrapper
from tallyhouse.llm.oracles import ORACLES
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
KEY = "AKIA" + "Q7Z2" * 4
SAID = f"the access key is {KEY} for now"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# ------------------------------------------------------------ pages
def test_every_layout_of_a_host_has_a_reference(spark):
    """Forty layouts, five pages each; more than a round settles, and more than doubled ones."""
    pages = []
    for k in range(40):
        for i in range(5):
            inner = "".join(f"<div class='c{k}x{j}'><h3>Box {k} {j}</h3><ul><li>{j}</li></ul></div>" for j in range(4))
            html = f"<body><div class=l{k}><section class=a{k}><p>Join us in town {k}</p></section>{inner}<section class=b{k}><p>story {k} of {i} and more</p></section></div></body>"
            pages.append((100 * k + i, "http://one.example/x", html))
    data = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in rows(wrapper.extract(data))}
    assert got == {100 * k + i: f"story {k} of {i} and more" for k in range(40) for i in range(5)}
    shaped = wrapper.hosted(data).select("host", "html")
    shapes = spark.createDataFrame([("h", wrapper.fold(wrapper.parse(r["html"])), 1) for r in rows(shaped)], "host string, shape string, n long").groupBy("host", "shape").sum("n").toDF("host", "shape", "n")
    want = [r["references"] for r in rows(wrapper._references(shapes, few=1000))]
    assert [r["references"] for r in rows(wrapper._references(shapes, few=3, many=5))] == want


def test_deep_pages(spark):
    deep = 5000
    for tag in ("div", "span"):
        html = f"<p>start</p>{f'<{tag}>' * deep}inmost{f'</{tag}>' * deep}<p>end</p>"
        data = spark.createDataFrame([(i, "http://d.example/", html) for i in range(4)], "page_id long, url string, html string")
        assert {r["text"] for r in rows(wrapper.extract(data))} == {"start\n\ninmost\n\nend"}
    assert wrapper.align(wrapper.fold(wrapper.parse(html)), wrapper.fold(wrapper.parse(html)))


def plain_match(a, b):
    """Simple tree matching by its recursion: the number of pairs."""
    (la, ka), (lb, kb) = a, b

    def match(x, y):
        if la[x] != lb[y]:
            return 0
        best = [[0] * (len(kb[y]) + 1) for _ in range(len(ka[x]) + 1)]
        for i, c in enumerate(ka[x]):
            for j, d in enumerate(kb[y]):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + match(c, d))
        return 1 + best[-1][-1]

    return match(0, 0)


def test_alignment_is_a_largest_matching():
    rng = random.Random(2)

    def page(depth):
        return "".join(f"<div class={rng.choice('xyz')}>{page(depth - 1) if depth else 't'}</div>" for _ in range(rng.randint(1, 3)))

    for _ in range(40):
        one, two = (wrapper.fold(wrapper.parse(page(3))) for _ in range(2))
        to = wrapper.align(one, two)
        assert len(to) == plain_match(wrapper._tree(one), wrapper._tree(two))
        (la, _), (lb, _) = wrapper._tree(one), wrapper._tree(two)
        assert all(la[x] == lb[y] for x, y in to.items()) and len(set(to.values())) == len(to)


# ------------------------------------------------------------ benchmark items
def test_items_of_few_words(spark):
    items = spark.createDataFrame([(1, "the answer is"), (2, "Forty"), (3, "one two three four"), (4, "is the"), (5, " ")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so the answer  is forty two"), (2, "one two three"), (3, "zero One two three four five"), (4, None), (5, "fortyfold")], "doc_id long, text string")
    got = rows(decontam.contained(docs, items))
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (1, 2), (3, 3)} and all(r["n_shingles"] == r["n_found"] == 1 for r in got)
    con = connect(SMALL)
    for name, df in (("documents", docs), ("benchmark", items)):
        con.register(name, df.toArrow())
    assert differences(decontam.contained(docs, items), con, ORACLES["op9_decontamination"]) is None


# ------------------------------------------------------------ secrets
def wrapped(text, width):
    return "\n".join(text[i : i + width] for i in range(0, len(text), width))


def raw_deflate(data):
    made = zlib.compressobj(9, zlib.DEFLATED, -15)
    return made.compress(data) + made.flush()


@pytest.mark.parametrize(
    "hidden",
    [
        wrapped(base64.b64encode(SAID.encode()).decode(), 12),
        "begin " + wrapped(base64.b64encode(SAID.encode()).decode(), 9),
        base64.b64encode(SAID.encode("utf-16")).decode(),
        base64.b64encode(SAID.encode("utf-16-be")).decode(),
        "".join(f"\\U{ord(c):08X}" for c in SAID),
        SAID.replace("AKIA", "AK&#73;&#x41;"),
        base64.b64encode(raw_deflate((SAID + " and so on " * 9).encode())).decode(),
        base64.b64encode(zlib.compress(base64.b64encode(raw_deflate((SAID + " é " * 30).encode())))).decode(),
    ],
)
def test_layers_are_unwrapped(hidden):
    text = f"é before\n{hidden}\nafter, much later"
    base, every = secrets.secrets(text)
    assert not any(k == 1 for k, _, _ in base)
    spans = [(a, b) for k, a, b in every if k == 1]
    assert spans and all(text.index(hidden) <= a < b <= text.index(hidden) + len(hidden) for a, b in spans)


def test_named_references():
    base, every = secrets.secrets("password&colon; &quot;abcdefghijkl1234&quot;")
    assert not base and every == [(0, 0, 38)]


def test_long_texts_take_memory_by_their_escapes():
    text = "plain words and no more " * 90_000 + "%41" + KEY[1:]
    tracemalloc.start()
    base, every = secrets.secrets(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not base and every == [(1, len(text) - len(KEY) - 2, len(text))] and most < 30 << 20


def test_inflated_data_are_read_in_windows():
    bomb = base64.b64encode(zlib.compress(b" " * (40 << 20) + SAID.encode() + b"." * (20 << 20), 9)).decode()
    tracemalloc.start()
    every = secrets.secrets(bomb)[1]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert every == [(1, 0, len(bomb))] and most < 100 << 20


# ------------------------------------------------------------ toxicity
def model():
    rng = np.random.Generator(np.random.PCG64(1))
    shapes = [(w, toxicity.DIM, toxicity.FILTERS) for w in toxicity.WIDTHS]
    made = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return toxicity.Model(made(toxicity.BUCKETS, toxicity.DIM), [made(*s) for s in shapes], [made(toxicity.FILTERS) for _ in shapes], made(toxicity.FILTERS * len(shapes)), 0.1)


def test_pooling_equals_a_plain_convolution():
    m = model()
    for n in (0, 1, 2, 3, 50):
        words = toxicity.buckets(" ".join(f"w{i * i % 17}" for i in range(n)))
        x = [sum(m.embedding[b] for b in row) for row in words]
        x += [np.zeros(toxicity.DIM)] * max(0, max(toxicity.WIDTHS) - n)
        want = []
        for width, f, bias in zip(toxicity.WIDTHS, m.filters, m.bias, strict=True):
            last = max(1, n - width + 1)
            of = [[sum(float(x[i + k] @ f[k, :, j]) for k in range(width)) for j in range(toxicity.FILTERS)] for i in range(last)]
            want += [max(0.0, max(row[j] for row in of) + bias[j]) for j in range(toxicity.FILTERS)]
        assert np.allclose(m.pooled(words)[0], want, atol=1e-4)


def test_long_texts_score_block_by_block():
    m, rng = model(), random.Random(4)
    text = " ".join(f"word{rng.randint(0, 50000)}" for _ in range(60_000))
    assert len(text) > 8 * toxicity.PART and "".join(toxicity.parts(text)) == text
    whole = float(m.pooled(toxicity.buckets(text))[0] @ m.out + m.out_bias)
    assert m.odds(text) == pytest.approx(whole, abs=1e-5) and m.odds("") == pytest.approx(float(m.pooled(toxicity.buckets(""))[0] @ m.out + m.out_bias))
    assert m.odds("x" * 400_000 + " " + text) == pytest.approx(float(m.pooled(toxicity.buckets("x" * 400_000 + " " + text))[0] @ m.out + m.out_bias), abs=1e-5)
    tracemalloc.start()
    m.odds(text * 12)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 << 20


# ------------------------------------------------------------ Jaccard
def test_an_id_of_two_texts_links_by_either(spark):
    words = [f"w{i}" for i in range(60)]
    one, two = " ".join(words), " ".join(reversed(words))
    near = " ".join([*reversed(words), "end"])
    docs = spark.createDataFrame([(1, one), (1, two), (2, "nothing alike here at all"), (3, near)], "doc_id long, text string")
    got = [(r["doc_id"], r["class_id"], r["n_links"]) for r in rows(jaccard.join(docs))]
    assert sorted(got) == [(1, 1, 0), (1, 1, 1), (2, 2, 0), (3, 1, 1)]
