"""Scalar functions against literal cases and the standard library."""

from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from khabarloom.functions import fingerprint, html, text, urls
from khabarloom.functions.runs import run_sets, set_keys, tokens

from .conftest import rows


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("given_", "want"),
    [
        ("http://www.Example.com/story/1/", "https://example.com/story/1"),
        ("https://example.com/a?utm_source=fb&fbclid=xyz&id=7", "https://example.com/a?id=7"),
        ("https://example.com/a#comments", "https://example.com/a"),
        ("https://news.example/post-16683/", "https://news.example/post-16683"),
        ("https://h", "https://h"),
        ("https://h/", "https://h/"),
        ("https://h//", "https://h"),
        ("https://h/a?b=&c", "https://h/a?b=&c="),
    ],
)
def test_canonical_url(spark, given_, want):
    assert one(spark, given_, urls.canonical_url) == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.text("abUT_%+ क*~é", min_size=1, max_size=4), st.text("xy=&/ ~*ख", max_size=4)), max_size=4))
def test_canonical_url_like_the_standard_library(spark, pairs):
    url = "http://www.News.example/Path/?" + urlencode(pairs)
    parts = urlsplit(url)
    kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not k.lower().startswith(urls.TRACKING_PREFIXES) and k.lower() not in urls.TRACKING_KEYS]
    assert one(spark, url, urls.canonical_url) == urlunsplit(("https", "news.example", "/Path", urlencode(kept), ""))


def test_clean(spark):
    assert text.clean_text("<p>काठमाडौं&nbsp;:&amp; test</p>") == "काठमाडौं :& test"
    assert text.clean_text("&amp;lt;b&amp;gt; x") == "<b> x"
    assert text.clean_text("a\r\n\n\n\n b‌c ") == "a\n\nb c"
    assert rows(spark.createDataFrame([(None,), ("",), (" <b>x</b> ",)], "x string").select(text.clean("x"))) == [("",), ("",), ("x",)]


def test_devanagari(spark):
    assert one(spark, "२०८३ भदौ ३", text.ascii_digits) == "2083 भदौ 3"
    assert one(spark, "काठमाडौं", text.looks_devanagari) is True
    assert one(spark, "Valley Post", text.looks_devanagari) is False
    assert one(spark, "123", text.devanagari_share) is None


@pytest.mark.parametrize(("value", "want"), [("a b", ["a b"]), ("", []), ("a b c d", ["a b c", "b c d"]), ("क । B_1", ["क । b_1"])])
def test_runs(spark, value, want):
    assert one(spark, value, lambda c: text.runs(text.tokenize(c))) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab क.", max_size=20), max_size=6))
def test_run_sets_like_brute_force(texts):
    owner, run = run_sets(texts)
    hi, lo, n = set_keys(len(texts), owner, run)
    want = []
    for t in texts:
        w = tokens(t)
        want.append(frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) or (frozenset([tuple(w)]) if w else frozenset()))
    assert list(n) == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(len(texts)):
            if want[i]:
                assert (want[i] == want[j]) == ((hi[i], lo[i], n[i]) == (hi[j], lo[j], n[j]))
                a, b = set(run[owner == i].tolist()), set(run[owner == j].tolist())
                assert len(a & b) == len(want[i] & want[j])


def test_simhash(spark):
    base = "The council met on Monday to discuss the new road through the valley and agreed to fund repairs before winter. " * 3
    near = base + "It will meet again."
    far = "Rice prices rose sharply across eastern markets as traders cited late rains and higher fuel costs this season. " * 3
    h = [fingerprint.fingerprint_of(x) for x in (base, near, far)]
    assert (h[0] ^ h[1]).bit_count() <= 8 < 16 < ((h[0] ^ h[2]) & (1 << 64) - 1).bit_count()
    assert fingerprint.fingerprint_of("") == 0
    got = spark.createDataFrame([(base,), (None,)], "x string").select(fingerprint.simhash("x")).collect()
    assert [r[0] for r in got] == [h[0], 0]
    assert fingerprint.fingerprint_of("a b c") == int.from_bytes(__import__("hashlib").blake2b(b"a b c", digest_size=8).digest(), "big", signed=True)


PAGE = """<html><head><script type="application/ld+json">{bad</script>
<script type="application/ld+json">[{"@type":"Organization","author":{"name":"WRONG"}},{"@graph":[{"@type":"NewsArticle","headline":"a&amp;nbsp;b","author":{"name":"RIGHT"},"image":["a.jpg","b.jpg"]}]}]</script></head>
<body><div class="prose">x</div><div class="prose prose-lg"><p>one<p>two <b>three<br>four</b></p></div><ul><li>1<li id=q class='c d'>2</ul><section><p>s1</p><p>s2</p></section></body></html>"""


def test_selectors():
    t = html.parse_html(PAGE)
    assert html.select_all(t, "div.prose.prose-lg p") == ["one", "two threefour"]
    assert html.select_all(t, "li:nth-child(2), li:first-of-type") == ["1", "2"]
    assert html.select_one(t, "li#q@class") == "c d"
    assert html.select_all(t, "section > p:not(.x)") == ["s1", "s2"]
    assert html.select_all(t, "body > p") == []
    assert html.select_all(t, "[class*='prose-']") == ["onetwo threefour"]
    with pytest.raises(ValueError):
        html.check_pack({"article": {"body": {"css": "p"}}})
    with pytest.raises(ValueError):
        html.compile_selector("p:hover")


def test_jsonld_and_extract(spark):
    objects = html.jsonld_objects(html.parse_html(PAGE))
    assert html.jsonld_value(objects, "author.name") == "RIGHT"
    assert html.jsonld_value(objects, "image") == "a.jpg"
    assert html.jsonld_value(objects, "headline") == "a b"
    assert html.jsonld_value(objects, "nothing.here") is None
    pack = {"article": {"body": "div.prose.prose-lg p", "author": "jsonld:author.name"}, "exclude": ["script", "b"]}
    got = spark.createDataFrame([(PAGE,), (None,), ("",)], "h string").select(html.extract(F.col("h"), pack).alias("e")).select("e.*").collect()
    assert tuple(got[0]) == ("one\n\ntwo", "RIGHT", None, None)
    assert [tuple(r) for r in got[1:]] == [("", None, None, None)] * 2
