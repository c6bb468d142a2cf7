import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import urls

VALID = {
    "http://a.com": "com.a>>o>/",
    "https://WWW.B.com/Path?Q=1#f": "com.b>.www>s>/Path?Q=1#f",
    "http://c.co.uk:8080/x": "uk.co.c>>o8080>/x",
    "https://m.d.com.au:443/": "au.com.d>.m>s>/",
    "  http://e.org?q  ": "org.e>>o>?q",
    "http://192.0.2.77/y": "192.0.2.77>>o>/y",
    "http://x.y.100zone.blogspot.com/": "com.blogspot.100zone>.y.x>o>/",
    "http://a_b.com/": "com.a_b>>o>/",
}
INVALID = ["http://", "ftp://a.com/x", "a.com/x", "/rel", "http://test", "http://co.uk/", "http://a-.com/", "http://a..com/", "http://a.1com/", "http://a b.com/", "http://a.com:x/", "http://a.com:/", "http://a.com/>x", "http://ab@example.com/", "http:/a.b", "", None, "http://256.1.1.1/"]


@pytest.fixture(scope="module")
def keys(spark):
    df = spark.createDataFrame([(u,) for u in [*VALID, *INVALID]], "url string")
    return {r.url: r.uri for r in urls.keyed(df, "url").collect()}


@pytest.mark.parametrize("url", VALID)
def test_valid(keys, url):
    assert keys[url] == VALID[url]


@pytest.mark.parametrize("url", INVALID)
def test_invalid(keys, url):
    assert keys[url] is None


def test_own_suffixes(spark):
    df = spark.createDataFrame([("http://a.b.zz/",), ("http://q.w.yy/",), ("http://w.yy/",)], "url string")
    rules = spark.createDataFrame([("exact", "zz"), ("under", "yy")], "kind string, suffix string")
    assert {r.url: r.uri for r in urls.keyed(df, "url", suffixes=rules).collect()} == {"http://a.b.zz/": "zz.b>.a>o>/", "http://q.w.yy/": "yy.w.q>>o>/", "http://w.yy/": None}


def test_key_round_trip(spark):
    df = spark.createDataFrame([(k,) for k in VALID.values()], "uri string").withColumn("u", urls.from_key(F.col("uri")))
    for r in df.select("uri", urls.key_of(F.col("u"), F.col("u.domain")).alias("again"), urls.address_of(F.col("u")).alias("url")).collect():
        assert r.again == r.uri


@pytest.mark.parametrize("key", ["a>b>c", "a>b>x>/", "a>b>o>/>", "a>b>oq>/"])
def test_bad_keys(spark, key):
    assert spark.createDataFrame([(key,)], "k string").select(urls.from_key(F.col("k")).alias("u")).first().u is None


def test_reverse_host(spark):
    df = spark.createDataFrame([("a.b.com", "com.b.a"), ("a.com.", "com.a."), ("x", "x")], "h string, want string")
    assert df.where(urls.reverse_host(F.col("h")) != F.col("want")).count() == 0


def test_is_image(spark):
    df = spark.createDataFrame([("/a.JPG", True), ("/a.jpg?x", False), ("/a b.png", False), ("/gif", False), ("/x.bmp", True)], "p string, want boolean")
    assert df.where(urls.is_image(F.col("p")) != F.col("want")).count() == 0


def code(n: int) -> str:
    """The encoding written byte by byte."""
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    out = b""
    for b in bytes([len(raw)]) + raw:
        out += bytes([1, b + 1]) if b < 2 else bytes([b])
    return bytes(255 - b for b in out).hex() + "ff"


def test_rev_encode_goldens(spark):
    assert [code(n) for n in (0, 1, 2)] == ["fefeff", "fefdfefdff", "fefdfdff"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2**62), min_size=1, max_size=40))
def test_rev_encode(spark, ns):
    rows = spark.createDataFrame([(n,) for n in [*ns, 0, 255, 256, 257, 65536]], "n long").select("n", urls.rev_encode(F.col("n")).alias("c")).distinct().collect()
    assert all(r.c == code(r.n) for r in rows)
    assert [r.n for r in sorted(rows, key=lambda r: r.c)] == sorted((r.n for r in rows), reverse=True)


def test_byte_escaped(spark):
    df = spark.createDataFrame([("a\\\té~",), ("",), (None,)], "x string")
    assert [r.y for r in df.select(urls.byte_escaped(F.col("x")).alias("y")).collect()] == ["a\\x5c\\x09\\xc3\\xa9~", "", None]
