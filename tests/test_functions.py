"""Column functions: cleaning, truncation, urls, language codes, wikitext, dates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from renown.functions import dates as D
from renown.functions import text as TX
from renown.functions import urls as U
from renown.functions.urls import canonical_query


def one(spark, col_fn, value, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_fn(F.col("v")).alias("o")).collect()[0].o


@pytest.mark.parametrize("raw,exp", [
    ("Tom &amp; Jerry &quot;hi&quot; &#39;x&apos; &#8220;q&#8221;", "Tom & Jerry \"hi\" 'x' “q”"),
    ("a  b", "a b"),
    ("line sep", "linesep"),
    ("é", "é"),
    ("keep\nnewline", "keep\nnewline"),
    ("  \t spaced   out \t ", "spaced out"),
    (None, ""),
])
def test_clean_str(spark, raw, exp):
    df = TX.clean_columns(spark.createDataFrame([(raw,)], "v string"), ["v"])
    assert df.collect()[0].v == exp


def test_truncate_levels(spark):
    sent = "word " * 200 + "end. " + "x" * 900
    out = one(spark, lambda c: TX.truncate_text(c, 1500), sent)
    assert out.endswith("end.") and len(out) <= 1500
    words = "word " * 400
    out2 = one(spark, lambda c: TX.truncate_text(c, 1500), words)
    assert len(out2) < 1500 and not out2.endswith(" ")
    solid = "y" * 2000
    assert len(one(spark, lambda c: TX.truncate_text(c, 1500), solid)) == 1500
    assert one(spark, lambda c: TX.truncate_text(c, 1500), "short") == "short"


@pytest.mark.parametrize("raw,exp", [
    ("en", "en"), ("EN-us", "en"), (" pt_BR ", "pt"), ("deu", "de"), ("rum", "ro"),
    ("English", "en"), ("klingon", None), ("", None), (None, None), ("xyz", None),
])
def test_language_code(spark, raw, exp):
    assert one(spark, TX.language_code, raw) == exp


@pytest.mark.parametrize("raw,exp", [
    ("https://Example.com/Path/?utm_source=x&a=1", "https://example.com/path?a=1"),
    ("https://example.com/path/", "https://example.com/path"),
    ("https://example.com/p#frag", "https://example.com/p"),
    ("https://example.com/p?b=2&a=1&b=3&fbclid=z", "https://example.com/p?b=2&b=3&a=1"),
    ("https://example.com/p?flag", "https://example.com/p?flag="),
    ("", ""),
])
def test_canonical_url(spark, raw, exp):
    assert one(spark, lambda c: U.canonical_url(c, False), raw) == exp


def test_canonical_url_keeps_fragment_when_asked(spark):
    assert one(spark, lambda c: U.canonical_url(c, True), "https://w/Talk:X#Sec") == "https://w/talk:x#sec"


def test_canonical_title_unicode(spark):
    assert one(spark, U.canonical_title, "  Ärger,  über   Ñandú!! ") == "ärger über ñandú"


@pytest.mark.parametrize("raw,exp", [
    ("x {{a}} y", "x  y"), ("{{a {{b}} c}}z", "z"), ("a }} b", "a }} b"), ("a {{ open", "a "),
])
def test_strip_templates(spark, raw, exp):
    assert one(spark, TX.strip_templates, raw) == exp


def test_clean_wikitext(spark):
    raw = "Hi [[Page|label]] and [[Plain]] '''bold''' <ref>cite</ref> ~~~~\n:: reply {{tmpl}}"
    assert one(spark, TX.clean_wikitext, raw) == "Hi label and Plain bold  \nreply"


@pytest.mark.parametrize("raw,exp", [
    ("2026-04-08T23:00:00-05:00", dt.date(2026, 4, 8)),
    ("20260408T120000Z", dt.date(2026, 4, 8)),
    ("April 8, 2026", dt.date(2026, 4, 8)),
    ("Apr 8, 2026", dt.date(2026, 4, 8)),
    ("2026/04/08", dt.date(2026, 4, 8)),
    ("04/08/2026", dt.date(2026, 4, 8)),
    ("25/04/2026", dt.date(2026, 4, 25)),
    ("08 Apr 26", dt.date(2026, 4, 8)),
    ("08 Apr 99", dt.date(1999, 4, 8)),
    ("2026-4-8", dt.date(2026, 4, 8)),
    ("Wed Apr 08 10:00:00 +0000 2026", dt.date(2026, 4, 8)),
    ("20260408120000", dt.date(2026, 4, 8)),
    ("2026-13-08", None),
    ("no date", None),
    ("Wed, 08 Apr 2026 10:00:00 +0200", dt.date(2026, 4, 8)),
    ("2026-02-30", None), ("garbage", None), (None, None),
])
def test_to_date(spark, raw, exp):
    assert one(spark, D.to_date, raw) == exp


def test_epoch_and_to_int(spark):
    assert one(spark, D.epoch_to_date, 1712345678.9, "v double") == dt.date(2024, 4, 5)
    assert one(spark, D.to_int, "12.5") is None
    assert one(spark, D.to_int, 12.9, "v double") == 12


def test_query_helpers(spark):
    df = spark.createDataFrame([("Elon Musk", "Tesla"), ("Emmanuel Macron", "Macron")], "t string, p string")
    got = [r.q for r in df.select(TX.build_query("t", "p").alias("q")).collect()]
    assert got == ["Elon Musk Tesla", "Macron"]
    assert one(spark, TX.target_slug, "Apple Inc. -- Europe") == "apple_inc_europe"
    assert one(spark, TX.query_to_hashtag, "elon musk!") == "ElonMusk"
    assert one(spark, TX.sanitize_gdelt_query, "AI of Go") == '"AI of Go"'


def test_canonical_query_fast_path_equals_exact_path(spark):
    import random
    rnd = random.Random(3)
    keys = ["a", "b", "utm_source", "ref", "x.y", "gclid", "source", "k-1", "refx", "_ga"]
    vals = ["", "1", "v~2", "z"]
    qs = set()
    for _ in range(1500):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            k, v = rnd.choice(keys), rnd.choice(vals)
            parts.append(k if rnd.random() < 0.2 else f"{k}={v}")
        qs.add("&".join(parts))
    df = spark.createDataFrame([(q,) for q in qs], "q string")
    simple = F.col("q").rlike(U._SIMPLE_QUERY_RE) & ~F.col("q").rlike(U._REPEATED_KEY_RE)
    out = df.where(simple).select(U.canonical_query(F.col("q")).alias("slow"),
                                  U._simple_canonical_query(F.col("q")).alias("fast"))
    assert out.count() > 500
    assert out.where(F.col("fast") != F.col("slow")).count() == 0


def test_query_codec_equals_form_decoding_and_encoding(spark):
    from urllib.parse import parse_qs, urlencode
    draw = random.Random(2)
    parts = ["a", "b", "=", "&", "%", "%c3", "%a9", "%zz", "+", " ", "é", "你", "%e4%bd", "%a0", "%ff", "/", "~", "*", "%25", "%2", "😀"]
    queries = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 9))) for _ in range(1500)] + ["a+%zz=1&a%20%zz=2"]
    got = spark.createDataFrame([(q,) for q in queries], "q string").select("q", canonical_query(F.col("q")).alias("o")).collect()
    assert [r.o for r in got] == [urlencode(parse_qs(r.q, keep_blank_values=True), doseq=True) for r in got]


def test_templates_are_stripped_in_linear_time(spark):
    import time
    text = "x {{a{{b}}}} y" * 40_000
    began = time.time()
    assert one(spark, TX.strip_templates, text) == "x  y" * 40_000
    assert time.time() - began < 10


def test_trims_every_white_space_character(spark):
    white = "".join(c for c in map(chr, range(0x3100)) if c.isspace())
    assert set(TX.PY_WS_CHARS) == set(white)
    assert one(spark, TX.py_strip, white + "a b" + white) == "a b"
