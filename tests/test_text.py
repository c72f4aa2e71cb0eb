import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.functions import classify, moments, text


def one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "s string")
    return frame.select(expression("s").alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (None, None),
        ("plain", "plain"),
        ("a &amp; b", "a & b"),
        ("&amp;lt;", "&lt;"),
        ("&#65;&#x42;&#X43;", "ABC"),
        ("&eacute;&nbsp;&copy;", "é ©"),
        ("&foo; &bar", "&foo; &bar"),
        ("&&amp;&", "&&&"),
        ("&a&lt;", "&a<"),
        ("&#128512;", "&#128512;"),
        ("&#xD800;", "?"),
        ("&#99999999999;", "&#99999999999;"),
        ("&;&#;&#x;", "&;&#;&#x;"),
        ("line\n&quot;two&quot;", 'line\n"two"'),
    ],
)
def test_unescape(spark, raw, expected):
    assert one(spark, raw, text.unescape_html) == expected


def test_unescape_knows_every_name(spark):
    from html.entities import name2codepoint

    names = sorted(name2codepoint)
    frame = spark.createDataFrame([(f"&{name};",) for name in names], "s string")
    found = [row[0] for row in frame.select(text.unescape_html("s")).collect()]
    assert found == [chr(name2codepoint[name]) for name in names]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab &;#l1<\"'", max_size=30), min_size=1, max_size=40))
def test_escape_is_undone(spark, texts):
    frame = spark.createDataFrame([(html.escape(t),) for t in texts], "s string")
    assert [r[0] for r in frame.select(text.unescape_html("s")).collect()] == texts


def test_letter_tokens(spark):
    tokens = one(spark, "Can't STOP&amp;go, élan 42 -- x&#65;y &foo;", text.letter_tokens)
    assert tokens == ["cant", "stop", "go", "lan", "xAy", "foo"]
    again = one(spark, "&#65;bc", lambda c: text.letter_tokens(c, lower_again=True))
    assert again == ["abc"]
    assert one(spark, "1234 '' !", text.letter_tokens) == []


def test_raw_tokens_keep_case_and_inner_blanks(spark):
    tokens = one(spark, "Don't  foo.bar\tfoo.bar (X) 12 '", text.raw_tokens)
    assert tokens == ["Dont", "foo bar", " X ", "  "]


def test_stopword_tokens(spark):
    frame = spark.createDataFrame([("The can't\tTHE  a.b",)], "s string")
    assert {r[0] for r in text.stopword_tokens(frame, "s").collect()} == {"the", "cant", "a.b"}


@pytest.mark.parametrize(
    "body, expected",
    [
        ('see "http://w.org/a#x" and "http://w.org/b"', "http://w.org/a"),
        ('see "http://w.org/b"', "http://w.org/b"),
        ('open "http://w.org/b', None),
        ("none", None),
        ('x "http://w.org" y', "http://w.org"),
    ],
)
def test_first_link(spark, body, expected):
    assert one(spark, body, lambda c: text.first_link(c, "http://w.org")) == expected


def test_tags(spark):
    assert one(spark, "&lt;SQL&gt;&lt;etl&gt;", text.tag_list) == ["sql", "etl"]


@pytest.mark.parametrize(
    "place, expected",
    [
        ("Boston MA", "MA"),
        ("boston ma ny", "MA"),
        ("Boston, MA,", "Unknown"),
        ("Paris", "Unknown"),
        (" ", "Unknown"),
        ("", "NullOrEmpty"),
        (None, "NullOrEmpty"),
    ],
)
def test_place_class(spark, place, expected):
    assert one(spark, place, classify.place_class) == expected


def test_coded_and_moments(spark):
    codes = {"low": 0.0, "high": 100.0}
    assert [one(spark, v, lambda c: classify.coded(c, codes)) for v in ("low", "high", "odd", None)] == [0.0, 100.0, None, None]
    assert str(one(spark, "2011-05-01T23:10:00.125", moments.parse_moment)) == "2011-05-01 23:10:00.125000"
    assert one(spark, "yesterday", moments.parse_moment) is None
    assert one(spark, "2011-05-01T23:10:00.125", moments.day_text) == "2011-05-01"
    assert one(spark, "2011-05-01", moments.day_text) == "2011-05-01"
    assert one(spark, "2011-05-01T23:10:00.125", lambda c: moments.format_moment(moments.parse_moment(c))) == "2011-05-01T23:10:00.125"
    assert one(spark, "2011-05-01T00:10:00.000", lambda c: F.hour(moments.parse_moment(c))) == 0


def test_moments_do_not_pass_through_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # an hour that clocks there skipped
        assert str(one(spark, "2014-03-09T02:30:00.000", moments.parse_moment)) == "2014-03-09 02:30:00"
        assert one(spark, "2014-03-09", moments.parse_moment) is None
        assert one(spark, "2014-13-09T02:30:00.000", moments.parse_moment) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
