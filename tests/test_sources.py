import pytest
from pyspark.sql import functions as F

from tallyworks.functions.text import unescape_html
from tallyworks.operators.nesting import nest
from tallyworks.sources import attribute_rows, corpus, delimited, sinks, synthetic


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_attribute_rows(spark, tmp_path):
    path = write(
        tmp_path / "rows.xml",
        [
            '<?xml version="1.0" encoding="utf-8"?>',
            "<users>",
            '  <row Id="1" Location="Boston MA" Text="a &quot;b&quot; Id=" Score="7" />',
            '  <row Id="2" Id="3" Location="" Score="bad" />',
            '  <row Score="" />',
            "</users>",
        ],
    )
    fields = {"Id": "bigint", "Location": "string", "Text": "string", "Score": "int"}
    rows = attribute_rows.read_attribute_rows(spark, path)
    raw = attribute_rows.project_fields(rows, fields).collect()
    assert [tuple(r) for r in raw] == [(1, "Boston MA", "a &quot;b&quot; Id=", 7), (3, "", None, None), (None, None, None, None)]
    clean = attribute_rows.project_fields(rows, fields, unescape=unescape_html).first()
    assert clean["Text"] == 'a "b" Id='


def test_row_text_is_read_back(spark):
    data = [(1, 'q " < & > \' \n é', None), (2, "", "x")]
    df = spark.createDataFrame(data, "Id int, Text string, Other string")
    lines = df.select(attribute_rows.attribute_row(df.columns).alias("value"))
    assert "\n" not in lines.first()["value"] and 'Other="' not in lines.first()["value"]
    parsed = lines.withColumn("attributes", attribute_rows.parse_attributes("value"))
    back = attribute_rows.project_fields(parsed, {"Id": "int", "Text": "string", "Other": "string"}, unescape=unescape_html)
    assert sorted(map(tuple, back.collect())) == data
    elements = lines.select(attribute_rows.parse_elements("value", ["Id", "Text"]).alias("r")).select("r.*")
    assert sorted(map(tuple, elements.collect())) == [("1", data[0][1]), ("2", "")]


def test_broken_element_is_null(spark):
    df = spark.createDataFrame([('<row Id="1" ',), ('<row Id="2"/>',)], "value string")
    found = df.select(attribute_rows.parse_elements("value", ["Id"]).alias("r")).select("r.Id").collect()
    assert [r[0] for r in found] == [None, "2"]


def test_nested_element(spark):
    parents = spark.createDataFrame([(1, "t&amp;x"), (2, "u")], "Id int, Title string")
    children = spark.createDataFrame([(1, "b"), (1, "a")], "PostId int, Text string")
    nested = nest(parents, children, "Id", "PostId", ["PostId", "Text"])
    xml = attribute_rows.nested_element("post", ["Id", "Title"], "children", "comments", ["Text"], escaped=True)
    assert [r[0] for r in nested.orderBy("Id").select(xml).collect()] == [
        '<post Id="1" Title="t&amp;x"><comments Text="a"/><comments Text="b"/></post>',
        '<post Id="2" Title="u"/>',
    ]


def test_delimited(spark, tmp_path):
    path = write(tmp_path / "hr.csv", ["level,hours,sales,salary", '0.5,100,"a"b,low', "x,7", "0.1,1,s,high,extra", ",,,"])
    fields = {"level": "double", "hours": "int", "sales": "string", "salary": "string"}
    found = delimited.read_delimited(spark, path, fields).collect()
    assert [tuple(r) for r in found] == [
        (0.5, 100, '"a"b', "low"),
        (None, 7, None, None),
        (0.1, 1, "s", "high"),
        (None, None, None, None),
    ]


def test_delimited_name_with_comma_free_columns(spark, tmp_path):
    path = write(tmp_path / "draws.csv", ["Year,Round,1,Bonus", "2010,1,5,7"])
    row = delimited.read_delimited(spark, path, {"Year": "int", "Round": "int", "1": "int", "Bonus": "int"}).first()
    assert tuple(row) == (2010, 1, 5, 7)


def test_corpus(spark, tmp_path):
    for name, text in (("a.txt", "one two\none"), ("b.txt", "two"), ("empty.txt", "")):
        (tmp_path / name).write_text(text)
    lines = corpus.read_corpus(spark, str(tmp_path))
    assert lines.count() == 3 and lines.select("path").distinct().count() == 2
    assert corpus.corpus_size(spark, str(tmp_path)) == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 3)], "bin string, n int")
    binned = str(tmp_path / "bins")
    for _ in range(2):  # the second run overwrites the first
        sinks.write_bins(df, binned, "bin")
    assert sorted(map(tuple, spark.read.parquet(binned).select("bin", "n").collect()), key=str) == [("a", 1), ("a", 3), ("b", None)]
    sinks.write_pairs(df, str(tmp_path / "pairs"), ["bin", "n"])
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "pairs")).collect()) == ["a\t1", "a\t3", "b\t"]
    sinks.write_named({"x": df, "y": df.limit(1)}, str(tmp_path / "named"))
    assert spark.read.parquet(str(tmp_path / "named" / "x")).count() == 3


def test_synthetic_ranges(spark):
    words = spark.createDataFrame([(w,) for w in ("red", "green", "blue")], "w string")
    cities = spark.createDataFrame([("Oslo",), ("Rome",)], "c string")
    comments = synthetic.synthetic_comments(spark, 400, words, "w", tasks=3, seed=5)
    again = synthetic.synthetic_comments(spark, 400, words, "w", tasks=3, seed=5)
    rows = comments.collect()
    assert rows == again.collect() and len(rows) == 400
    assert all(0 <= r.Score < 15_000 and 0 <= r.UserId < 1_000_000 for r in rows)
    lengths = {len(r.Text.split(" ")) for r in rows}
    assert min(lengths) == 1 and max(lengths) == 30
    assert {w for r in rows for w in r.Text.split(" ")} == {"red", "green", "blue"}
    users = synthetic.synthetic_users(spark, 300, words, "w", cities, "c", seed=5).collect()
    assert {r.Location for r in users} == {"Oslo", "Rome"}
    assert all(1 <= len(r.DisplayName) <= 30 and set(r.DisplayName) <= set(synthetic.LETTERS) for r in users)
    assert len({r.Id for r in users}) > 290


def test_synthetic_word_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(synthetic, "fits_broadcast", lambda df, size: False)
    words = spark.createDataFrame([("red",)], "w string")
    with pytest.raises(ValueError):
        synthetic.synthetic_comments(spark, 10, words, "w")


def test_sources_feed_the_operators(spark, tmp_path):
    from tallyworks.operators.counting import class_count

    path = write(tmp_path / "u.xml", ['<row Id="1" Location="Austin TX" />', '<row Id="2" Location="" />', "<users>"])
    rows = attribute_rows.read_attribute_rows(spark, path)
    users = attribute_rows.project_fields(rows, {"Id": "int", "Location": "string"})
    assert {tuple(r) for r in class_count(users, F.col("Location")).collect()} == {("TX", 1), ("NullOrEmpty", 1)}
