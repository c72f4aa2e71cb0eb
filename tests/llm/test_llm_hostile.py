"""Texts, pages and tables made to break or slow down an operator."""

import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from tallyworks.llm import html_blocks, toxicity, url_trees
from tallyworks.llm.pieces import Pieces

PARAGRAPH = "A paragraph of the article, with enough words in it to be one."


@pytest.mark.parametrize("broken", ["<![foo", "<![", "<![0]", "<![^", "<![if IE]>", "<![CDATA[x", "<!", "<!-", "<!--", "<?", "</", "<a b='", "&#x110000;", "&#;", "<!doctype [", "<![endif]-->"])
def test_broken_declarations_end_no_job(broken):
    assert isinstance(html_blocks.main_text(broken), str)
    page = f"<body><div><p>{PARAGRAPH}</p>{broken}"
    assert html_blocks.main_text(page).startswith(PARAGRAPH)
    after = html_blocks.main_text(f"<body><div><p>{PARAGRAPH}</p><![if x]><p>{PARAGRAPH}</p>")
    assert after == f"{PARAGRAPH}\n{PARAGRAPH}"


def test_random_and_mutated_pages_give_texts(spark):
    r = random.Random(7)
    pages = [p.html for p in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect() if p.html]
    bits = ["<", "<!", "<![", "]]>", "<!--", "-->", "</", "/>", "&", "&#", ";", "<div>", "</div>", "<p", "<article>", "<main>", "a", " ", "\n", '"', "'", "\x00", "é", "<script>", "<td>", "=", "[", "<?x"]
    for _ in range(5000):
        assert isinstance(html_blocks.main_text("".join(r.choices(bits, k=r.randrange(30)))), str)
    for _ in range(500):
        page = r.choice(pages)
        for _ in range(r.randrange(1, 8)):
            at = r.randrange(len(page))
            page = page[:at] + r.choice(bits) + page[at + r.randrange(20) :]
        assert isinstance(html_blocks.main_text(page), str)


def test_nested_containers_take_memory_in_proportion():
    page = "<body>" + "<div>x" * 100_000
    tracemalloc.start()
    begin = time.perf_counter()
    assert html_blocks.main_text(page).count("x") == 100_000
    spent, (_, peak) = time.perf_counter() - begin, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 300e6 and spent < 60


def brute_stretches(lengths, window, surge):
    """Line by line: begin where a line has text and the window reaches the surge, end where the window is empty."""
    out, begin = [], None
    for i in range(len(lengths) + 1):
        ahead = sum(lengths[i : i + window])
        if begin is None and i < len(lengths) and lengths[i] and ahead >= surge:
            begin = i
        elif begin is not None and ahead == 0:
            out.append((begin, i))
            begin = None
    return out


@pytest.mark.parametrize("window, surge", [(3, 1), (2, 30), (5, 12), (1, 1)])
def test_surge_and_dive_line_by_line(window, surge):
    r = random.Random(window)
    for _ in range(300):
        lengths = [r.choice([0, 0, 0, 3, 10, 80]) for _ in range(r.randrange(0, 40))]
        assert html_blocks.text_stretches(np.array(lengths, np.int64), window, surge) == brute_stretches(lengths, window, surge)


def test_a_million_letters_are_read_in_moments():
    lexicon = toxicity.Lexicon({"fool": 2.0})
    text = "a" * 1_000_000 + "a1b " + "b" * 500_000 + "!"
    begin = time.perf_counter()
    features = dict(zip(toxicity.FEATURES, toxicity.text_features([text], lexicon, {})[0], strict=True))
    assert time.perf_counter() - begin < 2
    assert features["obfuscated"] > 0


def test_obfuscated_words_are_those_of_the_plain_pattern():
    plain = re.compile(r"[^\W\d_]+(?:[0-9@$*!]+[^\W\d_]+)+")
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choices("abé_1@$ *!-9", k=r.randrange(25)))
        assert toxicity._OBFUSCATED.findall(text) == plain.findall(text)


def test_copies_of_one_url_do_not_decide_for_others(spark):
    rules = [("allow", "org/"), ("block", "com/de/")]
    urls = [f"https://site{i}.example.org/page/{i}" for i in range(150)] + [f"http://ads{i}.example.com/de/{i}?a={i}&b=1" for i in range(150)]
    open_ = [f"http://ads{i}.example.net/de/{i}?a={i}&b=1" for i in range(40)]
    rows = [(i, u) for i, u in enumerate([*urls, *open_])]
    plain = spark.createDataFrame(rows, "page_id long, url string")
    hot = plain.union(spark.range(1000, 11_000).selectExpr("id", "'https://hot.example.org/one'"))
    verdicts = [{r.page_id: r.verdict for r in url_trees.judge(df, rules).where("page_id < 1000").collect()} for df in (plain, hot)]
    assert verdicts[0] == verdicts[1] and {verdicts[0][300 + i] for i in range(40)} == {"block"}


def test_suffix_statistics_cover_all_labelled_urls(spark):
    urls = [(f"http://a{i}.s{i % 400}.example/{i}", i % 2) for i in range(2000)]
    model = url_trees.train(spark.createDataFrame(urls, "url string, blocked int"), sample_rows=100)
    assert model.suffixes.where("suffix = 'example'").first()["n"] == 2000
    assert model.suffixes.count() == 401 and model.trees is not None


@pytest.fixture(scope="module")
def model_file():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _letters(r, n):
    return "".join(r.choices("abcdefghijklmnopqrstuvwxyzé", k=n))


def test_unspaced_and_long_words_have_the_pieces_of_the_library(model_file):
    import sentencepiece

    r = random.Random(11)
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=model_file), Pieces(model_file)
    texts = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(30_000)), "".join(chr(r.randrange(0x3041, 0x30FF)) for _ in range(3000))]
    texts += [_letters(r, n) for n in (12, 13, 64, 65, 700, 4000)] + ["ab" * 3000, "the" * 1500, " ".join(_letters(r, r.randrange(1, 90)) for _ in range(800)), "\U0001f600" * 500 + "x"]
    for _ in range(2):  # the second time from memory
        assert [f.tolist() for f in pieces.encode(texts)] == library.encode(texts)


def test_a_megabyte_without_spaces_is_no_trouble(model_file):
    r = random.Random(12)
    pieces = Pieces(model_file)
    text = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(350_000))
    begin = time.perf_counter()
    assert pieces.decode(pieces.encode([text])[0]) == text
    assert time.perf_counter() - begin < 10


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_words_are_cut_only_where_no_piece_lies(kind):
    names = ["▁", "a", "b", "c", "ab", "ca", "abab", "▁a"]
    pieces = Pieces(None, kind, [(p, -float(i)) for i, p in enumerate(names)], bytes_from=len(names))
    assert pieces._parts("abababab" * 2) == ["abababab" * 2]
    assert pieces._parts("ababababccccabab") == ["abababab", "c", "c", "c", "cabab"]
    word = "abcabbcaabccab" * 4
    whole = pieces._spelled(word, pieces.segment([word])[0])
    assert np.frombuffer(pieces._new([word])[word], np.int32).tolist() == whole.tolist()


def test_weighted_points_give_the_curve_of_their_rows(spark):
    from pyspark.ml.regression import IsotonicRegression
    from pyspark.sql import functions as F

    r = random.Random(13)
    scores = [r.choice([0.05, 0.05, 0.05, 0.2, 0.4, 0.7, r.random()]) for _ in range(600)]
    rows = spark.createDataFrame([(s, float(r.random() < s)) for s in scores], "raw double, label double")
    points = rows.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    plain = IsotonicRegression(featuresCol="raw").fit(rows)
    weighted = IsotonicRegression(featuresCol="raw", weightCol="weight").fit(points)
    for x in np.linspace(0, 1, 40).tolist():
        assert weighted.predict(x) == pytest.approx(plain.predict(x))
