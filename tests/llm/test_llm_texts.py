"""Operators over texts, against brute force on small fixtures, and what they do with odd rows."""

import collections
import html
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from tallyworks.llm import html_blocks, near_dups, packing, passages, pieces, repetition
from tallyworks.llm.components import components
from tallyworks.llm.words import Batch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RANDOM = random.Random(5)
VOCABULARY = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(400)]


def prose(n, random_=RANDOM):
    return " ".join(random_.choice(VOCABULARY) for _ in range(n))


def edited(text, changes, random_=RANDOM):
    words = text.split(" ")
    for _ in range(changes):
        words[random_.randrange(len(words))] = f"new{random_.randrange(10**6)}"
    return " ".join(words)


BASE, OTHER = prose(200), prose(120)
PASSAGE = prose(60)
ODD = [None, "", " \n\t ", "one", "two words", "Émile  ça\u00a0va", "x" * 50_000, "a b c " * 4000, "\u2028\x00 nul"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [BASE, BASE.upper(), edited(BASE, 2), edited(BASE, 3), edited(BASE, 9), edited(BASE, 40), OTHER, OTHER + " more", *ODD]
    texts += [f"{prose(30)} {PASSAGE} {prose(40)}" for _ in range(4)]
    rows = [(i, t, "en", "s", 1, 2.0) for i, t in enumerate(texts)]
    rows += [rows[0], (None, "no id at all", None, None, None, None)]
    # names that the operators use inside must not clash
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, rep string, key int, component double")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else ({tuple(words)} if words else set())


def brute_components(texts, percent=85):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in texts}


def test_near_duplicates_are_those_of_brute_force(docs):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(docs).collect()}
    assert found == brute_components(texts_of(docs))
    assert {r.doc_id for r in near_dups.near_duplicates(docs).where("kept").collect()} == {i for i, (_, c) in found.items() if i == c}


def test_near_duplicates_between_stars(spark):
    """A chain of copies around a hub, and outliers of it, so that links are found only between components."""
    random_ = random.Random(11)
    hub = prose(150, random_)
    texts = {0: hub}
    for i in range(1, 60):
        texts[i] = edited(texts[random_.randrange(i)] if i % 3 else hub, random_.randrange(1, 9), random_)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(table).collect()}
    assert found == brute_components(texts)


def test_near_duplicates_of_nothing(empty):
    assert near_dups.near_duplicates(empty).count() == 0
    with pytest.raises(ValueError):
        near_dups.near_duplicates(empty, percent=80)


def test_signatures_within_the_distance_share_a_key(spark):
    random_ = np.random.default_rng(3)
    for _ in range(300):
        a = random_.integers(0, 2**16, near_dups.POSITIONS)
        b = a.copy()
        b[random_.choice(near_dups.POSITIONS, near_dups.MAX_DISTANCE, replace=False)] += 1
        errors = (a != b).reshape(near_dups.CHUNKS, near_dups.CHUNK).sum(axis=1)
        assert errors.min() <= 1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passages_stay_once(docs):
    found = {r.doc_id: r for r in passages.dedupe_passages(docs.where("doc_id is not null")).collect()}
    texts = texts_of(docs)
    first = next(i for i, t in texts.items() if t and PASSAGE in t)
    assert PASSAGE in found[first].text
    for i, text in texts.items():
        kept, at = "", 0
        for a, b in zip(found[i].span_starts, found[i].span_ends, strict=True):
            kept, at = kept + text[at:a], b
        assert found[i].text == (None if text is None else kept + text[at:])
        if text and PASSAGE in text and i != first:
            inner = " ".join(PASSAGE.split(" ")[15:45])
            assert inner not in found[i].text and found[i].removed_words >= 30
            assert found[i].text[:80] == text[:80] and found[i].text[-100:] == text[-100:]
    assert found[0].removed_words == found[6].removed_words == found[10].removed_words == 0


def test_passages_are_cut_alike_wherever_they_stand():
    for lead in ("", "x ", prose(17) + " ", prose(80) + "\n"):
        batch, begin, after, _, at, until, digests = passages._chunks([lead + PASSAGE + " " + prose(9)])
        if not lead:
            known = set(digests.tolist())
        else:
            assert len(known & set(digests.tolist())) >= 4
    assert len(passages._chunks(["a b c"])[6]) == 1 and len(passages._chunks([None, ""])[6]) == 0


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(BASE.encode(), np.uint8)
    h, rolled = 0, []
    for byte in data.tolist():
        h = ((h << 2) + int(passages._GEAR[byte])) % 2**32
        rolled.append(h)
    assert passages.gear_hashes(data, np.array([0])).tolist() == rolled
    assert passages.gear_hashes(np.concatenate([data[7:30], data]), np.array([0, 23])).tolist()[23:] == rolled


def test_passages_of_odd_rows(docs, empty):
    assert passages.dedupe_passages(empty).count() == 0
    lone = [r for r in passages.dedupe_passages(docs).collect() if r.doc_id is None]
    assert [r.text for r in lone] == ["no id at all"]


def test_repetition_against_brute_force(docs):
    for row in repetition.judge(docs).collect():
        text = texts_of(docs).get(row.doc_id, "no id at all") or ""
        words = WORD.findall(text)
        if len(words) > 3000:
            assert not row.kept
            continue
        longest = np.zeros(len(words), int)
        for n in range(1, len(words)):
            counts = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
            again = [i for i in range(len(words) - n + 1) if counts[tuple(words[i : i + n])] > 1]
            if not again:
                break
            longest[again] = n
        cover = lambda least: len({k for i, n in enumerate(longest) if n >= least for k in range(i, i + n)})
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (row.n_words, row.word_chars, row.n_symbols) == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"))
        assert (row.n_dup_lines, row.n_repeat_words, row.n_covered_words) == (len(lines) - len(set(lines)), cover(3), cover(5))
        assert row.longest_repeat == max(longest, default=0)
        assert row.base_failed == (len(words) < 50 or 100 * cover(3) > 50 * len(words))
    assert repetition.judge(docs.limit(0)).count() == 0


def test_repeated_spans():
    assert repetition.repeated(["a b c d e x a b c d e", None, "", "q q q q q q q"], 5) == [[(0, 5), (6, 11)], [], [], [(0, 7)]]


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_packing_keeps_every_id_once(docs, tokenizer):
    from tokenizers import Tokenizer

    code = Tokenizer.from_file(tokenizer)
    rows = packing.pack(docs, tokenizer, group_pieces=6, with_ids=True).collect()
    found = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.length <= 2048
        found[r.doc_id].append(r)
    for doc_id, text in texts_of(docs).items():
        ids = [*code.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(found[doc_id], key=lambda r: r.start)[:: 2 if doc_id == 0 else 1]  # row 0 stands there twice
        assert [i for r in parts for i in r.ids] == ids and {r.doc_tokens for r in parts} == {len(ids)}
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(docs.limit(0), tokenizer).count() == 0


def test_best_fit_decreasing_against_a_plain_search():
    random_ = np.random.default_rng(2)
    for window in (16, 64, 2048):
        lengths = random_.integers(1, window + 1, 500)
        number, offset = packing.best_fit_decreasing(lengths, window)
        rooms = []
        for size in sorted(lengths.tolist(), reverse=True):
            fitting = [r for r in rooms if r >= size]
            if fitting:
                rooms[rooms.index(min(fitting))] -= size
            else:
                rooms.append(window - size)
        used = np.bincount(number, weights=lengths)
        assert sorted(window - used) == sorted(rooms)
        assert (offset + lengths <= window).all()
    assert packing.padding(np.array([2048, 1024, 1000, 1]), 2048) == 1048


def test_encoder_follows_the_library(tokenizer):
    from tokenizers import Tokenizer

    code, mine = Tokenizer.from_file(tokenizer), packing.Encoder(tokenizer)
    for text in ["a  b c", " lead", "x \n y", "<|endoftext|> x", "don't", "日本 語", BASE, "\x00", "1a.. ,b"]:
        assert mine.encode(text).tolist() == code.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def model():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_are_those_of_the_library(model, docs):
    import sentencepiece

    library, mine = sentencepiece.SentencePieceProcessor(model_file=model), pieces.load(model)
    for text in [*filter(None, texts_of(docs).values()), "  two  spaces ", "<0x41> <unk>", "🙂 x", "...,,,", "aaaa aa"]:
        ids = mine.encode([text])[0]
        assert ids.tolist() == library.encode(text)
        assert mine.decode(ids) == text


def test_pieces_round_trip_through_tables(model, docs, empty):
    texts = texts_of(docs)
    decoded = pieces.decode(pieces.encode(docs.where("doc_id is not null"), model), model)
    assert {r.doc_id: r.text for r in decoded.collect()} == texts
    digests = pieces.encoded_digests(docs, model).collect()
    assert all(r.round_trip for r in digests) and len(digests) == docs.count()
    assert pieces.encode(empty, model).count() == pieces.encoded_digests(empty, model).count() == 0


def test_unigram_pieces_have_the_largest_sum():
    table = [("▁", -2.5), ("a", -2.0), ("b", -2.25), ("ab", -3.0), ("▁a", -3.5), ("ba", -4.75), ("bab", -5.5), ("▁ab", -4.125)]
    mine = pieces.Pieces(None, "unigram", table, bytes_from=100)
    scores = dict(table)

    def best(word):
        if not word:
            return 0.0
        return max(scores[p] + best(word[len(p) :]) for p in scores if word.startswith(p))

    random_ = random.Random(1)
    for _ in range(200):
        text = "".join(random_.choice("ab") for _ in range(random_.randrange(1, 12)))
        ids = mine.encode([text])[0].tolist()
        assert sum(table[i][1] for i in ids) == pytest.approx(best("▁" + text)) and "".join(table[i][0] for i in ids) == "▁" + text
    assert mine.decode(mine.encode(["aé b"])[0]) == "aé b"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><p>Site name and a long line about what this site is</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this now, it is very cheap and very good.</div>
%s<h1>Head &amp; line</h1><p><b>First   para</b>graph<br>second&nbsp;line<p>Sh.</p><ul><li>one</li><li>two</li></ul><p>Last &lt;p&gt;</p>%s
<aside>Other stories to read</aside><div id="comments"><p>A reader says many words here</p></div>
<form><input><button>Send</button></form><footer>&copy; 2020 everybody</footer>"""
ARTICLE = "Head & line\nFirst paragraph\nsecond line\nSh.\none\ntwo\nLast <p>"


def test_main_text():
    for tag in ("article", "main", "div"):
        assert html_blocks.main_text(PAGE % (f"<{tag}>", f"</{tag}>")) == ARTICLE
    for page in (None, "", "<p></p>", "<nav>menu</nav>", "<script>x"):
        assert html_blocks.main_text(page) == ""
    assert html_blocks.main_text("<article>" + "<p>ab" * 20_000).count("\n") == 19_999
    assert html_blocks.main_text("plain text & more") == "plain text & more"


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE % ("<article>", "</article>"), 3), (None, None, None, None), (1, "u", "", 3)], "page_id long, url string, html string, text int")
    rows = html_blocks.extract(pages).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in rows] == [(1, "u", ARTICLE, len(ARTICLE)), (None, None, "", 0), (1, "u", "", 0)]
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_pages_of_the_table_give_their_articles(spark):
    for row in html_blocks.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert row.text == "\n".join(filter(None, blocks))


def test_word_hashes_do_not_depend_on_the_place():
    a, b = Batch.of(["one two", "two three"]), Batch.of(["x" * 1000 + " two"])
    (fa, aa, _), (fb, ab, _) = a.words(), b.words()
    assert a.hashes(fa, aa)[1] == a.hashes(fa, aa)[2] == b.hashes(fb, ab)[1] != a.hashes(fa, aa)[0]


def test_pieces_follow_each_other_as_merging_says_and_pairs_are_found_without_a_loop():
    draw = random.Random(3)
    for _ in range(60):
        vocabulary = {c: 0.0 for c in "abc"} | {"".join(draw.choices("abc", k=draw.randint(2, 5))): -float(draw.randint(1, 4)) for _ in range(12)}
        made = pieces.Pieces(None, "bpe", list(vocabulary.items()), bytes_from=100)
        for a in [-1, -2, *made.text]:
            for b, text in made.text.items():
                before = [] if a < 0 else [made.text[a]]
                assert made._follows(a, b) == (made.merged("".join(before) + text) == [*before, text])
    made.encode(["abcab cabba"])
    made.pairs.clear()
    made.words.clear()
    again = made.encode(["abcab cabba"])[0]
    assert not made.pairs and made.decode(again) == "abcab cabba"
