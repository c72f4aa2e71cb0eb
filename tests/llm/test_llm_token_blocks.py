"""Files of token ids: the blocks by themselves, and whole tables against the tokenizer's own library."""

import zlib

import numpy as np
import pytest

from tallyworks.llm import token_blocks
from tallyworks.llm.queries import QUERIES, TOKENIZER, _tokenizer

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(_tokenizer(TOKENIZER))


@pytest.mark.parametrize("n", [0, 1, 33, 1024, 1025, 20_000])
@pytest.mark.parametrize("high", [1, 300, 50_257, 2**32])
def test_a_segment_gives_its_ids_back(n, high):
    random = np.random.default_rng(n + high)
    ids = np.where(random.random(n) < 0.03, random.integers(0, 2**32, n), random.integers(0, high, n)).astype(np.uint32)
    sizes = [n // 3, 0, n - n // 3]
    data = token_blocks.encode_segment(ids, [7, None, -2], sizes, 4, 9)
    (segment,) = token_blocks.segments(data + b"\n")
    assert (segment.shard, segment.first, segment.n_ids, segment.doc_ids) == (4, 9, n, [7, None, -2])
    found = list(segment.documents(lot=1500))
    assert [d for d, _, _ in found] == [7, None, -2] and [at for _, at, _ in found] == [9, 9 + sizes[0], 9 + sizes[0]]
    assert np.array_equal(np.concatenate([i for _, _, i in found]), ids)
    for begin, count in ((0, 1), (n // 2, 700), (n - 1, 5), (n, 3)):
        assert np.array_equal(segment.ids_at(begin, count), ids[begin : begin + count] if 0 <= begin < n else ids[:0])


def test_outliers_do_not_widen_a_block():
    ids = np.arange(1024, dtype=np.uint32) % 16 + 40_000
    narrow = len(token_blocks.encode_segment(ids, [1], [1024]))
    ids[[5, 900]] = 2**32 - 1
    assert len(token_blocks.encode_segment(ids, [1], [1024])) == narrow + 2 * 6
    assert len(token_blocks.encode_segment(ids, [1], [1024], percentile=100)) > narrow + 3000


def test_one_block_is_read_without_the_others():
    ids = np.arange(8 * 1024, dtype=np.uint32)
    data = bytearray(token_blocks.encode_segment(ids, [1], [len(ids)]))
    segment = next(token_blocks.segments(bytes(data)))
    begin = segment._at + int(segment.starts[5])
    data[begin:] = bytes(len(data) - begin)  # all blocks from the sixth on are lost
    left = next(token_blocks.segments(bytes(data)))
    assert np.array_equal(left.ids_at(3000, 2000), ids[3000:5000])


def _expected(rows, library):
    """rows (doc_id, text) in order -> doc_id, start, n_tokens, crc32."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def _found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_query_has_the_ids_of_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert _found(QUERIES["op11_token_blocks"](spark, SF_DIR)) == _expected([tuple(r) for r in docs], library)


def test_odd_rows(spark, library, tmp_path):
    long = "Long words and 12,345 numbers\n" * 20_000
    rows = [(3, "b"), (None, "no id"), (3, "b"), (1, None), (2, ""), (-5, "é\U0001f600 \x00 <|endoftext|> x"), (9, long), (None, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start long, segment long").repartition(3)
    path = str(tmp_path / "files")
    token_blocks.write_token_files(docs, path, _tokenizer(TOKENIZER), segment_ids=8)
    found = _found(token_blocks.read_digests(spark, path))
    assert [r[0] for r in found] == [None, None, -5, 1, 2, 3, 3, 9]
    texts = {-5: rows[5][1], 9: long, 3: "b"}
    nulls = ["no id", None] if found[0][2] > 1 else [None, "no id"]  # rows without id are in order of their digests
    assert found == _expected([(None, t) for t in nulls] + [(r[0], texts.get(r[0])) for r in found[2:]], library)
    ids = {(r["doc_id"], r["start"]): r["ids"] for r in token_blocks.read_token_files(spark, path).collect()}
    assert all(zlib.crc32(np.array(ids[r[0], r[1]], "<u4").tobytes()) == r[3] for r in found)


def test_one_id_for_many_rows_is_spread(spark, library, tmp_path):
    docs = spark.range(400).selectExpr("7L AS doc_id", "concat('text ', id % 5) AS text")
    path = str(tmp_path / "files")
    token_blocks.write_token_files(docs, path, _tokenizer(TOKENIZER))
    raw = token_blocks._documents(spark, path, "long", len)
    assert raw.select("shard").distinct().count() > 3
    found = _found(token_blocks.read_digests(spark, path))
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found])[:-1].tolist() and len(found) == 400


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "files")
    token_blocks.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, _tokenizer(TOKENIZER))
    assert token_blocks.read_token_files(spark, path).count() == 0
