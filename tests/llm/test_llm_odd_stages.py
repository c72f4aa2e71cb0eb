"""All five stages on odd rows: null ids, null and empty texts, ties, repeated rows, clashing names, empty tables."""

import random

import corpus_pipeline
import pytest

from tallyworks.llm import packing
from tallyworks.llm.queries import TOKENIZER, _tokenizer
from tallyworks.session import scratch_path

#: Names that stages and operators use inside.
NAMES = "toxicity_score quality_score deduped repeats_in repeated_places features rawPrediction probability prediction raw own key found kept component_id n_shingles piece known_id has_id pack_group part n of".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(f"word{r.randrange(3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, prose(80, 1)), (1, prose(80, 1)), (2, prose(80, 1)), (None, "no id"), (None, "no id"), (3, None), (4, ""), (5, " \n"), (6, prose(70, 6)), (6, prose(70, 7))]
    texts += [(7, f"{prose(60, 8)} {prose(60, 9)}"), (8, f"{prose(60, 9)} {prose(50, 10)}"), (9, "x" * 60_000), (10, "a b c " * 9000)]
    values = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"{n} int" for n in NAMES]])
    return spark.createDataFrame([(i, t, None, "s", None, *range(len(NAMES))) for i, t in texts], values)


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("labels"))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_a_stage_keeps_the_columns_and_their_values(spark, odd, labels_dir, stage):
    learned = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(odd, allowMissingColumns=True)
    docs = learned if stage[0] in ("toxicity", "quality classifier") else odd
    after = stage[1](spark, docs, labels_dir)
    assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
    rows = after.where("source = 's'").collect()
    assert rows and all(tuple(r[n] for n in NAMES) == tuple(range(len(NAMES))) for r in rows)
    none = stage[1](spark, docs.limit(0), labels_dir)
    assert none.count() == 0 and none.columns == docs.columns


def test_near_dedup_leaves_one_of_equal_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, odd, "").collect()]
    by_id = sorted(r[0] for r in rows if r[0] is not None)
    assert by_id == [1, 3, 4, 5, 6, 6, 7, 8, 9, 10] and [r for r in rows if r[0] is None] == [(None, "no id")] * 2


def test_passages_go_from_later_documents(spark, odd):
    rows = {(r.doc_id, r.text) for r in corpus_pipeline.cut_passages(spark, odd, "").collect()}
    (text,) = [t for i, t in rows if i == 8]
    assert len(text.split()) < 90 and prose(50, 10).split()[20] in text.split()
    assert (7, f"{prose(60, 8)} {prose(60, 9)}") in rows and (None, "no id") in rows


def test_every_document_is_packed(spark, odd):
    packed = corpus_pipeline.pack(spark, odd, "").collect()
    assert sorted(r.doc_id or 0 for r in packed if r.start == 0) == sorted(r.doc_id or 0 for r in odd.collect())
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)


def test_all_stages_in_a_row(spark, odd, labels_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(odd, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, "odd-stage")
        stage(spark, docs, labels_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    kept = sorted(r.doc_id or 0 for r in docs.select("doc_id").collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, labels_dir).where("start = 0").collect()
    assert sorted(r.doc_id or 0 for r in packed) == kept


def test_full_windows_and_copies_spread_over_groups(spark):
    long = "one two three four " * 3000
    docs = spark.createDataFrame([(7, long)] * 30 + [(7, "same")] * 40, "doc_id long, text string").repartition(3)
    rows = packing.pack(docs, _tokenizer(TOKENIZER), group_pieces=8).collect()
    full = [r.sequence_id for r in rows if r.length == 2048]
    assert len(set(full)) == len(full) == 30 * ((len(rows) - 70) // 30)
    rest = [r for r in rows if r.length < 2048]
    assert len({r.sequence_id for r in rest}) > 4 and not {r.sequence_id for r in rest} & set(full)


def test_ids_beyond_double_precision_stay_exact(spark):
    ids = [None, 2**53 + 1, 2**62 + 3, -(2**60) - 1]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in packing.pack(docs, _tokenizer(TOKENIZER)).collect()} == set(ids)
