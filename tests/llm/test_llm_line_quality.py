"""Labels of single lines, and the quality of a document from them."""

import itertools
import math
import zlib

import numpy as np
import pytest

from tallyworks.llm import quality_lines

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").where("quality in (0, 1) and text is not null").orderBy("doc_id").select("doc_id", "text", "quality").collect()
    held = lambda r: zlib.crc32(str(r.doc_id).encode()) % 4 == 2
    return [r for r in rows if not held(r)], [r for r in rows if held(r)]


@pytest.fixture(scope="module")
def model(labelled):
    return quality_lines.fit([r.text for r in labelled[0]], np.array([r.quality for r in labelled[0]], float))


def test_lines_of_mixed_documents_get_their_own_labels(labelled, model):
    texts, labels = [r.text for r in labelled[1]], np.array([r.quality for r in labelled[1]], float)
    made, first, first_lines = quality_lines._mixed(texts, labels)
    right = total = both = 0
    for text, kind, n in zip(made, first, first_lines, strict=True):
        good = quality_lines.line_marginals(text, model) >= 0.5
        truth = np.array([kind] * n + [1 - kind] * (len(good) - n), bool)
        right, total, both = right + (good == truth).sum(), total + len(good), both + (0 < good.sum() < len(good))
    assert total > 3000 and right >= 0.9 * total and both >= 0.6 * len(made)


def test_documents_are_still_told_apart(labelled, model):
    scores = np.concatenate([quality_lines.score([r.text for r in labelled[1][i : i + 100]], model) for i in range(0, len(labelled[1]), 100)])
    truth = np.array([r.quality for r in labelled[1]])
    assert ((scores >= 0.7) == truth).mean() >= 0.99 and (scores[truth == 1] >= 0.7).mean() >= 0.99


def test_truth_of_lines():
    texts = ["a\nb\n\nc", "x", "one\ntwo\nthree", "p\n \nq\nr"]
    labels = np.array([1.0, 0.0, 1.0, 0.0])
    made, first, first_lines = quality_lines._mixed(texts, labels, 0.5)
    assert made == ["x\n\nc", "a\nb\nx"] and first == [0, 1] and first_lines == [1, 2]
    lines = quality_lines._all_lines(texts + made)
    assert quality_lines._truth(lines, labels, first, first_lines).tolist() == [1, 1, 1, 0, 1, 1, 1, 0, 0, 0] + [0, 1] + [1, 1, 0]
    assert quality_lines._mixed(["a", "b"], np.array([1.0, 1.0])) == ([], [], [])


def test_gradient_and_quality_by_enumeration():
    """All labellings of short documents: the gradient of their likelihood by differences, and the weighted marginals."""
    texts = ["Good line here.\nBAD %% 11\nanother one", "x\ny y\nz", "single"]
    lines = quality_lines.line_features(texts)
    random = np.random.default_rng(3)
    width = lines.features.shape[1]
    x = random.normal(0, 0.4, width + 4)
    truth = random.integers(0, 2, len(lines.owner)).astype(float)

    def weigh(x, labels, at):
        emit = sum(lines.features[i] @ x[:width] * labels[k] for k, i in enumerate(at))
        return emit + sum(x[width + 2 * int(a) + int(b)] for a, b in zip(labels, labels[1:], strict=False))

    def likelihood(x):
        total = 0.0
        for doc in range(len(texts)):
            at = np.flatnonzero(lines.owner == doc).tolist()
            every = [weigh(x, ys, at) for ys in itertools.product((0, 1), repeat=len(at))]
            total += weigh(x, truth[at].tolist(), at) - math.log(sum(map(math.exp, every)))
        return total

    good, pairs = quality_lines.forward_backward(lines.features @ x[:width], lines.owner, lines.texts, x[width:].reshape(2, 2))
    seen = np.zeros((2, 2))
    for i in np.flatnonzero(lines.owner[1:] == lines.owner[:-1]):
        seen[int(truth[i]), int(truth[i + 1])] += 1
    gradient = np.concatenate([lines.features.T @ (truth - good), (seen - pairs).ravel()])
    steps = np.eye(width + 4) * 1e-5
    assert gradient == pytest.approx([(likelihood(x + s) - likelihood(x - s)) / 2e-5 for s in steps], abs=1e-4)
    model = quality_lines.Model(x[:width], x[width:].reshape(2, 2), 1.0, 0.0)
    means = [np.average(good[lines.owner == d], weights=[len(t) for t in texts[d].split("\n")]) for d in range(3)]
    assert quality_lines.document_quality(lines, model) == pytest.approx([math.log(m / (1 - m)) for m in means])
