"""Document quality from a linear-chain conditional random field over its lines.

Every line is good or bad. Its features are measures of the line itself and of the lines before and after it; a transition
weight for each pair of neighbouring labels says how good and bad lines follow each other. In training a line has the label of
its document, and documents are also put together from the beginning of a good and the end of a bad one, or the other way round:
from these the chain learns that labels change, and that a line is to be told by itself and its neighbours. Forward-backward gives each line's probability of being good, and their mean, weighted by length, is the quality
of the document; one logistic curve over that mean turns it into a probability.

Documents of a batch advance together, line by line, as arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.labelled import held_out, training_sample
from tallyworks.llm.words import Batch, batches

#: Labelled documents that are learned from, at most.
SAMPLE_ROWS = 3000
THRESHOLD = 0.7
ROUNDS = 150
LEARNING_RATE = 0.1
DECAY = 1e-3
#: Mixed documents to learn from, as a share of the others.
MIXED_SHARE = 1.0
_WORD = re.compile(r"[^\x20\x09-\x0D]")


def _flags(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode("latin-1"))] = True
    return table


_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = True
_DIGIT = _flags("0123456789")
_MARK = _flags("#*$%&|<>{}[]\\^~=+@_/")
_SHOUT = _flags("!?")
_STOP = _flags(".,;:")
FEATURES = 11


@dataclass
class Lines:
    """Lines of a batch of texts: those with a word, in order."""

    features: np.ndarray  # own, previous and next measures, and a constant
    owner: np.ndarray
    weight: np.ndarray  # bytes
    texts: int


def line_features(texts: list[str | None]) -> Lines:
    """Measures of every line that holds a word."""
    batch = Batch.of(texts)
    prefix = batch.prefix()
    begin, after, _ = batch.words()
    line_end = np.flatnonzero(batch.data == 0x0A)
    line_begin = np.concatenate([[0], line_end[:-1] + 1]).astype(np.int64) if len(line_end) else line_end
    low, high = np.searchsorted(begin, line_begin), np.searchsorted(begin, line_end)
    filled = high > low
    line_begin, line_end, low, high = line_begin[filled], line_end[filled], low[filled], high[filled]
    owner = np.searchsorted(batch.start, line_begin, "right") - 1
    size, words = (line_end - line_begin).astype(float), (high - low).astype(float)

    hashes = batch.hashes(begin, after, prefix)
    line_of = np.repeat(np.arange(len(low)), high - low)
    order = np.lexsort((hashes, line_of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][fresh], minlength=len(low))
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    letters = np.maximum(batch.count(_LETTER[batch.data], line_begin, line_end), 1)
    rate = lambda table: batch.count(table[batch.data], line_begin, line_end) / size
    own = np.stack(
        [
            np.log1p(size) / 5,
            np.minimum((size - words + 1) / words, 40) / 10,
            batch.count(_UPPER[batch.data], line_begin, line_end) / letters,
            letters / size,
            rate(_DIGIT),
            np.minimum(rate(_MARK) * 5, 2),
            np.minimum(rate(_SHOUT) * 5, 2),
            np.minimum(rate(_STOP) * 5, 2),
            distinct / words,
            np.bincount(line_of, weights=echo, minlength=len(low)) / words,
            np.ones(len(low)),
        ],
        axis=1,
    ) if len(low) else np.zeros((0, FEATURES))
    before, following = np.zeros_like(own), np.zeros_like(own)
    same = owner[1:] == owner[:-1]
    before[1:][same] = own[:-1][same]
    following[:-1][same] = own[1:][same]
    return Lines(np.hstack([own, before, following]), owner, size, len(batch))


@dataclass
class Model:
    weights: np.ndarray  # of the features, for good against bad
    follow: np.ndarray  # 2 x 2, from the label of a line to that of the next
    slope: float
    shift: float


def _ranks(owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts by falling number of lines, these numbers, and where the lines of each begin."""
    count = np.bincount(owner, minlength=texts)
    order = np.argsort(-count, kind="stable")
    begin = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64) if texts else count
    return order, count[order], begin[order]


def _soft(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(scores: np.ndarray, owner: np.ndarray, texts: int, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for each line, and the expected counts of label pairs, given scores for good against bad."""
    emit = np.stack([np.zeros_like(scores), scores], axis=1)
    order, count, begin = _ranks(owner, texts)
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    longest = int(count[0]) if texts else 0
    active = np.searchsorted(-count, -np.arange(longest), "left")  # texts with more lines than step
    for step in range(longest):
        at = begin[: active[step]] + step
        ahead[at] = emit[at] if step == 0 else emit[at] + _soft(ahead[at - 1][:, :, None] + follow, 1)
    for step in range(longest - 2, -1, -1):
        at = begin[: active[step + 1]] + step
        back[at] = _soft(follow + (emit[at + 1] + back[at + 1])[:, None, :], 2)
    joint = ahead + back
    good = 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -500, 500)))
    pairs = np.zeros((2, 2))
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    if len(inner):
        both = ahead[inner][:, :, None] + follow + (emit[inner + 1] + back[inner + 1])[:, None, :]
        both = np.exp(both - _soft(both.reshape(len(inner), 4), 1)[:, None, None])
        pairs = both.sum(axis=0)
    return good, pairs


def document_quality(lines: Lines, model: Model) -> np.ndarray:
    """Length-weighted mean of the marginals as log odds; a text without lines counts as one bad line."""
    good, _ = forward_backward(lines.features @ model.weights, lines.owner, lines.texts, model.follow)
    weight = np.bincount(lines.owner, weights=lines.weight, minlength=lines.texts)
    mean = np.bincount(lines.owner, weights=good * lines.weight, minlength=lines.texts) / np.maximum(weight, 1)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def _ascend(start: np.ndarray, gradient, rounds: int) -> np.ndarray:
    """Adam on a concave function."""
    x, first, second = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, rounds + 1):
        g = gradient(x)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        x += LEARNING_RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return x


def _all_lines(texts: list[str]) -> Lines:
    """The lines of many texts, measured batch by batch."""
    parts = [(part, line_features(texts[part])) for part in batches(texts)]
    joined = [np.concatenate(x) for x in zip(*[(p.features, p.owner + part.start, p.weight) for part, p in parts], strict=True)]
    return Lines(*joined, len(texts))


def _mixed(texts: list[str], labels: np.ndarray, share: float = MIXED_SHARE) -> tuple[list[str], list[int], list[int]]:
    """Documents made of the first lines of one and the last lines of another with the other label: texts, the label of the
    first part, and how many lines with a word it has. Halves are cut between lines."""
    kinds = [[t.split("\n") for t, label in zip(texts, labels, strict=True) if label == kind and t] for kind in (0, 1)]
    made, first, lines = [], [], []
    if not all(kinds):
        return made, first, lines
    for i in range(int(share * len(texts))):
        kind = i % 2
        head, tail = kinds[kind][i // 2 % len(kinds[kind])], kinds[1 - kind][i // 2 % len(kinds[1 - kind])]
        head, tail = head[: (len(head) + 1) // 2], tail[len(tail) // 2 :]
        made.append("\n".join(head + tail))
        first.append(kind)
        lines.append(sum(bool(_WORD.search(line)) for line in head))
    return made, first, lines


def _truth(lines: Lines, labels: np.ndarray, first: list[int], first_lines: list[int]) -> np.ndarray:
    """The label of every line: that of its document, and of its part in a mixed one, which come behind the others."""
    place = np.arange(len(lines.owner)) - np.searchsorted(lines.owner, lines.owner)
    plain = len(labels)
    of_first = np.concatenate([labels, np.array(first, float)])[lines.owner]
    beyond = place >= np.concatenate([np.full(plain, len(place) + 1), np.array(first_lines, np.int64)])[lines.owner]
    return np.where(beyond, 1 - of_first, of_first)


def fit(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Maximum likelihood of the line labels given the texts, then of the document labels given their quality."""
    made, first, first_lines = _mixed(texts, labels)
    alone = _all_lines(texts)
    lines = _all_lines(texts + made) if made else alone
    truth = _truth(lines, labels, first, first_lines)
    same = lines.owner[1:] == lines.owner[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[:-1][same].astype(int), truth[1:][same].astype(int)), 1)
    n, width = max(len(truth), 1), lines.features.shape[1]

    def line_gradient(x: np.ndarray) -> np.ndarray:
        good, pairs = forward_backward(lines.features @ x[:width], lines.owner, lines.texts, x[width:].reshape(2, 2))
        return np.concatenate([lines.features.T @ (truth - good), (seen - pairs).ravel()]) / n - DECAY * x

    x = _ascend(np.zeros(width + 4), line_gradient, rounds)
    model = Model(x[:width], x[width:].reshape(2, 2), 1.0, 0.0)
    quality = document_quality(alone, model) / 5

    def curve_gradient(x: np.ndarray) -> np.ndarray:
        miss = labels - 1 / (1 + np.exp(-np.clip(x[0] * quality + x[1], -500, 500)))
        return np.array([(miss * quality).mean(), miss.mean()]) - DECAY * x

    slope, shift = _ascend(np.array([1.0, 0.0]), curve_gradient, 300)
    return Model(model.weights, model.follow, slope / 5, shift)


def line_marginals(text: str, model: Model) -> np.ndarray:
    """Probability of good for each line of a text that holds a word."""
    lines = line_features([text])
    return forward_backward(lines.features @ model.weights, lines.owner, lines.texts, model.follow)[0]


def score(texts: list[str | None], model: Model) -> np.ndarray:
    """Probability of label 1 of each text."""
    quality = document_quality(line_features(texts), model)
    return 1 / (1 + np.exp(-np.clip(model.slope * quality + model.shift, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of a bounded sample of labelled documents, or none if the sample lacks one of the labels."""
    sample = training_sample(docs, labels, target, sample_rows).orderBy("doc_id").toPandas()
    if sample["label"].nunique() < 2:
        return None
    return fit(sample["text"].tolist(), sample["label"].to_numpy(float))


def with_score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1; 0.5 for all without a model. Only the text goes to Python."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))

    @F.pandas_udf("double")
    def scored(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in series:
            texts = [t if isinstance(t, str) else None for t in column]
            yield pd.Series(np.concatenate([np.empty(0), *[score(texts[part], model) for part in batches(texts)]]))

    # taken for random, lest a filter on the score makes Spark evaluate it once more
    return docs.withColumn(name, scored.asNondeterministic()(F.col(text).cast("string")))


def classify(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= ``threshold``) for every row and its whole text.

    A null or empty text counts as one bad line, so it has a score like any other. Null ids stay and are not held out,
    repeated rows stay repeated, an empty table gives an empty one. Only doc_id and text are read, other columns may
    have any name.
    """
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
