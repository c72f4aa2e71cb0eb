"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a lexicon, how near its hits stand to the second person, and rates of capitals,
punctuation and obfuscation. The lexicon has a few plain insults and is otherwise learned: words, and beginnings of words,
that labelled toxic documents hold and others do not. For the trees, each half of the labelled sample gets its features from
the lexicon of the other half, so they learn how much a hit says of a text the lexicon has not seen; texts are scored with
the lexicon of the whole sample. A fifth of the sample is kept from the trees for the calibration.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.labelled import held_out, training_sample
from tallyworks.llm.words import Batch, batches
from tallyworks.session import cut_lineage

#: Labelled documents that are learned from, at most.
SAMPLE_ROWS = 8000
THRESHOLD = 0.3
#: Learned entries of the lexicon, at most.
LEXICON_SIZE = 4000
#: An entry must stand in more toxic documents than chance explains, by so many deviations, and in so large a share of them.
LEXICON_DEVIATIONS, LEXICON_SHARE = 3, 0.4
#: Lengths of the word beginnings that are learned besides whole words.
STEMS = (3, 4, 5, 6, 7, 8)
TREES, DEPTH = 20, 4
#: Rows below which the sample is not split.
LEAST_SPLIT = 400

#: Insults that need no learning, and words of the second person; fixed values.
INSULTS = frozenset(
    "asshole bastard bitch clown cretin disgusting dumb dumbass fool idiot idiota idiote idioten imbecile imbécil imbécile jerk loser moron pathetic pendejo "
    "salaud scum scumbag shit stupid stupide stupido trash trottel vermin worthless".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr sie tu te toi ton tes vous votre vos tú usted ustedes vosotros".split())

_WORD = re.compile(r"[^\W_]+")
#: Begins with a whole run of letters: from inside a run nothing else would be found, but every letter of a long one be tried.
_OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]+(?:[0-9@$*!]+[^\W\d_]+)+")
_PLAIN = str.maketrans("0134578@$!", "oieastbasi", "*")
#: What ``known`` holds for a word of the second person.
_PERSON = -1.0
#: Words that a Python worker remembers the weight of.
_REMEMBERED = 100_000

FEATURES = (
    "n_words hits hit_rate weight weight_rate top_weight distinct_hits insults second_person near_second capitals shouted exclaims punctuation "
    "obfuscated obfuscated_hits drawn_out".split()
)


@dataclass
class Lexicon:
    """Log odds of toxic against other documents, by word or word beginning (with a ``*``)."""

    weights: dict[str, float]

    def __post_init__(self) -> None:
        self.heads = {entry.rstrip("*")[: STEMS[0]] for entry in [*self.weights, *INSULTS]}

    def weigh(self, word: str) -> float:
        if word[: STEMS[0]] not in self.heads:
            return 0.0
        found = max((self.weights.get(word[:n] + "*", 0.0) for n in STEMS if len(word) >= n), default=0.0)
        return max(found, self.weights.get(word, 0.0), 3.0 if word in INSULTS else 0.0)


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """Entries counted in documents (text, label), not occurrences; those that tell most are kept."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    stems = [F.transform(F.filter(words, lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    entries = sample.select("label", F.explode(F.array_distinct(F.concat(words, *stems))).alias("entry"))
    counted = entries.groupBy("entry").agg(F.sum("label").alias("toxic"), F.count("*").alias("docs"))
    toxic, docs = sample.agg(F.sum("label"), F.count("*")).first()
    toxic, others = toxic or 0, docs - (toxic or 0)
    by_chance = F.col("docs") * (toxic / max(docs, 1))
    beyond = (F.col("toxic") - by_chance) / F.sqrt(by_chance + 1)
    telling = counted.where((beyond >= LEXICON_DEVIATIONS) & (F.col("toxic") >= LEXICON_SHARE * F.col("docs")))
    found = telling.orderBy(beyond.desc(), "entry").limit(size).collect()
    return Lexicon({r.entry: math.log((r.toxic + 0.5) / (toxic + 1)) - math.log((r.docs - r.toxic + 0.5) / (others + 1)) for r in found})


def _flags(low: int, high: int, but: str = "") -> np.ndarray:
    table = np.zeros(256, bool)
    table[low:high] = True
    table[[ord(c) for c in but]] = False
    return table


_UPPER = _flags(65, 91)
_LETTER = _UPPER | _flags(97, 123) | _flags(128, 256)
_MASKING = np.isin(np.arange(256), [ord(c) for c in "0123456789@$*!"])
_EXCLAIM = _flags(33, 34)
_MARKS = _flags(33, 48) | _flags(58, 65) | _flags(91, 97) | _flags(123, 127)


def text_features(texts: list[str | None], lexicon: Lexicon, known: dict[str, float]) -> np.ndarray:
    """One row of ``FEATURES`` for each text; zeros for a text without words. ``known`` remembers weights between calls."""
    batch = Batch.of(texts)
    data, size = batch.data, np.maximum(batch.end - batch.start, 1)
    letter, upper, masking = _LETTER[data], _UPPER[data], _MASKING[data]
    drawn, shouted, masked = np.zeros_like(letter), np.zeros_like(letter), np.zeros_like(letter)
    drawn[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    shouted[1:] = upper[1:] & upper[:-1]
    masked[1:] = masking[1:] & letter[:-1]
    flags = {"letter": letter, "up": upper, "shout": shouted, "drawn": drawn, "masked": masked, "exclaim": _EXCLAIM[data], "mark": _MARKS[data]}
    rates = {n: batch.count(t, batch.start, batch.end) for n, t in flags.items()}
    rows = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        words = _WORD.findall(text.lower()) if text else []
        if not words:
            continue
        n = len(words)
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = lexicon.weigh(w) or (_PERSON if w in SECOND_PERSON else 0.0)
        weights = np.fromiter(map(known.__getitem__, words), float, n)
        persons, hits = np.flatnonzero(weights == _PERSON), np.flatnonzero(weights > 0)
        total, top, insults, distinct, near = 0.0, 0.0, 0, 0, 0.0
        if len(hits):
            hit_words = [words[h] for h in hits.tolist()]
            total, top = float(weights[hits].sum()), float(weights[hits].max())
            insults, distinct = sum(w in INSULTS for w in hit_words), len(set(hit_words))
            if len(persons):
                at = np.searchsorted(persons, hits)
                gap = np.minimum(np.abs(persons[np.minimum(at, len(persons) - 1)] - hits), np.abs(persons[np.maximum(at - 1, 0)] - hits))
                near = float((1 / (1 + gap)).max())
        obfuscated = _OBFUSCATED.findall(text) if rates["masked"][i] else []
        letters = max(rates["letter"][i], 1)
        rows[i] = (
            math.log1p(n), math.log1p(len(hits)), 100 * len(hits) / n, math.log1p(total), 100 * total / n, top, math.log1p(distinct),
            math.log1p(insults), 100 * len(persons) / n, near, rates["up"][i] / letters, rates["shout"][i] / letters,
            100 * rates["exclaim"][i] / size[i], 100 * rates["mark"][i] / size[i], 100 * len(obfuscated) / n,
            sum(lexicon.weigh(m.lower().translate(_PLAIN)) > 0 for m in obfuscated), 100 * rates["drawn"][i] / size[i],
        )
    return rows


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "features") -> DataFrame:
    """All columns of ``docs`` and the vector of features of the text. Only the text goes to Python."""

    @F.pandas_udf("array<double>")
    def found(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for column in series:
            texts = [t if isinstance(t, str) else None for t in column]
            yield pd.Series([row for part in batches(texts) for row in text_features(texts[part], lexicon, known)], dtype=object)

    # taken for random, lest a filter on what follows makes Spark evaluate it once more
    return docs.withColumn(name, array_to_vector(found.asNondeterministic()(F.col(text).cast("string"))))


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel
    curve: IsotonicRegressionModel


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of a bounded sample of labelled documents, or none if the sample lacks one of the labels."""
    sample = cut_lineage(training_sample(docs, labels, target, sample_rows))
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    split = min(counts.values()) * 10 >= LEAST_SPLIT
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(10))
    halves = [(sample, sample)]
    if split:
        odd, even = (sample.where(fold % 2 == side) for side in (1, 0))
        halves = [(odd, even), (even, odd)]
    ready = None
    for learnt, other in halves:
        found = with_features(other, learn_lexicon(learnt)).select("label", fold.alias("fold"), "features")
        ready = found if ready is None else ready.unionByName(found)
    ready = cut_lineage(ready).withColumn("label", F.col("label").cast("double"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1).fit(ready.where("fold < 8") if split else ready)
    raw = trees.transform(ready.where("fold >= 8") if split else ready).select("label", vector_to_array("probability")[1].alias("raw"))
    # equal scores are one point with a weight; their rows would all meet in one task otherwise
    points = raw.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(points)
    return Model(learn_lexicon(sample), trees, curve)


def with_score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the calibrated probability of label 1; 0 for all without a model.

    The columns ``features``, ``rawPrediction``, ``probability``, ``prediction`` and ``raw`` of ``docs``, if any, get out of the
    way meanwhile.
    """
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    own = docs.select(F.struct("*").alias("own"), F.col(text).alias("text"))
    raw = model.trees.transform(with_features(own, model.lexicon)).select("own", vector_to_array("probability")[1].alias("raw"))
    found = model.curve.transform(raw).select("own", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("found"))
    return found.select("own.*", F.col("found").alias(name))


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= ``threshold``) for every row and its whole text.

    A null or empty text has features of zero and with them a score like any other. Null ids stay and are not held out,
    repeated rows stay repeated, an empty table gives an empty one. Only doc_id and text are read, other columns may have
    any name.
    """
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
