"""URL filter: stated rules first, then gradient-boosted trees over lexical features.

All is built-in column functions and Spark's own tree learner; no Python runs on the executors. The trees learn from URLs with a
known verdict. Of the features, the suffix statistics come from the same labelled sample: how often the last label of a host,
and its last two, stand in it, and what share of them is blocked, smoothed towards the share of all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.session import broadcast_if_small, cut_lineage

#: Labelled URLs that are learned from, at most; also the bound of the suffix statistics that are broadcast.
SAMPLE_ROWS = 10_000
TREES, DEPTH = 10, 4
#: Labelled URLs that the share of all counts as, in the share of a suffix.
SMOOTHING = 20.0

ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = (
    "url_length host_length path_length query_length host_labels path_depth digit_ratio host_digit_ratio hyphens entropy params longest_label has_fragment secure".split()
)
FEATURES = [*LEXICAL, "last_count", "last_share", "last_two_count", "last_two_share"]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for a null url or one without."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for a null url or one without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does.

    A rule is a verdict and a host with a path, such as ``("block", "example.org/es/")``. It fits its host and all
    subdomains, if the path begins with its path. Of equally long rules the first in the list wins.
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    count = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / F.length(c)
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(letters, F.lit(0.0), lambda sum_, c: sum_ - count(c) / size * F.log2(count(c) / size))


def _digits(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", ""))


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.translate(text, mark, ""))


def with_lexical(urls: DataFrame) -> DataFrame:
    """The columns given (url among them) with host, path and the lexical features; a null url has those of an empty one."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    share = lambda part, whole: part / F.greatest(F.length(whole), F.lit(1))
    values = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "query_length": F.length(query),
        "host_labels": _occurrences(host, "."),
        "path_depth": _occurrences(path, "/"),
        "digit_ratio": share(_digits(url), url),
        "host_digit_ratio": share(_digits(host), host),
        "hyphens": _occurrences(host, "-"),
        "entropy": _entropy(url),
        "params": _occurrences(query, "="),
        "longest_label": F.coalesce(F.array_max(F.transform(F.split(host, r"\."), F.length)), F.lit(0)),
        "has_fragment": (F.locate("#", url) > 0).cast("int"),
        "secure": url.startswith("https:").cast("int"),
    }
    named = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return named.withColumns({k: v.cast("double") for k, v in values.items()})


@dataclass
class Model:
    trees: GBTClassificationModel | None
    suffixes: DataFrame  # suffix, n, share
    share: float  # of blocked ones among the labelled URLs


def _suffix(labels: int) -> Column:
    return F.substring_index("host", ".", -labels)


def _featured(urls: DataFrame, model: Model) -> DataFrame:
    table = with_lexical(urls)
    for labels, name in ((1, "last"), (2, "last_two")):
        known = model.suffixes.select(F.col("suffix").alias(f"{name}_suffix"), F.col("n").alias(f"{name}_count"), F.col("share").alias(f"{name}_share"))
        table = table.join(known, _suffix(labels) == F.col(f"{name}_suffix"), "left").fillna({f"{name}_count": 0.0, f"{name}_share": model.share})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from rows (url, blocked 0 or 1). Every different URL counts once, however often it stands there.

    The suffix statistics cover all labelled URLs; of these at most ``sample_rows``, taken by hash of the url, are what the trees
    learn from. Without URLs of both kinds there are no trees and the share of blocked URLs alone decides.
    """
    usable = labelled.where(F.col("url").isNotNull() & F.col("blocked").isin(0, 1)).select("url", F.col("blocked").cast("double").alias("label"))
    urls = cut_lineage(usable.distinct())
    sample = cut_lineage(urls.orderBy(F.xxhash64("url"), "url", "label").limit(sample_rows))
    seen = urls.agg(F.count("*").alias("n"), F.avg("label").alias("share")).first()
    share = seen["share"] or 0.0
    mixed = 0 < (sample.agg(F.avg("label")).first()[0] or 0.0) < 1
    hosts = urls.withColumn("host", host_of(F.col("url")))
    suffixes = hosts.select("label", F.explode(F.array_distinct(F.array(_suffix(1), _suffix(2)))).alias("suffix")).groupBy("suffix")
    smoothed = (F.sum("label") + SMOOTHING * share) / (F.count("*") + SMOOTHING)
    known = cut_lineage(suffixes.agg(F.count("*").cast("double").alias("n"), smoothed.alias("share")))
    model = Model(None, broadcast_if_small(known), share)
    if mixed:
        ready = cut_lineage(_featured(sample, model).select("features", "label"))
        model.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(ready)
    return model


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """page_id, host, path, rule and verdict of every row (page_id, url).

    The longest fitting rule decides (see ``matching_rule``); for the rest the trees do. ``labelled`` (url, blocked) is what
    they learn from; without it, the URLs of ``pages`` that a rule decides. A null url, or one without ``://``, has an
    empty host and path, fits no rule and gets a verdict by its features. Null ids stay, repeated rows stay repeated, an
    empty table gives an empty one. Only page_id and url are read, other columns may have any name.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rule, decided = matching_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    ruled = pages.withColumn("rule", rule).withColumn("decided", decided)
    if labelled is None:
        labelled = ruled.where("decided is not null").select("url", (F.col("decided") == BLOCK).cast("int").alias("blocked"))
    model = train(labelled, sample_rows)
    if model.trees is None:
        verdict = F.lit(BLOCK if model.share > 0.5 else ALLOW)
        scored = with_lexical(ruled)
    else:
        scored = model.trees.transform(_featured(ruled, model))
        verdict = F.when(F.col("prediction") == 1.0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", verdict).alias("verdict"))
