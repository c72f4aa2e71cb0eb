"""One query per operator over the driver's tables.

Each query reads whole tables. Roles: ``customer`` stands for users (balance = reputation, market
segment and nation = location), ``events`` for their comments, ``documents``, ``conversations`` and
``pages`` for texts, ``lineitem`` by order for baskets and for draws of numbers.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.functions.moments import format_moment, parse_moment
from tallyworks.functions.text import raw_tokens, unescape_html
from tallyworks.operators import (
    bloom,
    counting,
    filters,
    gaps,
    index,
    itemsets,
    joins,
    nesting,
    organize,
    summaries,
    topk,
)
from tallyworks.session import cut_lineage, scratch_path, spread
from tallyworks.sources import attribute_rows, corpus, delimited, sinks, synthetic

Query = Callable[[SparkSession, str], DataFrame]

#: Digits kept in results that are sums of floating-point numbers.
DIGITS = 6
MIN_BALANCE = 0.0
BLOOM_RATE = 0.01
PLACES = [f"NATION_{i}" for i in range(10)]
PRIORITIES = {"1-URGENT": 100.0, "2-HIGH": 75.0, "3-MEDIUM": 50.0, "5-LOW": 0.0}
BINS = {"en": "english-tag", "fr": "french-tag", "src1": "first-tag"}
#: Share of the baskets, in thousandths, an itemset must occur in.
SUPPORT_PER_MILLE = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table of texts, ahead of work on every word."""
    return spread(table(spark, sf_dir, name).select(*columns))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# -- word counts ---------------------------------------------------------------------------------


def word_count(spark, sf_dir):
    return counting.word_count(_texts(spark, sf_dir, "documents", "text"), "text")


def word_count_lines(spark, sf_dir):
    return counting.word_count(_texts(spark, sf_dir, "conversations", "text"), "text")


def word_count_pages(spark, sf_dir):
    return counting.word_count(_texts(spark, sf_dir, "pages", "html"), "html")


def word_count_top10(spark, sf_dir):
    return topk.top_words(_texts(spark, sf_dir, "documents", "text"), "text")


def word_count_stopwords(spark, sf_dir):
    return counting.word_count_split(_texts(spark, sf_dir, "documents", "text"), "text")


def listed_word_count(spark, sf_dir):
    return counting.listed_word_count(_texts(spark, sf_dir, "documents", "text"), "text")


def counter_report(spark, sf_dir):
    """Counters of the split word count: occurrences per stopword."""
    counts = counting.word_count_split(_texts(spark, sf_dir, "documents", "text"), "text")
    return counts.filter("is_stopword").select(F.lit("words").alias("counter_group"), F.col("word").alias("counter"), "n")


def word_count_without_stopwords(spark, sf_dir):
    documents, stop = _texts(spark, sf_dir, "documents", "text"), table(spark, sf_dir, "benchmark")
    return counting.word_count_without(documents, "text", stop, "text")


# -- summaries -----------------------------------------------------------------------------------


def min_max_count(spark, sf_dir):
    return summaries.min_max_count(table(spark, sf_dir, "events"), "user_id", "ts")


def _event_text():
    return F.concat_ws(" ", "event_type", "props")


def min_max_and_words(spark, sf_dir):
    events, stop = table(spark, sf_dir, "events"), table(spark, sf_dir, "benchmark")
    spans, words = summaries.min_max_and_words(events, "user_id", "ts", _event_text(), stop, "text")
    return spans.withColumn("result", F.lit("minmax")).unionByName(
        words.withColumn("result", F.lit("words")), allowMissingColumns=True
    )


def avg_by_hour(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return _rounded(summaries.average_by(events, F.hour("ts"), F.length("props"), name="hour"), "average")


def median_std_by_hour(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    result = summaries.median_and_deviation(events, F.hour("ts"), F.length("props"), name="hour")
    return _rounded(result, "stddev")


def median_std_value_by_hour(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    result = summaries.median_and_deviation(events, F.hour("ts"), F.col("value"), name="hour")
    return _rounded(result, "median", "stddev")


def multi_avg_by_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("customer_number", F.col("o_custkey").cast("double"))
    result = summaries.averages_by(
        orders, "o_orderstatus", ["o_totalprice", "customer_number"], "o_orderpriority", PRIORITIES
    )
    return _rounded(result, "avg_o_totalprice", "avg_customer_number", "avg_o_orderpriority")


def distinct_users(spark, sf_dir):
    return counting.distinct_values(table(spark, sf_dir, "events").withColumn("user", F.col("user_id").cast("string")), "user")


def distinct_users_sorted(spark, sf_dir):
    return counting.distinct_values(table(spark, sf_dir, "events"), "user_id", sort=True)


def unique_user_count(spark, sf_dir):
    return counting.distinct_count(table(spark, sf_dir, "events"), "user_id")


def _draws(spark, sf_dir):
    """Draws of numbers: two whole-number columns of the line items."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_linenumber").alias("line"), "l_orderkey"
    )


def value_frequency(spark, sf_dir):
    return counting.value_frequency(_draws(spark, sf_dir), ["quantity", "line"])


def position_frequency(spark, sf_dir):
    return counting.position_frequency(_draws(spark, sf_dir), ["quantity", "line"])


def relative_frequency(spark, sf_dir):
    return _rounded(counting.relative_frequency(_draws(spark, sf_dir), ["quantity", "line"]), "share")


def top10_frequency(spark, sf_dir):
    return topk.top_frequencies(_draws(spark, sf_dir), ["quantity", "line"])


def gap_rows(spark, sf_dir):
    return gaps.gaps(_draws(spark, sf_dir), "quantity", "l_orderkey")


def gap_stats(spark, sf_dir):
    result = gaps.gap_stats(_draws(spark, sf_dir), "quantity", "l_orderkey")
    return _rounded(result, "average", "stddev")


def gap_stats_users(spark, sf_dir):
    """Gaps in microseconds between the events of a user, counted from a fixed day."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint")
    minute = day * 1440 + F.hour("ts") * 60 + F.minute("ts")
    micros = minute * 60_000_000 + (F.extract(F.lit("SECOND"), "ts") * 1_000_000).cast("bigint")
    events = table(spark, sf_dir, "events").select("user_id", micros.alias("micros"))
    result = gaps.gap_stats(events, "user_id", "micros")
    # in seconds, since the mean of microseconds has no more digits than these in common with other engines
    return result.select(
        "user_id", "n", "last", "median", *[F.round(F.col(c) / 1e6, 3).alias(c) for c in ("average", "stddev")]
    )


def category_count(spark, sf_dir):
    return counting.count_by(table(spark, sf_dir, "customer"), "c_mktsegment")


def _people(spark, sf_dir):
    """Customers with a place: market segment and nation, none for those in debt."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    joined = joins.keyed_join(customer, nation, "c_nationkey", "n_nationkey")
    place = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat_ws(" ", "c_mktsegment", "n_name"))
    return joined.select("c_custkey", place.alias("place"))


def class_count(spark, sf_dir):
    return counting.class_count(_people(spark, sf_dir), "place", PLACES)


def word_count_by_state(spark, sf_dir):
    events = spread(table(spark, sf_dir, "events").select("user_id", _event_text().alias("text")))
    return joins.word_count_by_place(_people(spark, sf_dir), "c_custkey", "place", events, "user_id", "text", PLACES)


def word_count_by_state_bins(spark, sf_dir):
    """Words per place written to one folder per place and read back."""
    path = scratch_path(spark, "words-by-state")
    sinks.write_bins(word_count_by_state(spark, sf_dir), path, "state")
    return spark.read.parquet(path)


def named_outputs(spark, sf_dir):
    """Both results of the merged summary written under their names and read back."""
    path = scratch_path(spark, "named")
    events, stop = table(spark, sf_dir, "events"), table(spark, sf_dir, "benchmark")
    spans, words = summaries.min_max_and_words(events, "user_id", "ts", _event_text(), stop, "text")
    results = {"minmax": spans, "words": words}
    sinks.write_together(results, path)
    read = [sinks.read_together(spark, path, name, df.columns).withColumn("result", F.lit(name)) for name, df in results.items()]
    return read[0].unionByName(read[1], allowMissingColumns=True)


# -- joins ---------------------------------------------------------------------------------------


def _labels(spark, sf_dir):
    """Labelled documents; some have a conversation of their number."""
    return table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")


def _turns(spark, sf_dir):
    """Turns of conversations, several to a number; some numbers have no label."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")


def _comments(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


def _join(how: str) -> Query:
    def query(spark, sf_dir):
        return joins.keyed_join(_labels(spark, sf_dir), _turns(spark, sf_dir), "doc_id", "conv_id", how)

    query.__name__ = f"join_{how}"
    return query


def _replicated(how: str) -> Query:
    def query(spark, sf_dir):
        labels = _labels(spark, sf_dir)
        return joins.replicated_join(_turns(spark, sf_dir), labels, "conv_id", "doc_id", how, order=["quality", "toxic"])

    query.__name__ = f"broadcast_{how}"
    return query


def _ids(nested: DataFrame, keys: list[str], children: str, field: str) -> DataFrame:
    """Nested records in flat form: child count and the child ids."""
    return nested.select(
        *keys,
        "part",
        F.size(children).alias("n_children"),
        F.array_join(F.col(f"{children}.{field}").cast("array<string>"), " ").alias("child_ids"),
    )


def nest_children(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    nested = nesting.nest(orders, lines, "o_orderkey", "l_orderkey", ["l_partkey", "l_linenumber"])
    return _ids(nested, ["o_orderkey", "o_orderstatus"], "children", "l_partkey")


def nest_children_parts(spark, sf_dir):
    """The same in records of three children at most."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    nested = nesting.nest(orders, lines, "o_orderkey", "l_orderkey", ["l_partkey", "l_linenumber"], part_items=3)
    return _ids(nested, ["o_orderkey"], "children", "l_partkey")


def nest_self(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    nested = nesting.nest_by_role(turns, F.col("turn") == 0, "conv_id", "conv_id", ["turn", "role", "text"])
    return _ids(nested, ["conv_id", "role", "text"], "children", "turn")


def nested_xml(spark, sf_dir):
    """Nested records as one-line elements."""
    turns = table(spark, sf_dir, "conversations")
    nested = nesting.nest_by_role(turns, F.col("turn") == 0, "conv_id", "conv_id", ["turn", "text"])
    element = attribute_rows.nested_element("post", ["conv_id", "text"], "children", "comments", ["turn", "text"])
    return nested.select("conv_id", "part", element.alias("xml"))


def nested_xml_parts(spark, sf_dir):
    """The same in records of about a kilobyte of turns."""
    turns = table(spark, sf_dir, "conversations")
    nested = nesting.nest_by_role(turns, F.col("turn") == 0, "conv_id", "conv_id", ["turn", "text"], part_items=1024, part_bytes=1024)
    element = attribute_rows.nested_element("post", ["conv_id", "text"], "children", "comments", ["turn", "text"])
    return nested.select("conv_id", "part", element.alias("xml"))


def _bloom_join(both_sides: bool) -> Query:
    def query(spark, sf_dir):
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
        nested = bloom.bloom_nest(
            customer,
            "c_custkey",
            "c_acctbal",
            MIN_BALANCE,
            _comments(spark, sf_dir),
            "user_id",
            ["event_id", "event_type"],
            BLOOM_RATE,
            both_sides=both_sides,
        )
        return _ids(nested, ["c_custkey", "c_acctbal"], "children", "event_id")

    query.__name__ = "bloom_join_both" if both_sides else "bloom_join"
    return query


# -- filters -------------------------------------------------------------------------------------


def grep(spark, sf_dir):
    return filters.grep(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", r"(?s).*\. The [a-z]+ .*\n.*")


def contains(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.filter(filters.contains_text("text", "LICENSE"))


def threshold(spark, sf_dir):
    return filters.at_least(table(spark, sf_dir, "customer"), "c_acctbal", 1500.0)


def not_category(spark, sf_dir):
    return filters.not_category(table(spark, sf_dir, "events"), "event_type", "error")


def sample_percent(spark, sf_dir):
    return filters.sample_percent(table(spark, sf_dir, "lineitem"), 10.0, seed=7)


def sample_repeatable(spark, sf_dir):
    """A sample by hash, held against its table: that its size is likely, that it only holds rows of the table and those of
    the smaller sample, and that other tasks draw the same."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    drawn = filters.sample_repeatable(lines, 10.0, seed=7)
    again = filters.sample_repeatable(lines.repartition("l_orderkey", "l_partkey"), 10.0, seed=7)
    fewer = filters.sample_repeatable(lines, 2.0, seed=7)

    def size(df, name):
        return df.groupBy().agg(F.count("*").alias(name))

    sizes = [size(lines, "n"), size(drawn, "kept"), size(drawn.exceptAll(lines), "foreign"), size(fewer.exceptAll(drawn), "left_out"), size(drawn.exceptAll(again), "other")]
    whole = functools.reduce(DataFrame.crossJoin, sizes)  # one row each
    likely = F.abs(F.col("kept") - F.col("n") * 0.1) <= 5 * F.sqrt(F.col("n") * 0.09)
    return whole.select("n", likely.alias("likely"), (F.col("foreign") + F.col("left_out") == 0).alias("subset"), (F.col("other") == 0).alias("same"))


def _member_words(spark, sf_dir):
    """Words of the benchmark items in their own case."""
    items = table(spark, sf_dir, "benchmark")
    return items.select(F.explode(F.split("text", "[^a-zA-Z]+")).alias("member")).filter("member <> ''").distinct()


def bloom_build_probe_exact(spark, sf_dir):
    """Turns with a labelled number: filter first, then exact check by semi join."""
    labels = _labels(spark, sf_dir)
    passed = bloom.bloom_filter_keys(_turns(spark, sf_dir), "conv_id", labels, "doc_id", BLOOM_RATE)
    return passed.join(labels, F.col("conv_id") == F.col("doc_id"), "left_semi")


def bloom_key_filter(spark, sf_dir):
    """The filter alone, held against the members: how many turns have one, that none is lost, that few others pass."""
    turns, labels = _turns(spark, sf_dir), _labels(spark, sf_dir).select("doc_id").distinct()
    marked = turns.join(labels, F.col("conv_id") == F.col("doc_id"), "left").withColumn("member", F.col("doc_id").isNotNull())
    passed = bloom.bloom_filter_keys(marked, "conv_id", labels, "doc_id", BLOOM_RATE, exact=False)
    return _bloom_flags(marked, passed)


def bloom_key_filter_exact(spark, sf_dir):
    """The same with the semi join behind the filter: no other turn passes."""
    turns, labels = _turns(spark, sf_dir), _labels(spark, sf_dir).select("doc_id").distinct()
    marked = turns.join(labels, F.col("conv_id") == F.col("doc_id"), "left").withColumn("member", F.col("doc_id").isNotNull())
    passed = bloom.bloom_filter_keys(marked, "conv_id", labels, "doc_id", BLOOM_RATE)
    return _bloom_flags(marked, passed, rate=0.0)


def _bloom_flags(marked: DataFrame, passed: DataFrame, rate: float = BLOOM_RATE) -> DataFrame:
    counts = passed.groupBy().agg(F.count_if("member").alias("n_members"), F.count_if(~F.col("member")).alias("others"))
    whole = marked.groupBy().agg(F.count_if("member").alias("n"), F.count_if(~F.col("member")).alias("rest"))
    few = (F.col("others") <= 5 * rate * F.col("rest")).alias("few_others")
    return counts.crossJoin(whole).select("n_members", (F.col("n_members") == F.col("n")).alias("none_lost"), few)  # one row each


def bloom_token_filter(spark, sf_dir):
    documents = _texts(spark, sf_dir, "documents", "doc_id", "text")
    return bloom.bloom_filter_tokens(
        documents, "text", _member_words(spark, sf_dir), "member", BLOOM_RATE, exact_on=["doc_id"]
    ).select("doc_id", F.length("text").alias("chars"))


def bloom_token_filter_raw(spark, sf_dir):
    """The filter alone, with members read from a gzip list."""
    path = scratch_path(spark, "members")
    members = _member_words(spark, sf_dir)
    members.write.mode("overwrite").option("compression", "gzip").text(path)
    documents = _texts(spark, sf_dir, "documents", "doc_id", "text")
    return bloom.bloom_filter_tokens(documents, "text", spark.read.text(path), "value", BLOOM_RATE).select("doc_id")


def bloom_token_flags(spark, sf_dir):
    """The filter of a gzip list, written and read again: documents with a member, whether it loses none of them, and whether
    few of the foreign words pass it."""
    rate = BLOOM_RATE / 100
    path = scratch_path(spark, "members")
    _member_words(spark, sf_dir).write.option("compression", "gzip").text(path)
    members = spark.read.text(path)
    documents = _texts(spark, sf_dir, "documents", "doc_id", "text")
    # written once, for the filter alone is only asked about these
    found = scratch_path(spark, "found")
    bloom.bloom_filter_tokens(documents, "text", members, "value", rate, exact_on=["doc_id"]).write.parquet(found)
    exact = spark.read.parquet(found)
    passed = bloom.bloom_filter_tokens(spread(exact), "text", members, "value", rate)
    saved = scratch_path(spark, "bloom")
    bloom.blocked_bloom(members, "value", members.count(), rate).write(saved)
    words = documents.select(F.explode(raw_tokens("text")).alias("value")).distinct().join(members, "value", "left_anti")
    words = cut_lineage(words)
    foreign = bloom.read_bloom(spark, saved).keep(words, "value").groupBy().agg(F.count("*").alias("others"))
    lost = exact.join(passed.select("doc_id"), "doc_id", "left_anti").groupBy().agg(F.count("*").alias("lost"))
    counts = exact.groupBy().agg(F.count("*").alias("n_documents")).crossJoin(lost).crossJoin(foreign)
    few = F.col("others") <= 5 * rate * F.col("rest") + 5
    whole = counts.crossJoin(words.groupBy().agg(F.count("*").alias("rest")))  # one row each
    return whole.select("n_documents", (F.col("lost") == 0).alias("none_lost"), few.alias("few_others"))


def top10_records(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "customer"), "c_acctbal", ["c_custkey"])


def top10_distinct_values(spark, sf_dir):
    return topk.top_k_distinct(table(spark, sf_dir, "part"), "p_size", ["p_partkey"])


# -- organization --------------------------------------------------------------------------------


def anonymize(spark, sf_dir):
    return organize.anonymize(table(spark, sf_dir, "events"), ["event_id", "user_id"], "ts")


def _events_as_text(spark, sf_dir):
    """Events with their moment as text; that of an error cannot be read."""
    moment = F.when(F.col("event_type") == "error", F.lit("unknown")).otherwise(format_moment("ts"))
    return table(spark, sf_dir, "events").withColumn("ts", moment)


def anonymize_text(spark, sf_dir):
    """Anonymized rows whose moment is text; one that cannot be read stays whole."""
    return organize.anonymize(_events_as_text(spark, sf_dir), ["event_id", "user_id"], "ts")


def min_max_count_text(spark, sf_dir):
    """First and last moment of each user from texts; rows whose moment cannot be read are left out."""
    events = _events_as_text(spark, sf_dir).select("user_id", parse_moment("ts").alias("ts"))
    return summaries.min_max_count(events, "user_id", "ts")


def gzip_words(spark, sf_dir):
    """Words written as a gzip list and read back."""
    path = scratch_path(spark, "gzip")
    _member_words(spark, sf_dir).write.option("compression", "gzip").text(path)
    return spark.read.text(path).withColumnRenamed("value", "member")


def position_frequency_bins(spark, sf_dir):
    """Frequencies by position, written to one folder per position and read back."""
    path = scratch_path(spark, "positions")
    sinks.write_bins(position_frequency(spark, sf_dir), path, "position")
    return spark.read.parquet(path)


def anonymize_rows(spark, sf_dir):
    """Anonymized rows in text form."""
    rows = organize.anonymize(table(spark, sf_dir, "events"), ["event_id", "user_id", "value"], "ts")
    return rows.select(attribute_rows.attribute_row(["ts", "event_type", "props"], tail=">").alias("line"))


def anonymize_and_distinct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows, users = organize.anonymize_and_distinct(events, ["event_id", "user_id"], "ts", "user_id")
    return rows.withColumn("result", F.lit("anonymize")).unionByName(
        users.withColumn("result", F.lit("distinct")), allowMissingColumns=True
    )


def shuffle_rows(spark, sf_dir):
    return organize.shuffle_rows(table(spark, sf_dir, "events"), seed=7)


def shuffle_rows_mixed(spark, sf_dir):
    """The shuffled table held against its purpose: hardly a row keeps its neighbour, and tasks have about as many rows each."""
    tasks = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shuffled = organize.shuffle_rows(table(spark, sf_dir, "events").select("event_id"), tasks, seed=7)
    placed = cut_lineage(shuffled.select("event_id", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place")))
    before = F.lag("event_id").over(Window.partitionBy("task").orderBy("place"))
    near = placed.select("task", (F.abs(F.col("event_id") - before) == 1).alias("near"))
    sizes = near.groupBy("task").agg(F.count("*").alias("rows"), F.count_if("near").alias("near"))
    whole = sizes.agg(F.sum("rows").alias("n"), F.max("rows").alias("most"), F.sum("near").alias("near"))
    return whole.select("n", (F.col("near") < 0.05 * F.col("n")).alias("mixed"), (F.col("most") <= 1.5 * F.col("n") / tasks + 10).alias("even"))


def _posts(spark, sf_dir):
    """Documents as posts with an escaped tag text."""
    tags = F.concat(F.lit("&lt;"), "lang", F.lit("&gt;&lt;"), "source", F.lit("&gt;"))
    return spread(table(spark, sf_dir, "documents").select("doc_id", tags.alias("tags"), "text"))


def _binned(spark, sf_dir):
    bins = organize.tag_bins("tags", "text", BINS, "license", "license-post")
    return organize.to_bins(_posts(spark, sf_dir), bins)


def bins_by_tag(spark, sf_dir):
    return _binned(spark, sf_dir).select("bin", "doc_id")


def bin_counts(spark, sf_dir):
    return counting.count_by(_binned(spark, sf_dir), "bin")


def bins_by_year(spark, sf_dir):
    """Orders written to one folder per year and read back."""
    path = scratch_path(spark, "bins-by-year")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    sinks.write_bins(organize.year_bins(orders, "o_orderdate"), path, "year")
    return spark.read.parquet(path)


def inverted_index(spark, sf_dir):
    return index.inverted_index(_texts(spark, sf_dir, "pages", "page_id", "html"), "html", "page_id", "/")


def term_weights(spark, sf_dir):
    return _rounded(index.term_weights(_texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", whole_rows=True), "weight")


def corpus_term_weights(spark, sf_dir):
    """Term weights over files: the texts of a source written as one file each, read back."""
    path = scratch_path(spark, "corpus")
    documents = table(spark, sf_dir, "documents")
    sinks.write_bins(documents.select("source", "text"), path, "source", file_format="text")
    lines = corpus.read_corpus(spark, path)
    # a large source may be split over several files: the folder is the document
    named = lines.withColumn("document", F.regexp_extract("path", r"source=([^/]*)/", 1))
    return _rounded(index.term_weights(named, "document", "value"), "weight")


def corpus_file_weights(spark, sf_dir):
    """Term weights with one file per document: the texts of a language and source in one file each, read back."""
    path = scratch_path(spark, "files")
    texts = table(spark, sf_dir, "documents").select(F.concat_ws("-", "lang", "source").alias("name"), "text")
    texts.repartition("name").write.partitionBy("name").text(path)
    return _rounded(corpus.file_term_weights(spark, path), "weight")


# -- itemsets ------------------------------------------------------------------------------------


def _baskets(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    pairs = joins.keyed_join(lines, parts, "l_partkey", "p_partkey").select("l_orderkey", "p_brand").distinct()
    return cut_lineage(pairs)  # written once: the number of baskets, the items and the baskets are all made from it


def _min_support(baskets: DataFrame) -> int:
    count = baskets.agg(F.count_distinct("l_orderkey")).first()[0]
    return max(1, -(-count * SUPPORT_PER_MILLE // 1000))


def frequent_items(spark, sf_dir):
    baskets = _baskets(spark, sf_dir)
    return itemsets.frequent_items(baskets, "l_orderkey", "p_brand", _min_support(baskets))


def frequent_baskets(spark, sf_dir):
    baskets = _baskets(spark, sf_dir)
    kept = itemsets.frequent_baskets(baskets, "l_orderkey", "p_brand", _min_support(baskets))
    return kept.select("l_orderkey", F.array_join("items", "/").alias("items"))


def itemset_level_bins(spark, sf_dir):
    """Sets of every size written to one folder per size and read back."""
    path = scratch_path(spark, "itemset-levels")
    sinks.write_bins(itemset_levels(spark, sf_dir), path, "level")
    return spark.read.parquet(path)


def _joined_items(found: DataFrame) -> DataFrame:
    return found.select(F.array_join("items", "/").alias("itemset"), "support", "level")


def frequent_itemsets(spark, sf_dir):
    """Sets of three items."""
    baskets = _baskets(spark, sf_dir)
    return _joined_items(
        itemsets.frequent_itemsets(baskets, "l_orderkey", "p_brand", max(2, _min_support(baskets) // 10), sizes=[3])
    )


def itemset_levels(spark, sf_dir):
    """Sets of every size."""
    baskets = _baskets(spark, sf_dir)
    return _joined_items(itemsets.frequent_itemsets(baskets, "l_orderkey", "p_brand", _min_support(baskets)))


# -- text formats --------------------------------------------------------------------------------

EVENT_FIELDS = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
CUSTOMER_FIELDS = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
}


def xml_roundtrip(spark, sf_dir):
    """Events written as attribute rows and read back."""
    path = scratch_path(spark, "attribute-rows")
    events = _texts(spark, sf_dir, "events", *EVENT_FIELDS)
    sinks.write_lines(events, path, attribute_rows.attribute_row(list(EVENT_FIELDS)))
    rows = attribute_rows.read_attribute_rows(spark, path)
    return attribute_rows.project_fields(rows, EVENT_FIELDS, unescape=unescape_html)


def xml_elements(spark, sf_dir):
    """Events as elements, parsed by full XML rules."""
    events = table(spark, sf_dir, "events")
    lines = events.select(attribute_rows.attribute_row(["event_id", "props"]).alias("line"))
    return lines.select(attribute_rows.parse_elements("line", ["event_id", "props"]).alias("row")).select("row.*")


def csv_roundtrip(spark, sf_dir):
    """Customers written as delimited text with a header and read back."""
    path = scratch_path(spark, "delimited")
    customer = table(spark, sf_dir, "customer").select(*CUSTOMER_FIELDS)
    customer.write.mode("overwrite").option("header", True).csv(path)
    return delimited.read_delimited(spark, path, CUSTOMER_FIELDS)


def category_count_csv(spark, sf_dir):
    """Customers by segment, from delimited text in which some segments are empty and some rows end before theirs."""
    path = scratch_path(spark, "cells")
    segment = F.when(F.col("c_acctbal") < 0, F.lit(",")).when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(","), F.col("c_mktsegment")))
    lines = table(spark, sf_dir, "customer").select(F.concat(F.col("c_custkey").cast("string"), segment).alias("value"))
    lines.write.text(path)
    return counting.count_by(delimited.read_cells(spark, path, {"c_custkey": "bigint", "c_mktsegment": "string"}), "c_mktsegment")


def bins_counted(spark, sf_dir):
    """Posts written to a folder per bin; their numbers are metrics of that write."""
    path = scratch_path(spark, "bins-counted")
    names = [*BINS.values(), "license-post"]
    found = sinks.write_counted(_binned(spark, sf_dir).select("bin", "doc_id"), path, {n: F.col("bin") == n for n in names}, bin_column="bin")
    return spark.createDataFrame([(n, found[n]) for n in names if found[n]], "bin string, n bigint")


def pair_lines(spark, sf_dir):
    """Word counts as tab-separated lines, written and read back."""
    path = scratch_path(spark, "pairs")
    counts = counting.word_count(_texts(spark, sf_dir, "conversations", "text"), "text")
    sinks.write_pairs(counts, path, ["word", "n"])
    return spark.read.text(path).withColumnRenamed("value", "line")


# -- generators ----------------------------------------------------------------------------------


def _generated_comments(spark, sf_dir, **options):
    """As many comments as there are events, with words of the benchmark items."""
    rows = table(spark, sf_dir, "events").count()
    return synthetic.synthetic_comments(spark, rows, _member_words(spark, sf_dir), "member", seed=11, **options)


def _generated_users(spark, sf_dir):
    """As many users as there are customers, with nations as cities."""
    rows = table(spark, sf_dir, "customer").count()
    cities = table(spark, sf_dir, "nation")
    words = _member_words(spark, sf_dir)
    return synthetic.synthetic_users(spark, rows, words, "member", cities, "n_name", seed=13)


def synthetic_comments(spark, sf_dir):
    """Generated rows held against their ranges: number of rows and of rows outside."""
    rows = _generated_comments(spark, sf_dir)
    words = F.split("Text", " ")
    ok = (
        F.col("Id").between(0, synthetic.IDS - 1)
        & F.col("PostId").between(0, synthetic.IDS - 1)
        & F.col("Score").between(0, synthetic.SCORES - 1)
        & F.col("UserId").between(0, synthetic.USERS - 1)
        & F.size(words).between(1, synthetic.WORDS_PER_TEXT)
        & F.try_to_timestamp("CreationDate", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS")).isNotNull()
    )
    tokens = rows.select(F.explode(words).alias("member"))
    foreign = tokens.join(_member_words(spark, sf_dir), "member", "left_anti")
    return rows.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_outside")).withColumn(
        "n_foreign_words", foreign.agg(F.count("*")).scalar()
    )


def synthetic_words_joined(spark, sf_dir):
    """Comments whose words are joined by number: how many words all texts have, and how many rows differ from those made of a list."""
    listed = _generated_comments(spark, sf_dir)
    joined = _generated_comments(spark, sf_dir, join_words=True)
    apart = listed.exceptAll(joined).groupBy().agg(F.count("*").alias("n_differ"))
    words = joined.select(F.explode(F.split("Text", " ")).alias("member"))
    known = words.join(_member_words(spark, sf_dir), "member", "left_semi").groupBy().agg(F.count("*").alias("known"))
    found = joined.groupBy().agg(F.count("*").alias("n"), F.sum(F.size(F.split("Text", " "))).alias("words")).crossJoin(known).crossJoin(apart)
    return found.select("n", (F.col("words") == F.col("known")).alias("all_known"), "n_differ")  # one row each


def synthetic_users(spark, sf_dir):
    rows = _generated_users(spark, sf_dir)
    ok = (
        F.col("Id").between(0, synthetic.IDS - 1)
        & F.col("Reputation").between(0, synthetic.IDS - 1)
        & F.col("DisplayName").rlike(r"^[a-y]{1,30}$")
        & F.col("Location").startswith("NATION_")
        & F.size(F.split("AboutMe", " ")).between(1, synthetic.WORDS_PER_TEXT)
        & F.col("Views").between(0, synthetic.VIEWS - 1)
        & F.col("UpVotes").between(0, synthetic.VOTES - 1)
        & F.col("DownVotes").between(0, synthetic.VOTES - 1)
    )
    return rows.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_outside"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        word_count,
        word_count_lines,
        word_count_pages,
        word_count_top10,
        word_count_stopwords,
        listed_word_count,
        counter_report,
        word_count_without_stopwords,
        min_max_count,
        min_max_and_words,
        avg_by_hour,
        median_std_by_hour,
        median_std_value_by_hour,
        multi_avg_by_group,
        distinct_users,
        distinct_users_sorted,
        unique_user_count,
        value_frequency,
        position_frequency,
        relative_frequency,
        top10_frequency,
        gap_rows,
        gap_stats,
        gap_stats_users,
        category_count,
        category_count_csv,
        class_count,
        word_count_by_state,
        word_count_by_state_bins,
        named_outputs,
        *[_join(how) for how in joins.HOW],
        _replicated("inner"),
        _replicated("left"),
        nest_children,
        nest_children_parts,
        nest_self,
        nested_xml,
        nested_xml_parts,
        _bloom_join(False),
        _bloom_join(True),
        grep,
        contains,
        threshold,
        not_category,
        sample_percent,
        sample_repeatable,
        bloom_build_probe_exact,
        bloom_key_filter,
        bloom_key_filter_exact,
        bloom_token_flags,
        bloom_token_filter,
        bloom_token_filter_raw,
        top10_records,
        top10_distinct_values,
        anonymize,
        anonymize_rows,
        anonymize_text,
        min_max_count_text,
        gzip_words,
        position_frequency_bins,
        anonymize_and_distinct,
        shuffle_rows,
        shuffle_rows_mixed,
        bins_by_tag,
        bin_counts,
        bins_counted,
        bins_by_year,
        inverted_index,
        term_weights,
        corpus_term_weights,
        corpus_file_weights,
        frequent_items,
        frequent_baskets,
        frequent_itemsets,
        itemset_levels,
        itemset_level_bins,
        xml_roundtrip,
        xml_elements,
        csv_roundtrip,
        pair_lines,
        synthetic_comments,
        synthetic_words_joined,
        synthetic_users,
    )
}
