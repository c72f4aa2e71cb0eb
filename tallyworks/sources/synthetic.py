"""Generated comment and user rows for load tests. Rows are made where they are needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.functions.moments import format_moment
from tallyworks.operators.ranges import totals_before
from tallyworks.session import broadcast_if_small, cut_lineage, fits_broadcast

# Ranges of the generated fields.
IDS = 1_000_000_000
USERS = 1_000_000
SCORES = 15_000
VIEWS = 1_000_000
VOTES = 1_000
WORDS_PER_TEXT = 30
LETTERS_PER_NAME = 30
LETTERS = "abcdefghijklmnopqrstuvwxy"

#: Largest word list, in bytes, that is sent to every task.
WORD_LIST_BYTES = 8 * 1024 * 1024
#: Rows a task makes when the number of tasks is not stated.
ROWS_PER_TASK = 1_000_000
#: Moments are drawn from 1970 up to this second (2100-01-01).
LAST_SECOND = 4_102_444_800


class _Draws:
    """Independent columns of random numbers: each value is a hash of seed, field and row number, and of nothing else.

    So a row is the same however many tasks make the table, and any part of it can be made by itself.
    """

    def __init__(self, seed: int, row: str = "_row"):
        self._seed, self._field, self.row = seed, 0, F.col(row)

    def field(self, *more: Column) -> Column:
        """A new random field, or one value of it for each of the further columns."""
        self._field += 1
        return self._hash(self._field, *more)

    def _hash(self, field: int, *more: Column) -> Column:
        return F.xxhash64(F.lit(self._seed).cast("bigint"), F.lit(field), self.row, *more)

    def below(self, bound: int | Column) -> Column:
        size = F.lit(bound) if isinstance(bound, int) else bound
        return F.pmod(self.field(), size.cast("bigint"))

    def moment(self) -> Column:
        millis = self.below(LAST_SECOND) * 1000 + self.below(1000)
        return format_moment(F.timestamp_millis(millis))

    def several(self, length: Column, draw) -> Column:
        """Array of as many drawn values; ``draw`` gets a random number of 64 bits."""
        self._field += 1
        field = self._field
        return F.transform(F.sequence(F.lit(1), length.cast("int")), lambda i: draw(self._hash(field, i)))

    def name(self, length: Column) -> Column:
        return F.array_join(self.several(length, lambda h: F.substring(F.lit(LETTERS), F.pmod(h, F.lit(len(LETTERS))).cast("int") + 1, F.lit(1))), "")


def _rows(spark: SparkSession, rows: int, tasks: int | None) -> DataFrame:
    tasks = tasks or max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_TASK)
    return spark.range(0, rows, 1, tasks).withColumnRenamed("id", "_row")


def numbered(values: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Different values with dense numbers from 0 in their order, and how many there are.

    Values are put in order by range; each range is counted and begins behind those before it. No task sees more than its range.
    """
    distinct = values.select(column).dropna().distinct()
    ranged = cut_lineage(distinct.repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    counts = cut_lineage(ranged.groupBy("_range").agg(F.count("*").alias("_n")))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    offsets = broadcast_if_small(totals_before(counts, "_range", "_n", "_first"))
    dense = ranged.withColumn("_place", place).join(offsets, "_range").select(column, (F.col("_first") + F.col("_place")).alias("_number"))
    return dense, counts.agg(F.sum("_n")).first()[0] or 0


class _Words:
    """A list to draw words from: held by every task if it is small, else joined by number."""

    def __init__(self, words: DataFrame, column: str, join: bool):
        self.join = join
        if join:
            self.dense, self.size = numbered(words, column)
            self.column = column
            return
        listed = words.select(column).dropna().distinct()
        if not fits_broadcast(listed, WORD_LIST_BYTES):
            raise ValueError(f"a word list may hold {WORD_LIST_BYTES} bytes at most, unless words are joined")
        self.size = listed.count()
        self.held = listed.agg(F.array_sort(F.collect_list(column))).scalar()

    def numbers(self, draw: _Draws, length: Column) -> Column:
        """Numbers of drawn words, none of an empty list."""
        return draw.several(length, lambda h: F.pmod(h, F.lit(max(self.size, 1)).cast("bigint")))

    def texts(self, made: DataFrame, numbers: str, out: str) -> DataFrame:
        """``made`` with the words of an array of numbers, joined by blanks, as ``out`` in its place."""
        if not self.join:
            listed = F.array_compact(F.transform(numbers, lambda n: F.get("_held", n.cast("int"))))
            return made.withColumn("_held", self.held).withColumn(out, F.array_join(listed, " ")).drop(numbers, "_held")
        each = made.select("_row", F.posexplode(numbers).alias("_at", "_number"))
        met = each.join(self.dense, "_number").select("_row", F.struct("_at", F.col(self.column).cast("string").alias("word")).alias("of"))
        texts = met.groupBy("_row").agg(F.array_join(F.array_sort(F.collect_list("of"))["word"], " ").alias(out))
        return made.drop(numbers).join(texts, "_row", "left").withColumn(out, F.coalesce(out, F.lit("")))


def synthetic_comments(
    spark: SparkSession, rows: int, words: DataFrame, word: str, *, tasks: int | None = None, seed: int = 0, join_words: bool = False
) -> DataFrame:
    """Comment rows with random ids, score, date and a text of 1 to 30 words of a list.

    A row is a function of ``seed`` and its number. The list is sent to every task and may hold ``WORD_LIST_BYTES``; with
    ``join_words`` it has any size, drawn words are joined by their number in the sorted list, and the rows are the same.
    """
    listed, draw = _Words(words, word, join_words), _Draws(seed)
    made = _rows(spark, rows, tasks).select(
        "_row",
        draw.below(IDS).alias("Id"),
        draw.below(IDS).alias("PostId"),
        draw.below(SCORES).cast("int").alias("Score"),
        listed.numbers(draw, draw.below(WORDS_PER_TEXT) + 1).alias("_numbers"),
        draw.moment().alias("CreationDate"),
        draw.below(USERS).alias("UserId"),
    )
    return listed.texts(made, "_numbers", "Text").select("Id", "PostId", "Score", "Text", "CreationDate", "UserId")


def synthetic_users(
    spark: SparkSession,
    rows: int,
    words: DataFrame,
    word: str,
    cities: DataFrame,
    city: str,
    *,
    tasks: int | None = None,
    seed: int = 0,
    join_words: bool = False,
) -> DataFrame:
    """User rows with random reputation, name, dates, city, text and votes; see ``synthetic_comments``."""
    listed, places, draw = _Words(words, word, join_words), _Words(cities, city, join_words), _Draws(seed)
    made = _rows(spark, rows, tasks).select(
        "_row",
        draw.below(IDS).alias("Id"),
        draw.below(IDS).cast("int").alias("Reputation"),
        draw.moment().alias("CreationDate"),
        draw.name(draw.below(LETTERS_PER_NAME) + 1).alias("DisplayName"),
        F.hash(draw.below(IDS).cast("string")).alias("EmailHash"),
        draw.moment().alias("LastAccessDate"),
        places.numbers(draw, F.lit(1)).alias("_place"),
        listed.numbers(draw, draw.below(WORDS_PER_TEXT) + 1).alias("_numbers"),
        draw.below(VIEWS).cast("int").alias("Views"),
        draw.below(VOTES).cast("int").alias("UpVotes"),
        draw.below(VOTES).cast("int").alias("DownVotes"),
    )
    whole = places.texts(listed.texts(made, "_numbers", "AboutMe"), "_place", "Location")
    named = ("Id", "Reputation", "CreationDate", "DisplayName", "EmailHash", "LastAccessDate", "Location", "AboutMe", "Views", "UpVotes", "DownVotes")
    return whole.select(*named)
