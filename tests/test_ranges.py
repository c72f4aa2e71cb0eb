"""Running totals over stretches."""

import itertools
import random

import pytest

from tallyworks.operators.ranges import totals_before


@pytest.mark.parametrize("fan", [1, 3, 1024])
def test_totals_before_are_running_sums(spark, fan):
    numbers = sorted(random.Random(fan).sample(range(500), 60))
    values = [None if n % 7 == 0 else n * 3 - 200 for n in numbers]
    df = spark.createDataFrame(list(zip(numbers, values, strict=True)), "stretch int, v long").repartition(4)
    found = {r["stretch"]: r["before"] for r in totals_before(df, "stretch", "v", fan=fan).collect()}
    sums = [0, *itertools.accumulate(v or 0 for v in values)]
    assert found == dict(zip(numbers, sums[:-1], strict=True))


def test_totals_before_of_nothing(spark):
    assert totals_before(spark.createDataFrame([], "stretch int, v long"), "stretch", "v").count() == 0
