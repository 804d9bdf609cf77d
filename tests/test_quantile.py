import math
import random

import pytest

from courtview.operators.quantile import exact_quantile


def type7(values, p):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    index = (len(xs) - 1) * p
    lo = math.floor(index)
    hi = min(math.ceil(index), len(xs) - 1)
    h = index - lo
    if h == 0 or xs[lo] == xs[hi]:
        return xs[lo]
    return (1 - h) * xs[lo] + h * xs[hi]


@pytest.mark.parametrize("kind", ["continuous", "ties", "two_values", "nulls"])
def test_narrowing_matches_sort(spark, kind):
    rnd = random.Random(7)
    n = 20_000
    if kind == "continuous":
        vals = [rnd.random() * 100 for _ in range(n)]
    elif kind == "ties":
        vals = [rnd.choice([0.0, 1 / 3, 0.5, 2 / 3, 1.0]) for _ in range(n)]
    elif kind == "two_values":
        vals = [0.0] * (n // 2) + [1.0] * (n // 2)
    else:
        vals = [None if i % 3 == 0 else rnd.gauss(0, 1) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    for p in (0.9, 0.5, 0.0, 1.0, 0.37):
        # small=300 forces several narrowing rounds instead of a direct sort
        assert exact_quantile(df, "x", p, small=300, accuracy=200) == type7(vals, p)


def test_empty_and_single(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.9) is None
    assert exact_quantile(spark.createDataFrame([(2.5,)], "x double"), "x", 0.9) == 2.5


def test_skewed_hot_value(spark):
    # a third of all rows share one value
    rnd = random.Random(3)
    vals = [0.25] * 6000 + [rnd.random() for _ in range(12000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for p in (0.1, 0.33, 0.5, 0.9):
        assert exact_quantile(df, "x", p, small=500, accuracy=300) == type7(vals, p)
