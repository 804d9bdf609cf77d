"""Merged sketches against the exact quantile, and refreshes that read new folders only."""

import random

import pytest
from pyspark.sql import functions as F

from courtview.operators import sketch
from courtview.operators.quantile import exact_quantile

COLUMNS = ["rate", "share"]


def _rows(seed, month, n):
    rnd = random.Random(seed)
    return [(f"2024-{month:02d}-01", rnd.lognormvariate(0, 2) + month if rnd.random() > 0.1 else None, rnd.choice([0.0, 0.0, 0.25, 0.5, 1.0, float("nan")])) for _ in range(n)]


def _write(spark, folder, rows):
    spark.createDataFrame(rows, "published_month string, rate double, share double").repartition(3).write.mode("append").partitionBy("published_month").parquet(folder)


def _within(spark, folder, store, k):
    whole = spark.read.parquet(folder)
    found = {p: {r["column"]: r for r in sketch.quantiles(sketch.read_store(spark, store), p).collect()} for p in (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)}
    for p, by_column in found.items():
        for c in COLUMNS:
            r = by_column[c]
            assert r["n"] == whole.where(F.col(c).isNotNull() & ~F.isnan(c)).count()
            lo, hi = sketch.rank_of(whole, c, r["quantile"])
            assert lo - sketch.rank_error(k) <= p <= hi + sketch.rank_error(k), (p, c, lo, hi)
            exact = exact_quantile(whole, c, p)
            if c == "share":  # a tie block far wider than the bound
                assert r["quantile"] == exact


@pytest.mark.parametrize("k", [200, sketch.K])
def test_refresh_reads_new_folders_only(spark, tmp_path, k):
    folder, store = str(tmp_path / "table"), str(tmp_path / "store")
    for m in (1, 2, 3):
        _write(spark, folder, _rows(m, m, 12_000))
    assert sketch.refresh(spark, folder, store, COLUMNS, k) == [f"published_month=2024-{m:02d}-01" for m in (1, 2, 3)]
    _within(spark, folder, store, k)
    assert sketch.refresh(spark, folder, store, COLUMNS, k) == []
    _write(spark, folder, _rows(4, 4, 9000))  # a new month
    _write(spark, folder, _rows(5, 2, 500))   # late rows of an old one
    assert sketch.refresh(spark, folder, store, COLUMNS, k) == ["published_month=2024-02-01", "published_month=2024-04-01"]
    _within(spark, folder, store, k)
    assert sketch.refresh(spark, folder, store, COLUMNS, k) == []


def test_dropped_folders_and_missing_values(spark, tmp_path):
    folder, store = str(tmp_path / "table"), str(tmp_path / "store")
    _write(spark, folder, [("2024-01-01", None, None), ("2024-01-01", None, float("nan"))])
    sketch.refresh(spark, folder, store, COLUMNS)
    assert {(r["column"], r["n"], r["quantile"]) for r in sketch.quantiles(sketch.read_store(spark, store), 0.9).collect()} == {("rate", 0, None), ("share", 0, None)}
    _write(spark, folder, [("2024-02-01", 2.0, 0.5)])
    sketch.refresh(spark, folder, store, COLUMNS)
    assert {(r["column"], r["n"], r["quantile"]) for r in sketch.quantiles(sketch.read_store(spark, store), 0.9).collect()} == {("rate", 1, 2.0), ("share", 1, 0.5)}
    spark.read.parquet(f"{folder}/published_month=2024-02-01").write.parquet(str(tmp_path / "moved" / "published_month=2024-02-01"))
    sketch.refresh(spark, str(tmp_path / "moved"), store, COLUMNS)  # January is no longer there
    assert {r["entry"] for r in sketch.read_store(spark, store).collect()} == {"published_month=2024-02-01"}


def test_error_bound_is_the_documented_one():
    assert sketch.rank_error() < 0.0013 and sketch.rank_error(200) < 0.02
