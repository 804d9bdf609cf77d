"""Published tables: whole or not at all, and never someone else's."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from courtview.sources.files import ForeignTableError, _location, is_ours, write_table


@pytest.fixture
def name(spark):
    n = "published_test"
    spark.sql(f"DROP TABLE IF EXISTS {n}")
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def _files(location):
    return os.path.exists(location.removeprefix("file:"))


def _tables(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_rewrite_swaps_the_copy_and_drops_the_old(spark, name):
    first = write_table(spark.range(10).withColumn("v", F.lit("a")), name)
    before = _location(spark, name)
    assert first.count() == 10 and is_ours(spark, name)
    again = write_table(spark.range(3).withColumn("v", F.lit("b")), name)
    assert sorted(tuple(r) for r in again.collect()) == [(0, "b"), (1, "b"), (2, "b")]
    assert _location(spark, name) != before and not _files(before) and _files(_location(spark, name))
    assert [t for t in _tables(spark) if t.startswith(name)] == [name]


def test_other_columns_and_buckets_replace_the_table(spark, name):
    write_table(spark.range(10), name)
    before = _location(spark, name)
    wide = write_table(spark.range(4).withColumn("k", F.lit("x")), name, bucket_by="id", buckets=4)
    assert wide.columns == ["id", "k"] and wide.count() == 4 and not _files(before) and is_ours(spark, name)
    swapped = write_table(spark.range(5).withColumn("k", F.lit("y")), name, bucket_by="id", buckets=4)
    assert swapped.count() == 5
    join = swapped.join(swapped.select("id", F.col("k").alias("k2")).hint("merge"), "id")
    assert "Exchange" not in join._jdf.queryExecution().executedPlan().toString()


def test_a_foreign_table_is_refused(spark, name):
    spark.range(7).write.saveAsTable(name)
    with pytest.raises(ForeignTableError):
        write_table(spark.range(2), name)
    assert spark.table(name).count() == 7
    assert [t for t in _tables(spark) if t.startswith(name)] == [name]


def test_a_failing_write_leaves_the_old_copy(spark, name):
    write_table(spark.range(10), name)
    before = _location(spark, name)
    folder = os.path.dirname(before.removeprefix("file:"))
    there = set(os.listdir(folder))
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException, match="midway"):
        write_table(broken, name)
    assert spark.table(name).count() == 10 and _location(spark, name) == before
    assert [t for t in _tables(spark) if t.startswith(name)] == [name]
    assert set(os.listdir(folder)) == there
