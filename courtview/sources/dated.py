"""A typed, date-clustered table: one folder for each month, rows in ranges of dates within it.

Landed tables carry publication times as ISO text, which every date filter has to parse for every row. The published copy
has ``published_ts``, ``published_date`` and ``published_month``; it is partitioned by the month and written in
ranges of (date, id), so that a hot day spreads over tasks, a task writes few months, and row groups hold few days. A window of
dates then lists the folders of its months only, and skips the row groups outside its days.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.functions.dates import parse_ts
from courtview.session import delete_at_exit, scratch_path

MONTH, DAY, TIME = "published_month", "published_date", "published_ts"


def with_dates(df: DataFrame, iso: str = "published_at") -> DataFrame:
    """``df`` with the typed columns of its ISO text (NULL where it does not parse)."""
    return df.withColumn(TIME, parse_ts(iso)).withColumn(DAY, F.to_date(TIME)).withColumn(MONTH, F.trunc(DAY, "MM"))


def write_dated(df: DataFrame, name: str, order: str = "video_id", path: str | None = None) -> DataFrame:
    """The date-clustered copy of ``df`` (see ``with_dates``), read back; it lasts as long as the application."""
    spark, path = df.sparkSession, path or scratch_path(df.sparkSession, f"dated-{name}")
    typed = df if MONTH in df.columns else with_dates(df)
    typed.repartitionByRange(F.col(DAY).asc_nulls_last(), F.col(order).asc_nulls_last()).sortWithinPartitions(MONTH, DAY, TIME).write.partitionBy(MONTH).parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(typed.schema).parquet(path)


def from_date(df: DataFrame, start: date) -> DataFrame:
    """Rows published on ``start`` or later, by whichever date columns ``df`` has."""
    if MONTH in df.columns:
        return df.where((F.col(MONTH) >= F.lit(start.replace(day=1))) & (F.col(DAY) >= F.lit(start)))
    return df.where(F.to_date(parse_ts("published_at")) >= F.lit(start))


def between_dates(df: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the closed window of dates (rows without a date are in none)."""
    if MONTH in df.columns:
        return from_date(df, start).where((F.col(MONTH) <= F.lit(end.replace(day=1))) & (F.col(DAY) <= F.lit(end)))
    return df.where(F.to_date(parse_ts("published_at")).between(F.lit(start), F.lit(end)))


def newest_first(df: DataFrame) -> F.Column:
    """The order of publication, newest first and missing times last."""
    return (F.col(TIME) if TIME in df.columns else parse_ts("published_at")).desc_nulls_last()
