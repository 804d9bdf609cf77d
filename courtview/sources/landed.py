"""Many landed files of one logical table, read in one scan: differing columns, empty files, records that do not parse.

Files are JSON lines. Each line is parsed against one schema (given, or merged from the files): a column that a file
lacks is NULL, a line that is no JSON object or holds a value of another type is kept aside whole, with the name of its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtview.session import delete_at_exit, scratch_path

FILE, RECORD = "_file", "_bad_record"


def merged_schema(spark: SparkSession, folder: str) -> T.StructType:
    """The union of the columns of all files (one pass over them); values of differing types widen as JSON inference does."""
    fields = spark.read.option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(folder).schema.fields
    return T.StructType([f for f in fields if f.name not in (FILE, RECORD)])


def read_landed(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """All lines of all files below ``folder``: the schema's columns, ``_file``, and ``_bad_record`` (NULL for a good line).

    Blank lines are no records. With a schema there is a single scan, and no pass to infer one.
    """
    schema = schema or merged_schema(spark, folder)
    asked = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    lines = spark.read.option("recursiveFileLookup", "true").text(folder).select(F.col("value"), F.col("_metadata.file_path").alias(FILE))
    parsed = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", asked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}))
    no_object = ~F.trim("value").startswith("{")  # arrays and bare values would pass for rows without columns
    bad = F.when(no_object, F.col("value")).otherwise(F.col(f"r.{RECORD}"))
    whole = [F.when(F.col(RECORD).isNull(), F.col(f"r.`{f.name}`")).alias(f.name) for f in schema.fields]
    return parsed.withColumn(RECORD, bad).select(*whole, FILE, RECORD)


def good_rows(landed: DataFrame) -> DataFrame:
    return landed.where(F.col(RECORD).isNull()).drop(FILE, RECORD)


def bad_records(landed: DataFrame) -> DataFrame:
    """(_file, _bad_record) of the lines that did not parse."""
    return landed.where(F.col(RECORD).isNotNull()).select(FILE, RECORD)


def land(frames: list[DataFrame], name: str) -> str:
    """Write each frame's rows as JSON lines into a folder of its own below one landing folder, which lasts as long as the application."""
    spark, path = frames[0].sparkSession, scratch_path(frames[0].sparkSession, f"landed-{name}")
    for k, df in enumerate(frames):
        df.write.json(f"{path}/{k}")
    delete_at_exit(spark, path)
    return path
