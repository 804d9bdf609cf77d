"""File and table sources and sinks: CSV (plain, typed, safe export), Parquet
snapshot, catalog tables.  Every location is under the shared checkpoint folder
unless the caller passes one.
"""

from __future__ import annotations

import unicodedata
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtview.functions.text import squish, strip_newlines
from courtview.schemas import STAGED, STAGED_COLUMNS
from courtview.session import scratch_path

CSV_OPTIONS = {"header": "true", "nullValue": "NA", "quote": '"', "escape": '"', "multiLine": "true",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
               "dateFormat": "yyyy-MM-dd"}


def write_csv(df: DataFrame, path: str, rows_per_file: int = 200_000) -> str:
    """Overwrite ``path`` with a headed CSV (``NA`` for NULL); files stay small, as each is read by one task."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             mode: str = "PERMISSIVE") -> DataFrame:
    """Headed CSV with an explicit schema (no inference pass over the data)."""
    r = spark.read.options(**CSV_OPTIONS).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def safe_export(stg: DataFrame) -> DataFrame:
    """Every text column with CR/LF runs replaced by one space; description also squished."""
    cols = []
    for f in stg.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = strip_newlines(c)
            if f.name == "video_description":
                c = squish(c)
        cols.append(c.alias(f.name))
    return stg.select(*cols).select(*STAGED_COLUMNS)


def csv_round_trip(stg: DataFrame, name: str = "staged-csv") -> DataFrame:
    spark = stg.sparkSession
    path = write_csv(stg, scratch_path(spark, name))
    return read_csv(spark, path, STAGED)


# A typed BI source: the 32 staged columns plus three spare text columns that a
# ragged parse once produced; they are declared, read, and dropped.
SPARE_COLUMNS = ("F33", "F34", "F35")
TYPED_SOURCE = T.StructType(list(STAGED.fields) + [T.StructField(c, T.StringType(), True) for c in SPARE_COLUMNS])


def read_typed_source(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, TYPED_SOURCE, mode="PERMISSIVE")
    return df.drop(*SPARE_COLUMNS)


def parquet_snapshot(df: DataFrame, name: str = "extract") -> DataFrame:
    """All rows to a Parquet snapshot (no row cap), read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


OWNER = "courtview.published"


class ForeignTableError(RuntimeError):
    """A table of that name exists and was not published by this library."""


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def _layout(spark: SparkSession, table: str) -> tuple:
    """What a swap of locations must leave as it is: columns, and bucketing."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name IN ('Num Buckets', 'Bucket Columns', 'Provider')").collect()}
    return spark.table(table).schema.simpleString(), tuple(sorted(told.items()))


def _drop_files(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def is_ours(spark: SparkSession, table: str) -> bool:
    """Whether an existing table carries the library's mark."""
    return any(r["key"] == OWNER for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect())


def write_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int | None = None) -> DataFrame:
    """Publish a catalog table whose files live in the shared folder, in one step; returns the table.

    The new copy is written beside the old one under a name of its own. Only when it is whole does the table change: its
    location is swapped for the new one (same columns and bucketing), or the table is replaced (otherwise: the name is
    missing for a moment). Then the old copy's files go. A write that fails leaves the table as it was and no files. A table of that name
    that this library did not publish is refused (``ForeignTableError``) before anything is written.

    With ``bucket_by`` the table is hash-bucketed (and sorted) on that key: later joins with another table
    bucketed the same way on the same key read both sides without an exchange (e.g. documents and their
    per-item statistics on ``video_id``, so repeated builds never re-shuffle whole texts).
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and not is_ours(spark, name):
        raise ForeignTableError(f"table {name} exists and was not published by this library")
    path, beside = scratch_path(spark, f"table-{name}"), f"{name}__{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists").option("path", path)
    if bucket_by:
        w = w.bucketBy(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), bucket_by).sortBy(bucket_by)
    try:
        w.saveAsTable(beside)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        _drop_files(spark, path)
        raise
    spark.sql(f"ALTER TABLE {beside} SET TBLPROPERTIES ('{OWNER}' = 'true')")
    old = _location(spark, name) if exists else None
    if exists and _layout(spark, name) == _layout(spark, beside):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_location(spark, beside)}'")
        spark.sql(f"DROP TABLE {beside}")  # an external table: its files stay
        spark.catalog.refreshTable(name)
    else:
        if exists:
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    if old:
        _drop_files(spark, old)
    return spark.table(name)


def list_tables(spark: SparkSession) -> DataFrame:
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


#: Letters that Unicode does not decompose, in ASCII.
ASCII_LETTERS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "TH", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i", "ŋ": "ng", "Ŋ": "NG", "ŧ": "t", "Ŧ": "T", "µ": "u", "μ": "u",
}
#: Symbols that are words, and marks that vanish.
SYMBOL_WORDS = {"%": " percent ", "#": " number "}
DROPPED = "'\"\u2018\u2019\u201c\u201d"


def ascii_text(name: str) -> str:
    """Latin letters without accents; characters that have no ASCII form stay."""
    def one(ch: str, after: str) -> str:
        plain = ASCII_LETTERS.get(ch, ch)  # a capital of two letters is one capital before a small letter
        return plain.title() if len(plain) > 1 and plain.isupper() and not after.isupper() else plain

    plain = "".join(one(ch, after) for ch, after in zip(name, f"{name} "[1:], strict=True))
    return "".join(ch for ch in unicodedata.normalize("NFKD", plain) if not unicodedata.combining(ch))


def name_words(text: str) -> list[str]:
    """The words of an ASCII name: runs of letters and digits, cut where the case changes.

    A cut stands before a capital that follows a small letter or a digit (``viewCount``, ``q4Views``), and before the last
    capital of a run of them that a small letter follows (``HTMLPage`` is html, page). Digits do not part words.
    """
    words, word = [], ""
    for i, ch in enumerate(text):
        if not (ch.isascii() and ch.isalnum()):
            words.append(word)
            word = ""
            continue
        if word and ch.isupper():
            last, after = word[-1], text[i + 1] if i + 1 < len(text) else ""
            if not last.isupper() or (after.isascii() and after.islower()):
                words.append(word)
                word = ""
        word += ch
    words.append(word)
    return [w.lower() for w in words if w]


def clean_name(name: str) -> str:
    """Snake case in ASCII: accents removed, ``%`` and ``#`` as words, quotes dropped, ``x`` before a leading digit (or alone for no word)."""
    text = "".join(SYMBOL_WORDS.get(ch, ch) for ch in name if ch not in DROPPED)
    out = "_".join(name_words(ascii_text(text)))
    return f"x{out}" if not out or out[0].isdigit() else out


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column by ``clean_name``; a name that is taken gets ``_2``, ``_3``, ... (the first that is free)."""
    return df.toDF(*unique_names([clean_name(c) for c in df.columns]))


def unique_names(names: list[str]) -> list[str]:
    taken: set[str] = set()
    out = []
    for base in names:
        name, n = base, 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        out.append(name)
    return out
