"""The corpus pipeline: quality, near duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of documents; the last one adds
the shard and slot of each row. A stage works on all that the one before kept, read back from Parquet.

Null and empty texts are scored, linked and mixed like any other (see each operator); repeated rows are rows of their own
until the near-duplicate stage; an empty table gives an empty result. Other columns are carried, but the last stage
replaces input columns called size, text_crc32, law, shard, slot, grown_shard or curve by its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtview.llm import benchmark_decontam, mixing, quality_gam, sharding, simhash_dedup
from courtview.llm.common import discard, read_table, scratch_scope, write_scratch
from courtview.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score below one half)."""
    model = quality_gam.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model).filter(F.col("__score") >= 0.5).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id (null last)."""
    return simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text no benchmark item is found."""
    return benchmark_decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.repeat_rows(mixing.mix_sources(docs, keep_columns=True))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot along the Hilbert curve."""
    return sharding.hilbert_shards(docs, keep_columns=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: Trained scores, fingerprints and seeded draws have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Only their table stays: a stage's input and intermediate tables go once its output is written."""
    configure(spark)
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch_scope(spark) as scratch:
            docs, path = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
            scratch.remove(path)
        discard(spark, *before)
        before = [path]
    return docs
