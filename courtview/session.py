"""Session helpers: settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "courtview",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches; clusters pass their own builder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**_SETTINGS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the UTC zone the date features assume; everything else is left to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (local tests) do we pick a fresh
    temporary folder of our own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="courtview-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)  # our own folder, local runs only
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet (in the session's codec unless given one) into the shared folder and read it back.

    Cuts lineage the way a published table does: a lost executor re-reads files
    instead of recomputing the whole upstream plan. The copy lasts as long as the application.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    delete_at_exit(spark, path)
    return spark.read.parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's file system delete an existing scratch path when the application ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def input_state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes, file counts and modification times of the tables in ``folder``: a few numbers for each table.

    Cached copies are keyed on it, so rewritten input is read anew.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    state = []
    for entry in fs.listStatus(path):
        total = fs.getContentSummary(entry.getPath())
        state.append((entry.getPath().getName(), total.getLength(), total.getFileCount(), entry.getModificationTime()))
    return tuple(sorted(state))


#: Most blocks that one shuffle may have (map tasks times reducers).
MAX_SHUFFLE_BLOCKS = 2_000_000_000


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 * 1024, exchange_bytes: int | None = None) -> dict[str, str]:
    """Settings for a cluster run sized to the input.

    * scan splits of 128 MB, larger (up to 1 GB) where that would make more than a dozen waves of map tasks;
    * shuffle partitions from ``exchange_bytes``, what the largest exchange carries after pruning and map-side
      aggregation (a tenth of the input unless given): ``target_partition_bytes`` each, at least 3 waves of the
      cluster's cores, but no more than ``MAX_SHUFFLE_BLOCKS`` blocks allow (then at least one wave);
    * broadcast threshold kept small: large sides are broadcast only by the library's proven-size hints.
    """
    cores = max(1, executors * cores_per_executor)
    split = min(1 << 30, max(128 << 20, input_bytes // (12 * cores)))
    map_tasks = max(1, -(-input_bytes // split))
    carried = input_bytes // 10 if exchange_bytes is None else exchange_bytes
    wanted = max(3 * cores, -(-carried // target_partition_bytes))
    shuffle_partitions = max(cores, min(wanted, MAX_SHUFFLE_BLOCKS // map_tasks))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
