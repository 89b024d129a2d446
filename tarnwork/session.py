"""Session semantics and the shared scratch area used between stages."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "tarnwork", master: str | None = None, cores: int = 8) -> SparkSession:
    """Session for tests and local benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    spark = builder.master(master or f"local[{cores}]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Null-on-error casts and arithmetic, UTC clock; leaves cluster sizing to the session."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder, because
    there driver and executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tarnwork-")
    return _LOCAL_SCRATCH[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path not used before under the shared folder (not yet created)."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tarnwork-{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage: write once to the shared folder and read it back.

    Unlike an executor-local copy this survives the loss of any executor, it
    is computed exactly once, stays columnar, and its file sizes give the
    optimizer true statistics for the next join.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished plans go before a stage that needs the disk.

    Spark deletes them once the driver has collected the plan as garbage, which
    on an idle driver may not happen for half an hour.  Nothing still in use goes.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Give every core work before a costly per-row step when the scan has few splits.

    A small table is often one row group, hence one busy task.  A large scan
    has more splits than cores and is left alone, so nothing is shuffled.
    """
    context = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() < 2 * context.defaultParallelism:
        return df.repartition(2 * context.defaultParallelism)
    return df
