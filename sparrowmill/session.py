"""Session helpers: test/bench session, shared folder, durable cut of a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int = 8, app: str = "sparrowmill", partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's setting, or a temporary one in local mode."""
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder before running on a cluster")
    root = tempfile.mkdtemp(prefix="sparrowmill-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, empty path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them from there.

    Cuts the lineage: what follows reads a fixed result, also when executors are lost, and only the
    columns it needs.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table scan that arrives in fewer partitions than there are cores.

    Text work is bound by the processor, and a small file is one task. A scan with enough partitions,
    as on any large table, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(2 * cores)
