"""Session and checkpoint helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "cohortlens") -> SparkSession:
    """Session for tests and local runs. On a cluster use the session you already have."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session without one (tests, laptops)
    gets a private scratch folder; a cluster session without one is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) before running iterative operators")


def materialize(df, tag: str = "stage"):
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint folder and reading it
    back. One computation (``DataFrame.checkpoint`` computes an uncached input twice: once to
    count, once to write); the files survive the loss of any executor."""
    import uuid

    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """The folder under the shared checkpoint folder that holds everything this application materialises."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortlens-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's materialised tables. Call it when all results are written: lazy
    frames that still read them cannot be computed afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
