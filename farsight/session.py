"""Session helpers: building a local session for tests and resolving the
shared work folder (``spark.checkpoint.dir``) used to cut lineage and to hold
streaming checkpoints and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "farsight") -> SparkSession:
    """Local session for tests and the bench (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a path that every executor sees); if
    it is unset there, this raises.  Only a local session, where driver and
    executors are one process, gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set: name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="farsight-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the work folder, removed when the driver's
    JVM ends."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(p)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes ``df`` to the shared work folder and
    returns a frame whose lineage starts there (survives executor loss)."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df: DataFrame, name: str = "saved") -> DataFrame:
    """Write ``df`` as Parquet to the shared work folder and read it back:
    lineage starts at the files, so a lost executor costs no recomputation
    and several readers share one run."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
