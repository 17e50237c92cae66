"""Session helpers: a local session for tests and lineage cuts in the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemill", cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster's own session is used as it is."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tidemill-checkpoint-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder, so a lost executor loses nothing.

    Spark removes a checkpoint once its frame is out of use if spark.cleaner.referenceTracking.cleanCheckpoints
    is set, as a session should.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether df has at most max_rows rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once for a context, so that none need it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemill_shipped", False):
        return
    package = Path(__file__).resolve().parent
    made = Path(tempfile.mkdtemp(prefix="tidemill-")) / "tidemill.zip"
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, Path(package.name) / p.relative_to(package))
    sc.addPyFile(str(made))
    sc._tidemill_shipped = True


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores: small tables come as one file, and Python
    work on them would run in one task. Tables of enough files are left as they are, without a shuffle,
    and so are frames that a shuffle spread already."""
    shuffled = ("Join", "Aggregate", "Repartition", "Sort", "Window", "Distinct")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if any(x in plan for x in shuffled):  # counting their partitions would run them
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def written(df: DataFrame, by: str) -> tuple[DataFrame, str]:
    """df as a table in the shared checkpoint folder, parted by a column, and its path; remove it after use."""
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(by).parquet(path)
    return spark.read.parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
