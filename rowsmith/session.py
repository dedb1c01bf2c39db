"""Session set-up and lineage cuts.

Nothing here reads data on the driver.  Lineage is cut by writing a parquet
table below the shared folder the cluster names in ``spark.checkpoint.dir``, so
that a lost executor costs only the stage that was running.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def build_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings every plan here assumes (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowsmith")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is configured (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = jdir.get() if jdir.isDefined() else None
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("a cluster must name a shared folder in spark.checkpoint.dir")
        configured = "file://" + tempfile.mkdtemp(prefix="rowsmith-")
        spark.sparkContext.setCheckpointDir(configured)
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/rowsmith-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    if not _written:
        atexit.register(_forget)
    _written.append((spark, path))
    return path


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back from there."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table returned by :func:`cut` that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/rowsmith-" in name:
            _delete(spark, name)


def clear(*tables: DataFrame) -> None:
    """Deletes tables returned by :func:`cut` at the end of a phase and lets Spark remove the shuffle files of the phase, which it does when the driver collects its garbage."""
    for t in tables:
        drop_cut(t)
    gc.collect()
    tables[0].sparkSession.sparkContext._jvm.System.gc()


def slots(spark: SparkSession) -> int:
    """Partitions for stages whose work is Python, not bytes (AQE would merge them by size)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Repartition before a Python stage to a number that AQE leaves alone."""
    return df.repartition(slots(df.sparkSession), *cols)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _forget() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the JVM may be gone already
            return
