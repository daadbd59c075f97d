"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle partition counts are left to AQE on a
# cluster (advisory size + coalescing); tests pin them to the local core count.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tastebud", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the settings above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is read
    as is; without it a job there stops with an error, as executors do not see
    each other's disks.  Only with a local master — tests — a scratch folder is
    made and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tastebud-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # static setting on some deployments; the context dir below suffices
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


#: Folders of the stage outputs that this application has written.
_STAGES: list[str] = []


def materialize(df, partition_by: tuple = (), tag: str = "stage", options: dict | None = None):
    """Write a stage output as Parquet to the shared folder and continue from it; ``options`` go to the writer.

    Used where one stage output feeds several consumers (train and test,
    profiles and seen pairs): the upstream plan runs once, a lost executor
    re-reads the files instead of replaying the lineage, and consumers keep
    column pruning, filter pushdown and file sizes.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _STAGES.append(path)
    writer = df.write.options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done and can no longer be read.

    Its cleaner does so when the driver's JVM has collected their plans, which a
    driver with memory to spare does half-hourly; a pipeline of stage outputs
    would keep the shuffles of all its stages on the executors' disks.
    """
    spark._jvm.System.gc()


#: Tables of the session catalog over bucketed stage outputs.
_TABLES: list[str] = []


def materialize_bucketed(df, by: tuple, sort_by: tuple = (), partition_by: tuple = (), buckets: int | None = None):
    """Write a stage output bucketed by ``by``, as a table whose files are in the shared folder.

    Aggregates and windows by ``by`` (or more columns) then need no exchange.
    Rows are dealt to tasks as they are to buckets, so a bucket is one file per
    partition folder.  ``buckets``: the session's shuffle partitions unless given.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stage_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    _STAGES.append(path)
    _TABLES.append(name)
    writer = df.repartition(buckets, *by).write.format("parquet").option("path", path).bucketBy(buckets, *by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    free_shuffles(spark)
    return spark.table(name)


def release_stages(spark: SparkSession) -> int:
    """Delete the stage outputs written so far; DataFrames made from them can no longer be read.

    For long-lived applications, between jobs.  Returns the number of folders deleted.
    """
    n = 0
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _STAGES:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tastebud`` importable in the Python workers (``--py-files`` style).

    Operators that run Arrow batch functions pickle references to this
    package; executors import it from a zip distributed with
    ``SparkContext.addPyFile``.  Done once per application.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="tastebud-pkg-")  # code artefact only, served by the driver
    path = os.path.join(out_dir, "tastebud.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
