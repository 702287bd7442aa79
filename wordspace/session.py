"""Spark session and lineage helpers.

Everything in the package works on any session; this module only provides a
sensible local session for tests/bench and the reliable-checkpoint helper used
to cut lineage between the big stages (vocabulary, pairs, training rounds).
"""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "wordspace",
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session with AQE on and the UI off."""
    master = master or os.environ.get("WORDSPACE_MASTER", "local[8]")
    cores = _cores_of(master)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        .config("spark.python.worker.reuse", "true")
        # checkpoints of frames that nothing refers to any more are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _cores_of(master: str) -> int:
    if master.startswith("local[") and master.endswith("]"):
        inner = master[6:-1]
        if inner.isdigit():
            return int(inner)
    return os.cpu_count() or 8


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must come from ``spark.checkpoint.dir`` (a shared
    file system). Only a local-mode session without that setting (tests, bench)
    gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it to a shared folder on the cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wordspace-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application.

    The zip is served by the driver (``addPyFile``); tasks then import the
    package wherever they run, without ``PYTHONPATH``."""
    sc = spark.sparkContext
    if getattr(sc, "_wordspace_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in os.walk(root):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("wordspace", os.path.relpath(path, root)))
    target = os.path.join(tempfile.mkdtemp(prefix="wordspace-ship-"), "wordspace.zip")
    with open(target, "wb") as f:
        f.write(buffer.getvalue())
    sc.addPyFile(target)
    sc._wordspace_shipped = True


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and pins nondeterministic layouts
    (range bounds, partition ids) so later branches see the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


# Spark deletes the shuffle files of an execution at its end
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A large table that is read more than once: compressed columns under the
    checkpoint directory (at ``path``, a ``scratch_path``, if it is to be dropped), a
    fraction of a checkpoint's serialised rows. What was shuffled for it goes when it
    is written."""
    path, conf = path or scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote under the checkpoint directory."""
    if not path.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path, from the path's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def spread(df: DataFrame, *key_cols: str) -> DataFrame:
    """Hash-repartition narrow rows before each of them is expanded many times,
    so that the expansion uses every core whatever the input's layout."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key_cols)
