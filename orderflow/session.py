"""Session helpers: one place for the settings every job relies on.

On a cluster the session already exists and ``spark.checkpoint.dir`` names
a shared folder; we only fill in defaults that are unset (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume. Timestamps are compared in UTC and
# Arrow is used for every pandas hand-off.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # keyed streaming state (sessions, reservations) lives off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # what a Python task holds at once, in the JVM and in the worker, follows bytes and not only rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orderflow", memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers (once per application).

    The Arrow-batched Python stages (fold, state processors) pickle functions
    by module reference; executors need the package on their path wherever the
    driver runs from.  The package is zipped and added with ``addPyFile``,
    which distributes it to every executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="orderflow-pyfiles-"), "orderflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply required settings; set defaults and a checkpoint dir only if unset;
    ship the package to the Python workers."""
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running cluster: leave it
                pass
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``, else from the folder registered with
    ``setCheckpointDir``.  Only a local master (tests, bench) may go without:
    it gets a fresh folder under the system temp dir.  On a cluster that
    folder would be on each machine's own disk, so an unset one is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="orderflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new unique folder under the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    A lineage cut for an intermediate that several branches read (each branch
    would otherwise recompute it): the table survives executor loss, and the
    re-read gets column pruning and filter pushdown.  The table stands for the
    shuffles that led to it, so their files go as soon as it is written, not
    when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.parquet(path)
