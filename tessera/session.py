"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tessera", extra_conf: dict | None = None) -> SparkSession:
    """Session used by tests, the bench and local runs.

    On a cluster the submitter supplies the master and sizing; here only the
    settings that change plans are fixed: adaptive execution (runtime
    coalescing and skew-join splitting) and a UTC session clock.
    """
    submitted = SparkConf()
    master = master or os.environ.get("TESSERA_MASTER")
    if master is None and not submitted.contains("spark.master"):
        master = "local[*]"
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("TESSERA_SESSION_TZ", "UTC"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of operators (exact quantiles, crosstab pairs) are
        # deleted once nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, str(v))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder
    and is used as is.  Only when it is unset (tests, a laptop) is a local
    folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used by write-then-read jobs (sinks, saved models, feature tables) so that
    every executor and the driver see the same files.  What is written there
    goes with the enclosing ``lifetimes.scope``, or when the application ends.
    """
    from .lifetimes import note_folder

    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return note_folder(spark, f"{base.rstrip('/')}/tessera-scratch/{purpose}/{uuid.uuid4().hex}")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to a scratch path and read back: lineage is cut
    on shared storage, and several readers share one evaluation."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` code usable in executor Python workers.

    Pandas UDFs, row UDFs and ``mapInPandas`` functions defined here would
    be pickled by reference, so each worker would have to import the
    package.  Registering the package with cloudpickle sends their code by
    value with each task instead, so executors need no copy of the package
    and no file is written anywhere.  Only when that is unavailable is the
    package zipped and added with ``addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import tessera

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(tessera)
    except (ImportError, AttributeError, ValueError):
        _add_package_zip(sc)
    _SHIPPED.add(app)


def _add_package_zip(sc) -> None:
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, dirnames, filenames in os.walk(pkg_dir):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in filenames:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
