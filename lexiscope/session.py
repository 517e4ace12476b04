"""Session and shared-storage helpers.

Jobs never create machine-local scratch space on a cluster: lineage is cut with
``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests, the
bench) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lexiscope`` importable in Python workers (once per SparkContext).

    Arrow UDFs are pickled by reference to their module, so executors must be
    able to import the package.  The package folder is zipped once and added
    with ``addPyFile`` (on a cluster, ``--py-files`` does the same up front).
    """
    import shutil

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = tempfile.mkdtemp(prefix="lexiscope-pyfiles-")
    archive = shutil.make_archive(os.path.join(base, "lexiscope"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir="lexiscope")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def build_session(master: str | None = None, app: str = "lexiscope",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/dev session with the settings the jobs are tuned for.

    On a cluster the submitter's settings win: an active session is returned
    as it is (``builder.config`` would otherwise overwrite its SQL settings,
    e.g. shuffle partitions sized for the driver's cores).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    own = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    }
    submitted = submitted_settings()
    for key, value in own.items():
        if key not in submitted:
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def submitted_settings() -> set[str]:
    """Names of the settings given to ``spark-submit``; empty in a plain Python process."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return set()
    from pyspark import SparkConf, SparkContext

    SparkContext._ensure_initialized()  # the submitting JVM holds them
    return {key for key, _ in SparkConf().getAll()}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    else:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexiscope-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as it lies; Parquet splits at row groups, so write them at about 128 MB."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
