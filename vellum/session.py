"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every vellum job relies on. AQE re-plans joins at runtime (a
# broadcast only happens after the engine has measured the smaller side) and
# splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "vellum",
                shuffle_partitions: int | None = None, driver_memory: str | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with vellum's defaults. ``driver_memory``
    matters in local mode only, where the driver JVM runs every task."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers.

    pandas UDFs and ``mapInPandas`` functions refer to vellum modules, so
    the package is zipped once per application and distributed with
    ``SparkContext.addPyFile`` (the zip is built on the driver and shipped
    by Spark to every executor).
    """
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # no SparkContext on this client (e.g. Spark Connect)
        return
    if key in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(package_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="vellum-pkg-"), "vellum.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, parent))
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    SparkContext). Only when neither is set -- a test or a laptop -- is a
    fresh local folder created and installed; a cluster without the setting
    is an error, since executors would not see a folder of the driver.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vellum-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder, for tables written to cut
    lineage and for streaming checkpoints."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    pieces = [base, "vellum", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


def cut_lineage(df, spark: SparkSession | None = None):
    """Materialise ``df`` reliably (survives executor loss) and return it.

    Uses ``DataFrame.checkpoint`` which writes to the shared checkpoint folder;
    never the executor-local variant.
    """
    spark = spark or df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so a path can be used by Python code."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path

