"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults applied only when the launcher has not set them (spark-submit and
# cluster configs win).  Local test runs get a small shuffle width.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "cardpulse", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session; ``master`` / partitions only matter for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        # local mode: the driver JVM is the executor; give it a real heap
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("CARDPULSE_DRIVER_MEMORY", "12g"))
    given = SparkConf()  # what spark-submit or the launcher set
    for key, value in _LOCAL_DEFAULTS.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    """One JVM; ``local-cluster`` is a cluster."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; only when it is unset on a local master (tests) do
    we pick a folder of our own under the system temp dir.  On a cluster such a
    folder would be another one on each machine, so an unset directory is an
    error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path and not _is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        path = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"cardpulse-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint dir (never a node-local tmp)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{base}/cardpulse/{leaf}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cardpulse`` importable in Python workers (pandas UDFs, state).

    On a cluster the package is shipped with ``--py-files``; when running
    from a source checkout with a local checkpoint folder (tests, local
    runs) it is zipped there once per application and added with
    ``addPyFile``.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    base = ensure_checkpoint_dir(spark)
    if "://" in base and not base.startswith("file:"):
        _SHIPPED.add(sc.applicationId)  # remote FS: rely on --py-files
        return
    local = base[len("file:"):] if base.startswith("file:") else base
    pkg = os.path.dirname(os.path.abspath(__file__))
    out_dir = os.path.join(local, "cardpulse", "pyfiles")
    os.makedirs(out_dir, exist_ok=True)
    target = os.path.join(out_dir, f"cardpulse-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
