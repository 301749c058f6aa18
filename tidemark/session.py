"""Session settings for local runs, and the shared scratch folder for written tables."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A local session tuned like the tests and bench (UI off, AQE on, UTC)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("tidemark")
    settings = dict(LOCAL_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session without one gets a fresh local folder if its master is local,
    as in tests; on a cluster that would be a folder of one machine, so it
    raises there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master or ""):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared checkpoint root for one written table or tree."""
    return f"{checkpoint_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()
_ship_lock = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (once per application).

    Zips the installed package on the driver and adds it with ``addPyFile``,
    Spark's way of distributing Python code to executors. Needed where
    worker-side Python imports package code (the scan data source).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _ship_lock:
        if app in _shipped:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="tidemark-pyfiles-"), "tidemark.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for base, _dirs, files in os.walk(pkg_dir):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(base, f)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
        sc.addPyFile(out)
        _shipped.add(app)
