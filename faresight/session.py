"""Session construction and the shared working folder.

All library functions work on ``timestamp_ntz`` values that hold UTC wall-clock time and convert zones
explicitly, so results do not depend on ``spark.sql.session.timeZone``; the builder still pins it to UTC
so that printed values and the oracle check agree.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at every scale: AQE re-plans joins from runtime sizes (a small side becomes a
# broadcast, skewed partitions are split), coalesces small shuffle partitions, and dynamic partition
# overwrite lets table changes rewrite only the partitions they touch.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(master: str | None = None, app_name: str = "faresight",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return a session with the library's settings (local tests pass ``master``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the application's Python workers, as ``--py-files`` does for a submitted job; once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root, folder = os.path.dirname(os.path.abspath(__file__)), tempfile.TemporaryDirectory()
    archive = os.path.join(folder.name, f"faresight-{uuid.uuid4().hex[:12]}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for where, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(where, name)
                z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED[sc.applicationId] = folder  # Spark serves the file from here to the executors, until the driver ends


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors: the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` must name shared storage; it is only set here when it is unset
    and the master is local (tests, single-machine runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset; point it at shared storage")
        current = tempfile.mkdtemp(prefix="faresight-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, so reruns cannot collide)."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes within drop their shuffle files as each of them ends. Spark itself keeps those until the driver's garbage collection
    finds them unused, which in an idle driver is up to half an hour later, and the next write's come on top of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can open local test paths."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
