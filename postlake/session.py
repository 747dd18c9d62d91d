"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Run-time re-planning: size-checked broadcasts, coalesced shuffles and split hot partitions.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Of a repeated JSON key the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "postlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect; ``master`` only for local use."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="postlake-")
        spark.conf.set(_CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def importable_by_workers(spark: SparkSession) -> None:
    """Let Python workers of this machine find the package; on a cluster it is installed or shipped with the job."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside drops its shuffle files when it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
