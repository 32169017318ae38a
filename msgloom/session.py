"""Session helpers: settings the jobs rely on and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for a cluster session. Adaptive execution sizes shuffles, splits skewed joins
# and picks broadcast joins from measured sizes.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the cluster settings, then the caller's own on top.

    A keyword stands for a setting name with ``__`` in place of the dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    own = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**CLUSTER_SETTINGS, **own}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each write in here removes its shuffle files as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of all
    steps of a job stand on the disks together. For writes only: a frame that is itself run
    again would have to be shuffled again. The setting is put back at the end.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder the session names.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its own;
    on a cluster a machine-local path would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="msgloom-")
    return f"{base.rstrip('/')}/msgloom/{name}-{uuid.uuid4().hex[:12]}"
