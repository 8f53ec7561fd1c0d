"""Session set-up and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "pluvia", **conf: str) -> SparkSession:
    """A UTC session with AQE on. Cluster settings win: only ``master`` and ``conf`` are forced."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="pluvia-")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/pluvia/{label}-{uuid.uuid4().hex}"


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for stateful streams, whose shuffle is not resized by AQE.

    Every state partition is a task in every micro-batch, and a stream's checkpoint fixes
    their number. ``partitions`` sets it; by default it is that of the given session.
    """
    session = spark.newSession()
    count = partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session
