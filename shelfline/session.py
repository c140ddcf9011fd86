"""Session settings and the shared folder that written tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "shelfline", **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    ``master`` is only passed for local runs; on a cluster the submit tool sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="shelfline-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/shelfline/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in sessions that did not set a folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
