"""Session defaults and the shared scratch folder.

Nothing here overrides a setting that a session or a cluster already made:
defaults are for new local sessions only, and the scratch folder is read
from ``spark.checkpoint.dir``.  A folder of our own is set only where none is
configured and the master is local (tests); elsewhere that is an error, as
executors don't share the driver's temp folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app: str = "ashgrid",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """The session there is, or a new one; defaults only for a new local one.

    ``conf`` is what the caller asks for and is always applied.
    """
    b = SparkSession.builder
    settings: dict[str, str] = {}
    if SparkSession.getActiveSession() is None:
        b = b.appName(app)
        if master:
            b = b.master(master)
        if (master or "").startswith("local"):
            settings.update(LOCAL_DEFAULTS)
        if shuffle_partitions:
            settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set one under the local temp folder only when a local session has none,
    as in tests; a cluster must name a location that its executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ashgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/ashgrid/{name}-{uuid.uuid4().hex}"
