"""Session helpers: a local session for tests/bench and the shared scratch folder.

Jobs never pick a machine-local temp folder on a cluster: intermediate files
(staged CSVs, published test tables, saved models) go under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests) do we create one ourselves.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "carelake") -> SparkSession:
    """Local-mode session with the settings used by tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), f"carelake-wh-{uuid.uuid4().hex[:8]}"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate data.

    Reads ``spark.checkpoint.dir`` from the session (or the context's
    checkpoint dir).  Only a session whose master is ``local`` or ``local[...]``
    (tests) gets a fresh temporary folder without one, removed when the process
    ends; elsewhere, and where the master is unknown, a missing setting is an error.
    """
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Connect session: the server side owns the checkpoint dir
        sc = None
    if conf:
        if sc is not None:
            sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    if sc is not None:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            return str(jdir.get()).rstrip("/")
    master = spark.conf.get("spark.master", "")
    if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: name a shared, durable folder for intermediate data "
            "(a machine-local folder is not visible to other executors)"
        )
    local = tempfile.mkdtemp(prefix="carelake-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    # the setting itself cannot change in a running session: the context keeps the folder, for later calls too
    sc.setCheckpointDir(local)
    return str(sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
