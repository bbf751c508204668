"""Session defaults and the shared scratch location.

The library never builds its own session inside an operator; jobs receive a
``SparkSession``. ``get_session`` is only a convenience for tests, the bench
and command-line runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strata") -> SparkSession:
    """The running session, or a new one.

    Without arguments nothing is tuned: shuffle partitions, AQE and scratch
    locations come from the session or ``spark-defaults.conf``. Only the two
    semantic settings the jobs rely on are set: the UTC session zone (NTZ
    input timestamps are never shifted) and dynamic partition overwrite.
    ``master`` and ``shuffle_partitions`` are for tests and the bench.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (builder.master(master)
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   # no Python call-site capture per DataFrame call (error context only);
                   # it costs several JVM round-trips for every function applied
                   .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (builder.config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.sources.partitionOverwriteMode", "dynamic").getOrCreate())
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one: an executor's own disk is not visible to the
    others. Only a local master (tests, a bare local run) gets a fresh
    temporary folder when it is unset.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: name a folder that every "
                               "executor can reach")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    except AttributeError:  # Spark Connect has no SparkContext; checkpoint() then uses the conf
        pass
    return root.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint root.

    Every job run that materialises tables gets its own folder, so reruns
    never overwrite what another run reads.
    """
    base = checkpoint_root(spark)
    path = "/".join([base, "strata", *parts, uuid.uuid4().hex])
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders this process made and returned results no
    longer read; how many there were."""
    from strata.sources import fs
    n = 0
    while _SCRATCH:
        n += fs.delete(spark, _SCRATCH.pop())
    return n
