"""Session settings the library relies on.

* ``spark.sql.optimizer.windowGroupLimitThreshold``: the bottom-k step is a
  ``row_number() <= k + 2`` filter.  Spark only turns it into a partial group
  limit *before* the shuffle (each task then sends at most k + 2 rows per
  group) while the limit is below this threshold, whose default (1000) is
  under the default k.  :func:`ensure_group_limit` raises it, never lowers it.
* the session time zone: week/day buckets of ``TIMESTAMP_NTZ`` columns are
  computed with ``date_trunc``, which goes through the session zone.
* ``spark.checkpoint.dir``: lineage cuts and written intermediate tables go
  to the shared folder the cluster names there; only when it is unset (local
  tests) is a scratch folder chosen.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def ensure_group_limit(spark: SparkSession, k: int) -> None:
    """Make ``row_number() <= k + 2`` plan as a partial + final group limit."""
    need = k + 3
    current = spark.conf.get(GROUP_LIMIT_CONF, "1000")
    try:
        cur = int(current)
    except ValueError:
        cur = 1000
    if cur < need:
        spark.conf.set(GROUP_LIMIT_CONF, str(max(need, 65536)))


def configure(spark: SparkSession, k_max: int = 65536) -> SparkSession:
    """Apply the recommended settings to an existing session."""
    ensure_group_limit(spark, k_max)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a scratch one only for a
    local session where it is unset (tests)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    d = (sc.getCheckpointDir() if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return (sc.getCheckpointDir() if sc is not None else None) or d
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster; "
                           "written intermediates and lineage cuts go there")
    d = tempfile.mkdtemp(prefix="tuplecohort-ckpt-")  # local sessions (tests) only
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for a written intermediate table."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name + "-" + os.urandom(6).hex()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tuplecohort") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config(GROUP_LIMIT_CONF, "65536")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
