"""Session helpers.

On a cluster the session comes from the platform; the job reads its settings
(``spark.checkpoint.dir`` above all) and sets nothing it finds set. Local
sessions for tests and the benchmark get the same knobs with local sizes.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the job is written for. Sizes are for a large cluster; local runs
# override the partition count.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even when the operator after the join
    # (the residence and profile aggregates) would otherwise reuse the join's
    # partitioning: the split costs one extra shuffle, a hot task costs more
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # small dimensions (places, cohort ids when small) are broadcast by
    # Spark's own size check at plan time and again by AQE at run time
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # partitioned writes by service (5 values) use one open writer per value
    # instead of sorting every task's rows by the partition column; past 8
    # values a task falls back to sorting the rest (bounded writer memory)
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    # upper bound for the first shuffles of a 100 TB run; AQE coalesces
    # small stages down to the advisory size
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "regstat",
    extra: dict | None = None,
) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(RECOMMENDED)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("REGSTAT_DRIVER_MEMORY", "8g"),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
        }
    )
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on a Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def apply_recommended(spark: SparkSession) -> None:
    """Set the ``RECOMMENDED`` values that can change at run time and that
    the session does not set itself."""
    sc = _context(spark)
    given = dict(sc.getConf().getAll()) if sc is not None else {}
    for key, value in RECOMMENDED.items():
        if key not in given and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named in ``spark.checkpoint.dir``, if any."""
    sc = _context(spark)
    if sc is None:
        return ensure_checkpoint_dir(spark)
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only when it is unset (local tests) a fresh
    scratch folder is made and registered."""
    sc = _context(spark)
    if sc is None:
        try:
            return spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            return None
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
        return d
    current = sc.getCheckpointDir()
    if current:
        return current
    d = tempfile.mkdtemp(prefix="regstat-ckpt-", dir=os.environ.get("REGSTAT_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return d
