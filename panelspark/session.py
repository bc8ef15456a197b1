"""Session construction and cluster-level settings.

Only settings that are *unset* are filled in, so a cluster's own
configuration (shuffle partitions, checkpoint dir, broadcast threshold)
always wins over these local defaults.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults for a single-host run.  On a cluster these are normally already
# set by spark-defaults.conf / spark-submit and are left alone.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast decisions use measured sizes of finished
    # stages, so a dimension is only broadcast when it really is small.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python (HTML parsing) bounded by bytes, not only by
    # row count: a batch of 10,000 multi-MB pages would not fit a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, app_name: str = "panelspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session.  ``master``/``shuffle_partitions`` are for
    local runs and tests; leave them ``None`` under spark-submit."""
    from pyspark import SparkConf

    submitted = SparkConf()            # spark-submit / spark-defaults values
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # defaults only where the cluster left a setting unset; explicit
    # arguments (master, shuffle_partitions, extra) always apply
    conf = {k: v for k, v in LOCAL_DEFAULTS.items() if not submitted.contains(k)}
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(explicit)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate() may return an existing session: apply runtime SQL
    # settings that were asked for explicitly, and defaults where unset.
    for k, v in conf.items():
        if (k.startswith("spark.sql.") and spark.conf.isModifiable(k)
                and (k in explicit or spark.conf.get(k, None) is None)):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``).  Only when it is unset (local tests) is a
    fresh scratch folder created and registered."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="panelspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
