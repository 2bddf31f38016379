"""Session settings the operators rely on, and a checkpoint-folder lookup."""

from __future__ import annotations


from pyspark.sql import SparkSession

# Adaptive execution re-plans joins from real shuffle sizes (sort-merge to
# broadcast only below the broadcast threshold), merges small shuffle
# partitions and splits skewed join partitions, e.g. one customer or product
# that holds a third of the rows.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "revlens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with adaptive execution and the UI off.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` so a
    partition holds about 128-256 MB before adaptive coalescing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        **ADAPTIVE_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Where it is unset, ``fallback`` (tests) or a
    folder in the session's warehouse, which driver and executors share, is
    registered with the SparkContext, since the setting itself cannot change on
    a running session.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    registered = sc._jsc.sc().getCheckpointDir()
    if registered.isDefined():
        return registered.get()
    if fallback is None:
        fallback = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/revlens-checkpoints"
    sc.setCheckpointDir(fallback)
    return fallback
