"""Session factory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

MB = 1 << 20


def shuffle_width(input_bytes: int, partition_bytes: int = 256 * MB) -> int:
    """Shuffle partitions for a job that moves its whole input, 200 at least."""
    return max(200, -(-input_bytes // partition_bytes))


def get_spark(
    app_name: str = "tallyshelf",
    cores: str | int | None = None,
    *,
    input_bytes: int | None = None,
    hive: bool = False,
    log_level: str = "ERROR",
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Build a session for the library's jobs, or get the running one.

    A running session keeps its settings; only ``conf`` is applied to it.

    ``cores`` gives ``local[cores]`` and 16 shuffle partitions; without it the
    master and the width are those of ``spark-submit``, which is how a cluster run
    starts. AQE merges
    small shuffle partitions but does not add any outside skewed joins and
    rebalanced writes, so a large job should state its ``input_bytes`` (or the
    width itself in ``conf``). A join whose shuffled partitions all turn out
    below 64 MB is hashed instead of sorted; AQE decides on the measured sizes.
    Memory and scratch folders are left to the cluster. ``hive=True`` asks for a
    persistent metastore; the catalog functions also run on the in-memory catalog.
    """
    settings = dict(conf or {})
    if SparkSession.getActiveSession() is None:
        settings = _defaults(cores, input_bytes) | settings
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def _defaults(cores: str | int | None, input_bytes: int | None) -> dict[str, str]:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    }
    if cores is not None:
        settings["spark.master"] = f"local[{cores}]"
        settings["spark.sql.shuffle.partitions"] = "16"
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_width(input_bytes))
    return settings
