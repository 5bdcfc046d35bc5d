"""Spark session for the command line and the tests.

Library functions never build or stop a session; they use the one the caller passes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution picks join strategies from measured sizes, splits skewed join
# partitions and merges small shuffle partitions. The rest keeps results independent of
# the machine and the web page closed.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def shuffle_partitions(shuffled_bytes: int, per_task: int = 256 * 1024**2) -> int:
    """Partitions that keep one shuffle task near `per_task` bytes (100 TB: about 400,000).

    Adaptive execution merges what turns out too small, so rounding up is cheap while
    too few partitions spill.
    """
    return max(200, -(-shuffled_bytes // per_task))


def build_session(
    app_name: str,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with `DEFAULTS`, overridden by `conf`.

    `master` is left to spark-submit when not given. On a cluster, pass
    `spark.checkpoint.dir` (a folder all executors reach) in `conf` or in the cluster's
    own defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
