"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


SHUFFLE_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 60_000
LARGE_INPUT = 10 * 1024**4


def shuffle_partitions(input_bytes: int) -> int:
    """Enough partitions that one holds about 256 MB, within what the driver can track.

    Beyond the limit partitions grow (100 TB: about 1.7 GB each) and sorts spill.
    Adaptive execution merges partitions that turn out small.
    """
    return max(200, min(MAX_SHUFFLE_PARTITIONS, -(-input_bytes // SHUFFLE_BYTES)))


def build_session(
    app: str = "callpay", master: str | None = None, cores: int | None = None, input_bytes: int | None = None
) -> SparkSession:
    """A session with the settings this package is tuned for.

    On a cluster leave ``master`` unset, spark-submit decides, and pass the size
    of the input so that windows and aggregates get partitions of a fitting size;
    very large inputs are also scanned in larger splits. ``cores`` fixes a small
    number of partitions for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if input_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
        if input_bytes >= LARGE_INPUT:
            builder = builder.config("spark.sql.files.maxPartitionBytes", "512MB")
    elif cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without the setting it is a folder below Spark's warehouse, which all executors share too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
