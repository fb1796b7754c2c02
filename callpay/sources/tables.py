"""Tables on shared storage: models, the rate table, the manifest, exports."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpay.operators.fx import upsert_by_key
from callpay.sources.contracts import FX_SCHEMA


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty one of that schema where the path does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def materialize(df: DataFrame, name: str, kind: str, root: str | None = None) -> DataFrame:
    """Publish a model under ``name``: lazily as a view, or rebuilt in full as a Parquet table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}, expected 'view' or 'table'")
    path = f"{root}/{name}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.createOrReplaceTempView(name)
    return stored


RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("as_of", T.TimestampNTZType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("published_at", T.TimestampNTZType()),
    ]
)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """Published runs; the largest ``sequence`` is the last one published, whatever clock it ran for."""
    return read_or_empty(spark, f"{root}/runs", RUNS_SCHEMA)


def record_run(spark: SparkSession, root: str, run_id: str, path: str, as_of: datetime) -> None:
    """Publish a finished run: from now on it is the one consumers read. Runs of one root publish one by one."""
    last = read_runs(spark, root).agg(F.max("sequence").alias("n")).first().n or 0
    published = datetime.now(timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(run_id, path, as_of, last + 1, published)], RUNS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/runs")


def read_mart(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A whole mart: from the session's views, or of the latest published run below ``root``."""
    if root is None:
        return spark.table(name)
    latest = read_runs(spark, root).agg(F.max(F.struct("sequence", "path")).alias("r")).first().r
    if latest is None:
        raise LookupError(f"no run was published below {root}")
    return spark.read.parquet(f"{latest.path}/{name}")


VERSIONS_SCHEMA = T.StructType(
    [
        T.StructField("sequence", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("rate_date", T.DateType()),
    ]
)


def _rate_versions(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/versions", VERSIONS_SCHEMA)


def ensure_fx_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored rates as last published; empty before anything was stored.

    Every change writes the days it touches to a folder of its own and is published by one file that names them; of each
    day the last published folder counts. Files are never changed or removed, so who reads on keeps the rates of
    the time of this call, and what a failed change left behind is not read.
    """
    published = _rate_versions(spark, path)
    last = published.groupBy(F.col("rate_date").alias("_day")).agg(
        F.max(F.struct("sequence", "version"))["version"].alias("_version")
    )
    # listed after the versions, so that all folders they name are there
    schema = T.StructType([*FX_SCHEMA.fields, T.StructField("version", T.StringType())])
    stored = read_or_empty(spark, f"{path}/data", schema)
    current = stored.join(last, (stored.version == F.col("_version")) & stored.rate_date.eqNullSafe(F.col("_day")))
    return current.select(*FX_SCHEMA.names)


def store_rates(spark: SparkSession, path: str, updates: DataFrame) -> DataFrame:
    """Upsert by (rate_date, currency), writing only the days that ``updates`` touches.

    All days change at once when the version is published. Runs that store to one path do so one by one.
    """
    days = updates.select(F.col("rate_date").alias("_day")).distinct()
    stored = ensure_fx_table(spark, path)
    touched = stored.join(days, stored.rate_date.eqNullSafe(F.col("_day")), "left_semi")
    merged = upsert_by_key(touched, updates, ["rate_date", "currency"])
    version = uuid.uuid4().hex
    merged.select(*FX_SCHEMA.names).repartition("rate_date").write.partitionBy("rate_date").parquet(
        f"{path}/data/version={version}"
    )
    before = _rate_versions(spark, path).agg(F.max("sequence").alias("n")).first().n or 0
    written = spark.read.schema(FX_SCHEMA).parquet(f"{path}/data/version={version}").select("rate_date").distinct()
    published = written.select(F.lit(before + 1).cast("bigint").alias("sequence"), F.lit(version).alias("version"), "rate_date")
    published.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return ensure_fx_table(spark, path)


def export_json_by_date(df: DataFrame, path: str, date_col: str) -> None:
    """JSON lines under ``y=/m=/d=``, one file per day; days not in ``df`` are left alone."""
    (
        df.withColumns(
            {
                "y": F.date_format(date_col, "yyyy"),
                "m": F.date_format(date_col, "MM"),
                "d": F.date_format(date_col, "dd"),
            }
        )
        .repartition("y", "m", "d")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("y", "m", "d")
        .json(path)
    )
