"""Streaming forms of landing, dedupe and attribution.

Each run takes what has arrived since its checkpoint and stops
(``availableNow``), so a lost executor or driver resumes where it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpay.functions.columns import clock
from callpay.operators.asof import attribute_nearest
from callpay.sources.contracts import SOURCES, SourceContract
from callpay.sources.extracts import source_file, stream_files
from callpay.sources.landing import load_files, read_manifest
from callpay.sources.tables import read_or_empty
from callpay.streaming.settlement import state_on_disk


#: Bytes of new files that one micro-batch takes.
BATCH_BYTES = 64 << 30
#: Extracts that one micro-batch lands.
BATCH_FILES = 1000


def stream_table(spark: SparkSession, schema: T.StructType, path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """New Parquet files below a folder, or matching a glob, as a stream of batches of limited size."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    return reader.option("maxBytesPerTrigger", batch_bytes).parquet(path)


def stream_extract(spark: SparkSession, folder: str, contract: SourceContract) -> DataFrame:
    """New CSV files of a folder as a stream; a wrong header fails the batch."""
    schema = T.StructType([*contract.schema.fields, T.StructField("_corrupt", T.StringType())])
    records = (
        spark.readStream.schema(schema)
        .options(
            header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt",
            enforceSchema=False, columnPruning=False,
        )
        .csv(folder)
    )
    return records.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in contract.columns],
        F.col("_corrupt").alias("raw_line"),
        F.when(F.col("_corrupt").isNull(), "valid").otherwise("rejected").alias("kind"),
        source_file().alias("_source_file"),
    )


def land_extracts(
    spark: SparkSession,
    input_dir: str,
    root: str,
    checkpoint: str,
    only: Sequence[str] | None = None,
    *,
    loaded_at: datetime | None = None,
    skip_wrong_headers: bool = False,
    batch_files: int = BATCH_FILES,
) -> DataFrame:
    """Land the extracts that have arrived below a folder since the last run, and return the manifest.

    The stream finds new files, unread; every micro-batch lands its files as the batch load does: read in splits, quoted
    newlines included, refused headers and rejected rows alike, into the same tables and the same manifest. What the stream
    landed is unchanged for a batch load, and a micro-batch that is repeated finds its files in the manifest. A file
    that is replaced under its old path is not seen again; a batch load takes it. Micro-batches run
    one after another; a batch load of the same ``root`` should not run meanwhile.
    """
    contracts = [SOURCES[n] for n in only] if only is not None else list(SOURCES.values())

    def load(files: DataFrame, batch_id: int) -> None:
        load_files(files, contracts, root, loaded_at, skip_wrong_headers)

    files = stream_files(spark, input_dir, [c.file_name for c in contracts], batch_files)
    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return read_manifest(spark, root)


def land_stream(stream: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Append everything that has arrived to a Parquet table, each file exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def land_new(
    stream: DataFrame, keys: Sequence[str], out: str, checkpoint: str, order: Sequence[Column] = ()
) -> DataFrame:
    """Land one row of each key, however late a copy or the first row arrives; NULL keys equal each other.

    The keys that landed are the state of the query, kept in RocksDB below the checkpoint: a batch looks up
    its own keys and stores the new ones, and reads nothing of the landed table. Of several new rows of a key in one batch
    the first in ``order`` lands, then no later one; without ``order`` (copies are alike) any does, and the
    state holds keys alone.
    """
    spark = stream.sparkSession
    if order:
        # one time per micro-batch, the same when it is repeated
        timed = stream.withColumn("_now", F.current_timestamp())
        first = timed.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
            F.min_by(F.struct(*stream.columns), F.struct("_now", *order)).alias("_row"), F.min("_now").alias("_since")
        )
        rows = first.where(F.col("_since") == F.current_timestamp()).select("_row.*")
    else:
        rows = stream.dropDuplicates(list(keys))
    with state_on_disk(spark):
        if order:
            writer = rows.writeStream.outputMode("update").foreachBatch(
                lambda part, batch_id: part.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            )
        else:
            writer = rows.writeStream.outputMode("append").format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if not order:
        return read_or_empty(spark, out, stream.schema)
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return read_or_empty(spark, out, schema).drop("batch_id")


def attribute_stream(
    payments: DataFrame,
    dispositions: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    *,
    by: Sequence[str] = ("contract_id",),
    window_days: int = 3,
) -> DataFrame:
    """Attribute payments as they arrive against the dispositions landed so far.

    ``dispositions`` is called for every micro-batch, which so sees what has landed until
    then. A batch reads only the dispositions its own window can reach and
    writes a folder of its own, so a repeated batch replaces itself. A call that
    lands later than the payments it precedes changes nothing already written;
    the daily batch run settles such rows.
    """

    def attribute(batch: DataFrame, batch_id: int) -> None:
        span = batch.agg(F.min("paid_at_utc").alias("first"), F.max("paid_at_utc").alias("last")).first()
        reachable = dispositions()
        if span["first"] is not None:
            reachable = reachable.where(
                (F.col("disposed_at_utc") > clock(span["first"] - timedelta(days=window_days)))
                & (F.col("disposed_at_utc") <= clock(span["last"]))
            )
        attribute_nearest(
            batch, reachable, by=list(by), event_ts="paid_at_utc", anchor_ts="disposed_at_utc",
            anchor_id="call_log_id", within_days=window_days, out="attributed_call_log_id",
        ).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (
        payments.writeStream.foreachBatch(attribute)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    schema = T.StructType([*payments.schema.fields, T.StructField("attributed_call_log_id", T.LongType())])
    return payments.sparkSession.read.schema(schema).parquet(f"{out}/batch_id=*")
