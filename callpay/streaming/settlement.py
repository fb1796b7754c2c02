"""Payments attributed with state: a call that lands after the payments it precedes still settles them.

Two streams, each with a watermark. A left outer interval join keeps payments and calls in the state store until the
watermark says that no call can come any more; a second stateful step folds the calls of a payment to the latest
one. It combines in the task that joins, so that pairs of a payment and a call are never shuffled, stored or written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpay.functions.columns import days

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, outside the heap; each batch stores what it changed."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _instant(ts: str) -> Column:
    """A zone-less time as the instant it names in UTC, whatever the session zone; watermarks take no other type."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts)))


def settled(
    payments: DataFrame,
    calls: DataFrame,
    *,
    by: Sequence[str],
    paid_at: str,
    called_at: str,
    call_id: str,
    window_days: int,
    late_days: int,
    out: str,
    spread: int = 1,
) -> DataFrame:
    """Streaming ``payments`` plus ``out``, the latest call of the key in (payment - N days, payment].

    Rows may arrive in any order within ``late_days`` of the newest row of the slower stream; a payment comes out once,
    when no such call can follow. Later calls change nothing and later payments are dropped, as
    watermarks go. Payments must differ in some column. Those without key or time come out
    with NULL, untimed ones at once. Calls of one instant: the highest id wins.

    ``spread`` deals the payments of one key over so many tasks, each of which sees all its calls: for streams in
    which one key holds much of the rows.
    """
    late = f"{late_days} days"
    dealt = F.pmod(F.xxhash64(*payments.columns), F.lit(spread))
    timed = payments.where(F.col(paid_at).isNotNull()).withColumns({"_deal": dealt, "_paid_at": _instant(paid_at)})
    known = calls.select(
        *[F.col(c).alias(f"_c_{c}") for c in by], _instant(called_at).alias("_called_at"), F.col(call_id).alias("_call_id")
    ).where(" AND ".join(f"_c_{c} IS NOT NULL" for c in by) + " AND _called_at IS NOT NULL")
    every = known.withColumn("_c_deal", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<bigint>")))
    on = (F.col("_deal") == F.col("_c_deal")) & (F.col("_called_at") <= F.col("_paid_at"))
    on = on & (F.col("_called_at") > F.col("_paid_at") - days(window_days))
    for c in by:
        on = on & (F.col(c) == F.col(f"_c_{c}"))
    pairs = timed.withWatermark("_paid_at", late).join(every.withWatermark("_called_at", late), on, "left_outer")
    call = F.when(F.col("_called_at").isNotNull(), F.struct("_called_at", "_call_id"))
    latest = pairs.groupBy(*payments.columns, "_paid_at").agg(F.max(call).alias("_call"))
    found = latest.select(*payments.columns, F.col("_call._call_id").alias(out))
    untimed = payments.where(F.col(paid_at).isNull())
    none = F.lit(None).cast(calls.schema[call_id].dataType).alias(out)
    return found.unionByName(untimed.select(*payments.columns, none))


def settle_stream(
    payments: DataFrame,
    calls: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    by: Sequence[str] = ("contract_id",),
    window_days: int = 3,
    late_days: int = 3,
    spread: int = 1,
) -> DataFrame:
    """Take what has arrived in both streams and append the payments that are settled by now; returns all so far.

    A run ends when the arrivals are worked off; the next one goes on from the checkpoint, state
    included. A far row in both streams (``closing_row``) settles everything before it.
    """
    spark = payments.sparkSession
    rows = settled(
        payments, calls, by=list(by), paid_at="paid_at_utc", called_at="disposed_at_utc", call_id="call_log_id",
        window_days=window_days, late_days=late_days, out="attributed_call_log_id", spread=spread,
    )
    with state_on_disk(spark):
        (
            rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(out_path).awaitTermination()
        )
    return spark.read.schema(T.StructType(list(rows.schema.fields))).parquet(out_path)


def closing_row(stream: DataFrame, **cells: object) -> DataFrame:
    """One row of the stream's columns, NULL but for ``cells``: a mark that nothing earlier than its time follows.

    Give it a far time and, for calls, a key that does not occur: rows without a key never get as far as a watermark.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    row = [F.lit(cells.get(c)).cast(t).alias(c) for c, t in kinds.items()]
    return stream.sparkSession.range(1).select(*row)
