"""Exchange rates: which are needed, how they are resolved, how they are stored.

Rate sources are tables (history per day and currency, latest per currency);
fetching them is outside this package.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callpay.functions.columns import clock
from callpay.operators.filters import require
from callpay.sources.contracts import CURRENCIES, FX_SCHEMA

# How a stored rate says where it came from, and how a run ended.
FROM_HISTORY = "history"
FROM_LATEST = "latest_fallback"
NO_SOURCE = "no_api_key"
UP_TO_DATE = "up_to_date"
OK = "ok"
PARTIAL = "partial_failure"


def rates_from_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Rates given as literal rows (rate_date, currency, rate, is_estimated, source, fetched_at)."""
    return spark.createDataFrame(list(rows), FX_SCHEMA)


def _payment_days(payments: DataFrame, ts: str | Column) -> DataFrame:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return payments.select(F.to_date(ts).alias("rate_date")).where("rate_date IS NOT NULL").distinct()


def needed_dates(payments: DataFrame, ts: str | Column = "paid_at_utc") -> DataFrame:
    """Distinct calendar days on which a payment was made, in order."""
    return _payment_days(payments, ts).orderBy("rate_date")


def missing_rates(
    payments: DataFrame,
    cached: DataFrame,
    currencies: Sequence[str] = CURRENCIES,
    ts: str | Column = "paid_at_utc",
) -> DataFrame:
    """(rate_date, currency) pairs that payments need and ``cached`` lacks.

    The currencies are a short literal list, so they are exploded, not cross joined.
    """
    wanted = _payment_days(payments, ts).select(
        "rate_date", F.explode(F.array(*[F.lit(c) for c in currencies])).alias("currency")
    )
    return wanted.join(cached.select("rate_date", "currency"), ["rate_date", "currency"], "left_anti")


def resolve_rates(
    missing: DataFrame, history: DataFrame, latest: DataFrame, fetched_at: datetime | None = None
) -> DataFrame:
    """A rate for each missing pair.

    A day that ``history`` serves uses history only, also when one currency is
    absent from it. Any other day falls back to ``latest``, flagged estimated.
    What stays without a rate keeps NULL: with ``rate_source`` set when the day
    was served, without when the day failed altogether.
    """
    served = history.select("rate_date").distinct().withColumn("_served", F.lit(True))
    past = history.select("rate_date", "currency", F.col("usd_to_local_rate").alias("_past"))
    now = latest.select("currency", F.col("usd_to_local_rate").alias("_now"))
    any_latest = latest.select(F.count(F.lit(1)) > 0).scalar()
    joined = (
        missing.join(served, "rate_date", "left")
        .join(past, ["rate_date", "currency"], "left")
        .join(now, "currency", "left")
        .withColumn("_served", F.coalesce("_served", F.lit(False)))
    )
    return joined.select(
        "rate_date",
        "currency",
        F.when(F.col("_served"), F.col("_past")).otherwise(F.col("_now")).alias("usd_to_local_rate"),
        (~F.col("_served")).alias("rate_is_estimated"),
        F.when(F.col("_served"), F.lit(FROM_HISTORY)).when(any_latest, F.lit(FROM_LATEST)).alias("rate_source"),
        clock(fetched_at).alias("fetched_at"),
    )


def resolved_only(resolved: DataFrame) -> DataFrame:
    return resolved.where("usd_to_local_rate IS NOT NULL").select(*FX_SCHEMA.names)


def fx_summary(needed: DataFrame, resolved: DataFrame, source_given: bool = True) -> DataFrame:
    """One row: status, rows_upserted, dates_needed, dates_failed."""
    per_day = resolved.groupBy("rate_date").agg(
        F.count("usd_to_local_rate").alias("rows"), F.count("rate_source").alias("sourced")
    )
    if not source_given:
        zero = F.lit(0).cast("bigint")
        return per_day.agg(F.count(F.lit(1)).alias("_n")).select(
            F.lit(NO_SOURCE).alias("status"),
            zero.alias("rows_upserted"),
            zero.alias("dates_needed"),
            zero.alias("dates_failed"),
        )
    all_days = needed.select(F.count(F.lit(1))).scalar()
    totals = per_day.agg(
        F.count(F.lit(1)).alias("missing_days"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_upserted"),
        F.count_if(F.col("sourced") == 0).alias("dates_failed"),
    )
    nothing = F.col("missing_days") == 0
    return totals.select(
        F.when(nothing, UP_TO_DATE).when(F.col("dates_failed") == 0, OK).otherwise(PARTIAL).alias("status"),
        "rows_upserted",
        F.when(nothing, all_days).otherwise(F.col("missing_days")).alias("dates_needed"),
        "dates_failed",
    )


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with every row of ``updates`` replacing or joining it by key.

    Fails when ``updates`` names one key twice, as a MERGE would.
    """
    repeated = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("_n"))
    refused = repeated.select(
        F.when(F.col("_n") > 1, F.raise_error(F.lit(f"updates repeat a key of {list(keys)}")).cast("boolean"))
        .otherwise(F.lit(False))
    ).scalar()
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.where(~refused).select(*target.columns))


def latest_rates(fx: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` rate rows: newest day first, then by currency."""
    return fx.orderBy(F.col("rate_date").desc(), F.col("currency")).limit(n)


def uncovered_dates(payments: DataFrame, fx: DataFrame, dates_only: bool = False) -> DataFrame:
    """Payment days (per currency unless ``dates_only``) for which no rate is stored."""
    keys = ["rate_date"] if dates_only else ["rate_date", "currency_code"]
    days = payments.select(F.to_date("paid_at_utc").alias("rate_date"), "currency_code")
    needed = require(days.select(*keys), *keys).distinct()
    return needed.join(fx.select(*keys), keys, "left_anti")
