"""The generated tables in the roles of the pipeline's inputs.

Raw roles are all text, as the extracts are, so that every query also runs the
staging rules. ``events`` plays calls, dispositions and payments; ``customer``
plays the agent list; rates are derived from the payment days.
"""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpay.sources.contracts import MARKETS

AS_OF = datetime(2024, 1, 29)


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a lazy DataFrame; its files are listed once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("ch_call_id"),
        F.col("ts").cast("string").alias("ch_date_added"),
        (F.col("user_id") % 4 + 1).cast("string").alias("ch_contact_center_id"),
        F.col("event_type").alias("ch_system_disposition"),
        F.lit(" outbound ").alias("ch_call_type"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("total_talk_time"),
        F.col("user_id").cast("string").alias("udh_user_id"),
        F.col("event_type").alias("campaign_name"),
        F.col("props").alias("udh_notes"),
    )


def raw_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view", "signup"))
    i, u = F.col("event_id"), F.col("user_id")

    def numbered(letter: str, modulus: int):
        return F.concat(F.lit(letter), (i % modulus).cast("string"))

    return e.select(
        i.cast("string").alias("call_log_id"),
        (u % 4 + 1001).cast("string").alias("tenant_id"),
        u.cast("string").alias("customer_id"),
        F.when(i % 8 == 0, "").otherwise(u.cast("string")).alias("contract_id"),
        F.col("ts").cast("string").alias("created_timestamp_utc"),
        F.concat(F.lit("agent "), u.cast("string")).alias("createdby"),
        F.when(F.col("event_type") == "signup", "Inbound Team").otherwise("Outbound Team").alias("call_type"),
        numbered("L", 4).alias("level_one"),
        F.when(i % 3 == 0, "").otherwise(numbered("M", 5)).alias("level_two"),
        F.when(i % 2 == 0, "  ").otherwise(numbered("N", 7)).alias("level_three"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases; those of 100 and more were transmitted twice."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    i, u = F.col("event_id"), F.col("user_id")
    sent = F.explode(F.sequence(F.lit(1), F.when(F.col("value") >= 100, 2).otherwise(1)))
    return e.select(
        F.col("ts").cast("string").alias("pay_timestamp_utc"),
        (u % 4 + 1001).cast("string").alias("tenant_id"),
        u.cast("string").alias("contract_id"),
        F.when(i % 50 == 0, "MANUAL").otherwise(" mobile ").alias("payment_request_provider"),
        F.col("props").alias("create_program"),
        F.when(i % 50 == 0, "0.0").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("amount"),
        sent.alias("_sent"),
    ).drop("_sent")


def raw_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten customers per user id. One of them always names the agent, some others
    contradict it, the rest have a blank user id; every fifth name is blank."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    user = F.floor(k / 10)
    market = F.element_at(F.array(*[F.lit(m[0]) for m in MARKETS]), (user % 4 + 1).cast("int"))
    return c.select(
        market.alias("contact_centre"),
        F.when((k % 10 == 0) | (F.col("c_nationkey") < 2), user.cast("string")).otherwise("  ").alias("ameyo_user_id"),
        F.col("c_mktsegment").alias("team"),
        F.when(k % 5 == 0, " ").otherwise(F.col("c_name")).alias("atlas_user_name"),
    )


def raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate per payment day and currency; days divisible by 7 have none, even days are estimates."""
    day = F.to_date("ts")
    days = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(day.alias("rate_date")).distinct()
    currencies = F.array(
        *[F.struct(F.lit(m[4]).alias("currency"), F.lit(m[1]).alias("centre")) for m in MARKETS]
    )
    number = F.dayofmonth("rate_date")
    return (
        days.where(number % 7 != 0)
        .select("rate_date", F.explode(currencies).alias("c"))
        .select(
            "rate_date",
            F.col("c.currency").alias("currency"),
            (F.lit(100.7) + 10 * F.col("c.centre") + number).alias("usd_to_local_rate"),
            (number % 2 == 0).alias("rate_is_estimated"),
            F.when(number % 2 == 0, "latest_fallback").otherwise("history").alias("rate_source"),
            F.col("rate_date").cast("timestamp_ntz").alias("fetched_at"),
        )
    )
