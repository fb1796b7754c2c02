"""The four metrics and their daily roll-up."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.functions.columns import coalesce_label, is_window_closed, safe_divide, window_closes_at
from callpay.operators.filters import only
from callpay.operators.joins import full_join_on
from callpay.operators.keys import join_per_key


def coding_rate(coded: DataFrame, agents: DataFrame) -> DataFrame:
    """Coded share of outbound calls per (local day, market, campaign, agent).

    Calls are counted before the agent join: agents are unique per key, so the
    join cannot change the counts and only sees aggregated rows.
    """
    counts = coded.groupBy(
        F.to_date("call_placed_at_local").alias("call_date_local"),
        F.col("country_name").alias("market"),
        "campaign_name",
        "agent_ameyo_user_id",
    ).agg(
        F.count(F.lit(1)).alias("total_outbound_calls"),
        F.count_if("is_coded").alias("coded_calls"),
    )
    people = agents.withColumnsRenamed({"country_name": "market", "ameyo_user_id": "agent_ameyo_user_id"})
    return join_per_key(counts, people, ["market", "agent_ameyo_user_id"]).select(
        "call_date_local",
        "market",
        "campaign_name",
        "agent_ameyo_user_id",
        F.col("atlas_user_name").alias("agent_name"),
        F.col("team").alias("agent_team"),
        F.col("has_conflicting_source_rows").alias("agent_has_conflicting_mapping"),
        "total_outbound_calls",
        "coded_calls",
        safe_divide("coded_calls", "total_outbound_calls").alias("coding_rate"),
    )


def paid_post_call(
    dispositions: DataFrame, summary: DataFrame, window_days: int = 3, as_of: datetime | None = None
) -> DataFrame:
    """Every disposition: was it followed by a payment, how much, and is that final?"""
    joined = join_per_key(dispositions, summary, ["call_log_id"])
    paid_count = F.coalesce("attributed_payment_count", F.lit(0)).cast("bigint")
    return joined.select(
        *dispositions.columns,
        "attributed_payment_amount_local",
        "attributed_payment_amount_usd",
        "first_attributed_payment_at",
        paid_count.alias("attributed_payment_count"),
        (paid_count > 0).alias("is_paid_post_call"),
        F.coalesce("has_unconverted_payment", F.lit(False)).alias("has_unconverted_payment"),
        F.coalesce("used_estimated_fx_rate", F.lit(False)).alias("used_estimated_fx_rate"),
        window_closes_at("disposed_at_utc", window_days).alias("window_closes_at_utc"),
        is_window_closed("disposed_at_utc", window_days, as_of).alias("is_window_closed"),
    )


def inbound_drivers(
    dispositions: DataFrame, inbound_type: str = "Inbound Team", missing_label: str = "Not specified"
) -> DataFrame:
    """Inbound calls per (UTC day, market, three reason levels)."""
    levels = [coalesce_label(c, missing_label).alias(c) for c in ("level_one", "level_two", "level_three")]
    return (
        only(dispositions, "call_type", inbound_type)
        .groupBy(
            F.to_date("disposed_at_utc").alias("disposition_date_utc"),
            F.col("country_name").alias("market"),
            *levels,
        )
        .agg(F.count(F.lit(1)).alias("call_count"))
    )


def daily_coding(mart: DataFrame) -> DataFrame:
    return mart.groupBy(F.col("call_date_local").alias("day"), "market").agg(
        F.sum("total_outbound_calls").alias("total_outbound_calls"), F.sum("coded_calls").alias("coded_calls")
    )


def daily_paid(mart: DataFrame) -> DataFrame:
    return mart.groupBy(F.to_date("disposed_at_utc").alias("day"), F.col("country_name").alias("market")).agg(
        F.count(F.lit(1)).alias("total_dispositions"),
        F.count_if("is_paid_post_call").alias("paid_post_call_count"),
        F.sum("attributed_payment_amount_usd").alias("value_recovered_usd"),
        (F.count_if("used_estimated_fx_rate") > 0).alias("value_recovered_usd_is_estimated"),
        F.count_if(~F.col("is_window_closed")).alias("still_in_window_count"),
    )


def daily_inbound(mart: DataFrame) -> DataFrame:
    return mart.groupBy(F.col("disposition_date_utc").alias("day"), "market").agg(
        F.sum("call_count").alias("inbound_call_count")
    )


def daily_summary(
    coding: DataFrame, paid: DataFrame, inbound: DataFrame, null_safe: bool = False
) -> DataFrame:
    """All metrics per (day, market).

    Coding counts local days, the others UTC days; they are joined as one day.
    Without ``null_safe`` a NULL market keeps one row per metric.
    """
    keys = ["day", "market"]
    both = full_join_on(daily_coding(coding), daily_paid(paid), keys, null_safe)
    merged = full_join_on(both, daily_inbound(inbound), keys, null_safe)
    return merged.select(
        *keys,
        "total_outbound_calls",
        "coded_calls",
        safe_divide("coded_calls", "total_outbound_calls").alias("coding_rate"),
        "total_dispositions",
        "paid_post_call_count",
        safe_divide("paid_post_call_count", "total_dispositions").alias("paid_post_call_rate"),
        "value_recovered_usd",
        "value_recovered_usd_is_estimated",
        "still_in_window_count",
        "inbound_call_count",
    )
