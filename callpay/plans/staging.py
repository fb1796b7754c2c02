"""Raw text tables to typed tables: clean, cast, bridge to a market, dedupe, flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.functions.columns import clean_string, local_to_utc, try_double, try_long, try_ts
from callpay.operators.filters import drop_blank_keys
from callpay.operators.joins import bridge_market
from callpay.operators.keys import hash_key, keep_first, row_key
from callpay.sources.contracts import PAYMENT_COLUMNS, PAYMENT_KEY, PAYMENT_KEY_SHORT


def load_metadata(raw: DataFrame) -> list[Column]:
    """Where a row came from and when, as landing recorded it; NULL if it did not."""
    types = {"_source_file": "string", "_ingested_at": "timestamp_ntz"}
    return [
        (F.col(c) if c in raw.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()
    ]


def stage_calls(raw: DataFrame, seed: DataFrame) -> DataFrame:
    """Outbound calls, one row per raw row. The source clock is local; UTC is derived."""
    typed = raw.select(
        F.col("ch_call_id").alias("call_id"),
        clean_string("udh_user_id").alias("agent_ameyo_user_id"),
        clean_string("campaign_name").alias("campaign_name"),
        clean_string("ch_call_type").alias("call_dial_type"),
        clean_string("ch_system_disposition").alias("system_disposition"),
        try_long("ch_contact_center_id").alias("ameyo_contact_center_id"),
        try_double("total_talk_time").alias("total_talk_time_ms"),
        clean_string("udh_notes").alias("notes_raw"),
        try_ts("ch_date_added").alias("call_placed_at_local"),
        *load_metadata(raw),
    )
    market = ["country_name", "atlas_tenant_id", "currency_code"]
    bridged = bridge_market(typed, seed, "ameyo_contact_center_id", [*market, "local_tz_offset_hours"])
    return bridged.select(
        *typed.columns,
        *market,
        local_to_utc("call_placed_at_local", "local_tz_offset_hours").alias("call_placed_at_utc"),
    )


def stage_dispositions(raw: DataFrame, seed: DataFrame) -> DataFrame:
    """Call outcomes, one row per raw row; a missing contract stays NULL."""
    typed = raw.select(
        try_long("call_log_id").alias("call_log_id"),
        try_long("tenant_id").alias("atlas_tenant_id"),
        try_long("customer_id").alias("customer_id"),
        try_long("contract_id").alias("contract_id"),
        try_ts("created_timestamp_utc").alias("disposed_at_utc"),
        clean_string("createdby").alias("created_by"),
        clean_string("call_type").alias("call_type"),
        clean_string("level_one").alias("level_one"),
        clean_string("level_two").alias("level_two"),
        clean_string("level_three").alias("level_three"),
        *load_metadata(raw),
    )
    market = ["country_name", "ameyo_contact_center_id", "currency_code"]
    return bridge_market(typed, seed, "atlas_tenant_id", market).select(*typed.columns, *market)


def payment_key(key_cols: Sequence[str]) -> Column:
    """Readable text for the short key, SHA-256 for any other choice of columns."""
    return row_key(key_cols) if tuple(key_cols) == PAYMENT_KEY_SHORT else hash_key(key_cols)


def stage_payments(raw: DataFrame, seed: DataFrame, key_cols: Sequence[str] = PAYMENT_KEY) -> DataFrame:
    """Payments, one row per key; the earliest delivered copy stays.

    Copies are dropped on the raw columns, before any other work is done on them.
    """
    keyed = raw.select(
        payment_key(key_cols).alias("payment_row_key"), *PAYMENT_COLUMNS, *load_metadata(raw)
    )
    total_order = [F.col(c).asc_nulls_last() for c in ("_ingested_at", "_source_file", *PAYMENT_COLUMNS)]
    typed = keep_first(keyed, ["payment_row_key"], total_order).select(
        "payment_row_key",
        clean_string("payment_request_provider").alias("payment_provider"),
        clean_string("create_program").alias("ingest_program"),
        try_long("tenant_id").alias("atlas_tenant_id"),
        try_long("contract_id").alias("contract_id"),
        try_double("amount").alias("amount_local"),
        try_ts("pay_timestamp_utc").alias("paid_at_utc"),
        "_source_file",
        "_ingested_at",
    )
    market = ["country_name", "ameyo_contact_center_id", "currency_code"]
    return bridge_market(typed, seed, "atlas_tenant_id", market).select(
        *typed.columns, *market, (F.col("amount_local") == 0).alias("is_zero_amount")
    )


def stage_agents(raw: DataFrame) -> DataFrame:
    """One row per agent: named rows first, then the last team, then the last name.

    The conflict flag and the surviving row come from one map-side combined
    aggregate: structs compare field by field with NULL lowest, which is that
    preference order.
    """
    typed = drop_blank_keys(raw, "ameyo_user_id").select(
        clean_string("contact_centre").alias("country_name"),
        clean_string("ameyo_user_id").alias("ameyo_user_id"),
        clean_string("team").alias("team"),
        clean_string("atlas_user_name").alias("atlas_user_name"),
        *load_metadata(raw),
    )
    preferred = F.max(
        F.struct(
            F.col("atlas_user_name").isNotNull().alias("named"),
            "team", "atlas_user_name", "_ingested_at", "_source_file",
        )
    )
    best = typed.groupBy("country_name", "ameyo_user_id").agg(
        preferred.alias("best"), (F.count(F.lit(1)) > 1).alias("has_conflicting_source_rows")
    )
    return best.select(
        "country_name", "ameyo_user_id", "best.team", "best.atlas_user_name",
        "best._source_file", "best._ingested_at", "has_conflicting_source_rows",
    )


def stage_fx(raw: DataFrame) -> DataFrame:
    return raw.select(
        "rate_date", F.col("currency").alias("currency_code"), "usd_to_local_rate",
        "rate_is_estimated", "rate_source", "fetched_at",
    )
