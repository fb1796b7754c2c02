"""Calls matched to outcomes, payments attributed to calls, payments summed per call."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.functions.columns import convert_amount, minute_number
from callpay.operators.asof import attribute_nearest
from callpay.operators.filters import nonzero, only_true, require
from callpay.operators.joins import lookup_rate
from callpay.operators.matching import attach_match, match_ids_in_text


def code_calls(calls: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Calls whose note names a real disposition id; the smallest such id is kept."""
    matched = match_ids_in_text(
        require(calls, "notes_raw"), "call_id", "notes_raw",
        dispositions, "call_log_id", "matched_call_log_id",
    )
    return attach_match(calls, matched, "call_id").select(
        *calls.columns,
        "matched_call_log_id",
        F.col("matched_call_log_id").isNotNull().alias("is_coded"),
    )


def attribute_payments(
    payments: DataFrame,
    dispositions: DataFrame,
    fx: DataFrame,
    window_days: int = 3,
    by: Sequence[str] = ("contract_id",),
    slice_of: Callable[[str], Column] = minute_number,
) -> DataFrame:
    """Every non-zero payment with the nearest preceding call on its contract and its USD value.

    A payment whose amount could not be read has no zero flag and is left out too.
    """
    nearest = attribute_nearest(
        nonzero(payments),
        require(dispositions, "contract_id"),
        by=list(by),
        event_ts="paid_at_utc",
        anchor_ts="disposed_at_utc",
        anchor_id="call_log_id",
        within_days=window_days,
        out="attributed_call_log_id",
        slice_of=slice_of,
    )
    return lookup_rate(nearest, fx, "currency_code", "paid_at_utc").select(
        *payments.columns,
        "attributed_call_log_id",
        "usd_to_local_rate",
        "fx_rate_is_estimated",
        F.col("attributed_call_log_id").isNotNull().alias("is_attributed_to_a_call"),
        convert_amount("amount_local", "usd_to_local_rate").alias("amount_usd"),
    )


def summarise_payments(attribution: DataFrame) -> DataFrame:
    """One row per call with attributed payments. Sums skip what has no rate; a flag says so."""
    return (
        only_true(attribution, "is_attributed_to_a_call")
        .groupBy(F.col("attributed_call_log_id").alias("call_log_id"))
        .agg(
            F.count(F.lit(1)).alias("attributed_payment_count"),
            F.sum("amount_local").alias("attributed_payment_amount_local"),
            F.sum("amount_usd").alias("attributed_payment_amount_usd"),
            (F.count_if(F.col("amount_usd").isNull()) > 0).alias("has_unconverted_payment"),
            (F.count_if(F.coalesce("fx_rate_is_estimated", F.lit(False))) > 0).alias("used_estimated_fx_rate"),
            F.min("paid_at_utc").alias("first_attributed_payment_at"),
        )
    )
