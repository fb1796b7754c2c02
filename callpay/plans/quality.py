"""The checks that run on the raw layer, on every model, and on load times."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.operators.checks import (
    Rule,
    accepted_range_rule,
    accepted_values_rule,
    covers_dates,
    expect_rule,
    freshness,
    has_rows_rule,
    key_present_rule,
    measure,
    measure_keys,
    not_null_rule,
    one_to_one_rule,
    relationships,
    run_suite,
    unique_combination_rule,
    unique_rule,
)
from callpay.sources.contracts import MARKETS

# The keys each raw source must always carry.
RAW_KEYS = {
    "ameyo_calls": "ch_call_id",
    "atlas_dispositions": "call_log_id",
    "payments": "_payment_row_key",
    "agent_mapping": "ameyo_user_id",
}
# What has to be fresh every day, how late it may be, and the daily deadline.
RAW_TARGETS = (*RAW_KEYS, "fx_rates")
MART_TARGETS = ("fct_coding_rate", "fct_paid_post_call", "fct_inbound_call_drivers", "agg_daily_summary")
RAW_ALLOWANCE = timedelta(hours=2)
MART_ALLOWANCE = timedelta(hours=3)
DEADLINE_HOUR = 6

# The declared checks of the models.
UNIQUE = {
    "country_code_mapping": ["country_name", "ameyo_contact_center_id", "atlas_tenant_id"],
    "stg_ameyo__calls": ["call_id"],
    "stg_atlas__dispositions": ["call_log_id"],
    "stg_atlas__payments": ["payment_row_key"],
    "int_calls__coded": ["call_id"],
    "int_payment_attribution": ["payment_row_key"],
    "int_call_payment_summary": ["call_log_id"],
    "fct_paid_post_call": ["call_log_id"],
}

UNIQUE_TOGETHER = {
    "stg_agent_mapping": ["country_name", "ameyo_user_id"],
    "stg_fx__rates": ["rate_date", "currency_code"],
    "fct_coding_rate": ["call_date_local", "market", "campaign_name", "agent_ameyo_user_id"],
    "fct_inbound_call_drivers": ["disposition_date_utc", "market", "level_one", "level_two", "level_three"],
    "agg_daily_summary": ["day", "market"],
}


def row_rules() -> dict[str, list[Rule]]:
    """Row rules per model: each model is scanned once for all of its rules."""
    return {
        "country_code_mapping": [not_null_rule(c) for c in ("country_name", "ameyo_contact_center_id", "atlas_tenant_id")],
        "stg_ameyo__calls": [
            not_null_rule("call_id"),
            accepted_values_rule("ameyo_contact_center_id", [m[1] for m in MARKETS]),
        ],
        "stg_atlas__dispositions": [
            not_null_rule("call_log_id"),
            accepted_values_rule("atlas_tenant_id", [m[2] for m in MARKETS]),
        ],
        "stg_atlas__payments": [not_null_rule("payment_row_key")],
        "stg_agent_mapping": [not_null_rule("ameyo_user_id")],
        "int_calls__coded": [not_null_rule("call_id")],
        "int_payment_attribution": [not_null_rule("payment_row_key")],
        "int_call_payment_summary": [not_null_rule("call_log_id")],
        "fct_coding_rate": [
            accepted_range_rule("total_outbound_calls", low=0),
            expect_rule("coded_calls <= total_outbound_calls"),
        ],
        "fct_paid_post_call": [not_null_rule("call_log_id"), accepted_range_rule("attributed_payment_count", low=0)],
    }


def checks_of(model: str, tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The checks to run right after one model is built."""
    df, prefix = tables[model], f"{model}."
    rules = row_rules().get(model)
    results = [measure(df, rules, prefix)] if rules else []
    keys = [unique_rule(c) for c in UNIQUE.get(model, [])]
    if model in UNIQUE_TOGETHER:
        keys.append(unique_combination_rule(UNIQUE_TOGETHER[model]))
    if model == "int_payment_attribution":
        keys.append(one_to_one_rule("payment_row_key", "attributed_call_log_id", "is_attributed_to_a_call"))
    if keys:
        results.append(measure_keys(df, keys, prefix))
    if model == "int_payment_attribution":
        results.append(
            relationships(
                df, "attributed_call_log_id", tables["stg_atlas__dispositions"], "call_log_id",
                "attributed_call_log_id IS NOT NULL", prefix,
            )
        )
    return results


def raw_checks(raw: dict[str, DataFrame], payments: DataFrame, fx: DataFrame) -> DataFrame:
    """Raw tables are not empty, their keys are filled, and every payment day has rates."""
    results = [
        measure(raw[name], [has_rows_rule(), key_present_rule(key)], f"{name}.") for name, key in RAW_KEYS.items()
    ]
    return run_suite([*results, covers_dates(payments, fx, prefix="fx_rates.")])


def freshness_checks(loads: DataFrame, builds: DataFrame, now: datetime | None = None) -> DataFrame:
    """``loads`` and ``builds``: (source_name, loaded_at) of raw sources and of published marts."""
    raw = freshness(loads, now=now, deadline_hour=DEADLINE_HOUR, allowance=RAW_ALLOWANCE, targets=RAW_TARGETS)
    marts = freshness(builds, now=now, deadline_hour=DEADLINE_HOUR, allowance=MART_ALLOWANCE, targets=MART_TARGETS)
    return raw.unionByName(marts)


def failed(results: DataFrame, severity: str = "ERROR") -> DataFrame:
    return results.where(~F.col("passed") & (F.col("severity") == severity))
