"""What each extract must look like, and the fixed lookup table of markets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callpay.operators.keys import hash_key

# Column names, order and file names of the extracts.
CALL_COLUMNS = (
    "ch_call_id", "ch_date_added", "ch_contact_center_id", "ch_system_disposition", "ch_call_type",
    "total_talk_time", "udh_user_id", "campaign_name", "udh_notes",
)
DISPOSITION_COLUMNS = (
    "call_log_id", "tenant_id", "customer_id", "contract_id", "created_timestamp_utc", "createdby",
    "call_type", "level_one", "level_two", "level_three",
)
PAYMENT_COLUMNS = (
    "pay_timestamp_utc", "tenant_id", "contract_id", "payment_request_provider", "create_program", "amount",
)
AGENT_COLUMNS = ("contact_centre", "ameyo_user_id", "team", "atlas_user_name")

# A payment is identified by everything it says; the short form is the
# three-column identity that also collapses payments differing in amount.
PAYMENT_KEY = PAYMENT_COLUMNS
# Fixed value: the columns of the short form.
PAYMENT_KEY_SHORT = ("tenant_id", "contract_id", "pay_timestamp_utc")

# Markets, their two numbering schemes, UTC offset and currency.
MARKETS = (
    ("Kenya", 1, 1001, 3, "KES"),
    ("Uganda", 2, 1002, 3, "UGX"),
    ("Tanzania", 3, 1003, 3, "TZS"),
    ("Nigeria", 4, 1004, 1, "NGN"),
)
MARKET_ORDER = tuple(m[0] for m in MARKETS)
CURRENCIES = tuple(m[4] for m in MARKETS)

# Columns of the load manifest (but for the load id) and of the rate table.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("rejected_count", T.LongType()),
        T.StructField("landed_path", T.StringType()),
        T.StructField("load_id", T.StringType()),
    ]
)

FX_SCHEMA = T.StructType(
    [
        T.StructField("rate_date", T.DateType()),
        T.StructField("currency", T.StringType()),
        T.StructField("usd_to_local_rate", T.DoubleType()),
        T.StructField("rate_is_estimated", T.BooleanType()),
        T.StructField("rate_source", T.StringType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
    ]
)


def _unchanged(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class SourceContract:
    """One extract: its file, its exact header, its grain key, its row transform."""

    name: str
    file_name: str
    columns: tuple[str, ...]
    key_columns: tuple[str, ...]
    transform: Callable[[DataFrame], DataFrame] = _unchanged

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def _with_payment_key(df: DataFrame) -> DataFrame:
    return df.withColumn("_payment_row_key", hash_key(PAYMENT_COLUMNS))


SOURCES = {
    c.name: c
    for c in (
        SourceContract("ameyo_calls", "Outbound Calls Ameyo.csv", CALL_COLUMNS, ("ch_call_id",)),
        SourceContract("atlas_dispositions", "Calls Dispositions Atlas.csv", DISPOSITION_COLUMNS, ("call_log_id",)),
        SourceContract(
            "payments", "Payments Data Atlas.csv", PAYMENT_COLUMNS, ("_payment_row_key",), _with_payment_key
        ),
        SourceContract(
            "agent_mapping", "Atlas Ameyo Mapping.csv", AGENT_COLUMNS, ("contact_centre", "ameyo_user_id")
        ),
    )
}


def country_seed(spark: SparkSession) -> DataFrame:
    """The four-row market table, as a local relation (no job, no Python rows)."""
    rows = ", ".join(f"('{n}', {c}L, {t}L, {h}L, '{cur}')" for n, c, t, h, cur in MARKETS)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS "
        "seed(country_name, ameyo_contact_center_id, atlas_tenant_id, local_tz_offset_hours, currency_code)"
    )
