"""Join shapes the models share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.operators.keys import join_keys, join_per_key


def bridge_market(df: DataFrame, seed: DataFrame, on: str, wanted: Sequence[str]) -> DataFrame:
    """Left join to the four-row market seed; an unknown id gives a NULL market."""
    return df.join(F.broadcast(seed.select(on, *[c for c in wanted if c != on])), on, "left")


def lookup_rate(df: DataFrame, fx: DataFrame, currency: str, ts: str) -> DataFrame:
    """Attach the rate of the row's own currency and day, or NULL.

    No hint: adaptive execution broadcasts the rates if they turn out small.
    """
    keys = ["_fx_currency", "_fx_date"]
    rates = fx.select(
        F.col("currency_code").alias("_fx_currency"),
        F.col("rate_date").alias("_fx_date"),
        "usd_to_local_rate",
        F.col("rate_is_estimated").alias("fx_rate_is_estimated"),
    )
    dated = df.withColumns({"_fx_currency": F.col(currency), "_fx_date": F.to_date(F.col(ts))})
    return join_per_key(dated, rates, keys).drop(*keys)


def full_join_on(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Full outer join with merged keys. By default a NULL key matches nothing."""
    joined = join_keys(a, b, keys, "full", null_safe)
    merged: list[Column] = [F.coalesce(F.col(k), F.col(f"_b_{k}")).alias(k) for k in keys]
    rest = [c for c in (*a.columns, *b.columns) if c not in keys]
    return joined.select(*merged, *rest)


def in_order(df: DataFrame, c: str, order: Sequence[str]) -> DataFrame:
    """Only the listed categories, in the listed order."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(c))
    return df.where(F.col(c).isin(list(order))).orderBy(position)
