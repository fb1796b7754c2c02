"""Questions asked of the marts: slices, totals, market roll-ups, drill-downs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpay.functions.columns import clock, safe_divide
from callpay.operators.filters import only, require
from callpay.sources.contracts import MARKET_ORDER


def slice_mart(
    df: DataFrame,
    markets: Sequence[str],
    days: Sequence[date] = (),
    market_col: str = "market",
    day_col: str = "day",
) -> DataFrame:
    """Rows of the chosen markets and days. No markets: no rows. No days: every day.

    For a timestamp column the enclosing time range is added, which unlike the
    day expression reaches the Parquet scan.
    """
    chosen = df.where(F.col(market_col).isin(list(markets)))
    if not days:
        return chosen
    if isinstance(df.schema[day_col].dataType, T.DateType):
        return chosen.where(F.col(day_col).isin(list(days)))
    start = datetime.combine(min(days), datetime.min.time())
    end = datetime.combine(max(days) + timedelta(days=1), datetime.min.time())
    return chosen.where((F.col(day_col) >= clock(start)) & (F.col(day_col) < clock(end))).where(
        F.to_date(day_col).isin(list(days))
    )


def present_markets(a: DataFrame, b: DataFrame, order: Sequence[str] = MARKET_ORDER) -> DataFrame:
    """Markets found in either mart, in the fixed order."""
    found = a.select("market").unionAll(b.select("market")).where(F.col("market").isin(list(order))).distinct()
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("market"))
    return found.select("market", position.alias("position")).orderBy("position")


def present_days(df: DataFrame, day_col: str = "day") -> DataFrame:
    return df.select(F.col(day_col).alias("day")).where("day IS NOT NULL").distinct().orderBy("day")


def kpi_totals(daily: DataFrame) -> DataFrame:
    """One row of headline totals for a slice of the daily summary."""

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).alias(c)

    totals = daily.agg(
        total("total_outbound_calls"),
        total("coded_calls"),
        total("total_dispositions"),
        total("paid_post_call_count"),
        F.sum("value_recovered_usd").alias("value_recovered_usd"),
        F.coalesce(F.bool_or("value_recovered_usd_is_estimated"), F.lit(False)).alias(
            "value_recovered_usd_is_estimated"
        ),
        total("inbound_call_count"),
        total("still_in_window_count"),
    )
    return totals.withColumns(
        {
            "coding_rate": safe_divide("coded_calls", "total_outbound_calls"),
            "paid_post_call_rate": safe_divide("paid_post_call_count", "total_dispositions"),
        }
    )


def market_coding(mart: DataFrame) -> DataFrame:
    return (
        require(mart, "market")
        .groupBy("market")
        .agg(F.sum("total_outbound_calls").alias("total_outbound_calls"), F.sum("coded_calls").alias("coded_calls"))
        .withColumn("coding_rate", safe_divide("coded_calls", "total_outbound_calls"))
    )


def market_paid(mart: DataFrame) -> DataFrame:
    """Per market; the rate counts only dispositions that have a contract."""
    return (
        require(mart, "country_name")
        .groupBy(F.col("country_name").alias("market"))
        .agg(
            F.count("call_log_id").alias("total_dispositions"),
            F.count("contract_id").alias("with_contract"),
            F.count_if("is_paid_post_call").alias("paid_post_call"),
            F.sum("attributed_payment_amount_local").alias("value_recovered_local"),
            F.sum("attributed_payment_amount_usd").alias("value_recovered_usd"),
            F.bool_or("used_estimated_fx_rate").alias("value_recovered_usd_is_estimated"),
            F.max("currency_code").alias("currency_code"),
        )
        .withColumn("paid_post_call_rate", safe_divide("paid_post_call", "with_contract"))
    )


def paid_rates(mart: DataFrame) -> DataFrame:
    """The paid rate over every disposition and over those with a contract."""
    counts = mart.agg(
        F.count(F.lit(1)).alias("total_dispositions"),
        F.count("contract_id").alias("with_contract"),
        F.count_if("is_paid_post_call").alias("paid_post_call"),
    )
    return counts.withColumns(
        {
            "rate_all": safe_divide("paid_post_call", "total_dispositions"),
            "rate_with_contract": safe_divide("paid_post_call", "with_contract"),
        }
    )


def worst_first(df: DataFrame, rate: str, keys: Sequence[str]) -> DataFrame:
    """Lowest rate first, rows without a rate last."""
    return df.orderBy(F.asc_nulls_last(rate), *keys)


def largest_first(df: DataFrame, value: str, label: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(value), label)


def drill(df: DataFrame, path: Sequence[str] = ()) -> DataFrame:
    """Calls per label of the next reason level below ``path`` (chosen labels, top level first)."""
    levels = ["level_one", "level_two", "level_three"]
    for level, label in zip(levels, path):
        df = only(df, level, label)
    below = levels[len(path)]
    return largest_first(df.groupBy(below).agg(F.sum("call_count").alias("call_count")), "call_count", below)


def drill_levels(df: DataFrame) -> DataFrame:
    """Calls at every level of the reason tree in one pass; ``depth`` 0 is the total."""
    levels = ["level_one", "level_two", "level_three"]
    return (
        df.rollup(*levels)
        .agg(F.sum("call_count").alias("call_count"), F.grouping_id().alias("_open"))
        .select(
            *levels,
            F.when(F.col("_open") == 0, 3).when(F.col("_open") == 1, 2).when(F.col("_open") == 3, 1).otherwise(0)
            .cast("bigint").alias("depth"),
            "call_count",
        )
        .where("call_count IS NOT NULL")
    )


def share_of_total(df: DataFrame, value: str, out: str = "share") -> DataFrame:
    """Each row's part of the total, taken as a scalar subquery (no one-partition window)."""
    whole = df.select(F.sum(value)).scalar()
    return df.withColumn(out, safe_divide(F.col(value).cast("double"), whole.cast("double")))


def top_label(df: DataFrame, label: str, value: str = "call_count") -> DataFrame:
    """One row: the label with the largest sum; ties go to the first label."""
    sums = df.groupBy(label).agg(F.sum(value).alias(value))
    best = sums.agg(F.min(F.struct((-F.col(value)).alias("down"), F.col(label).alias(label))).alias("best"))
    return best.where("best IS NOT NULL").select(F.col(f"best.{label}").alias(label), (-F.col("best.down")).alias(value))


def default_drill(df: DataFrame) -> DataFrame:
    """The path opened first: the top label of each level within the one above, one row per level.

    One grouping by all levels; sums of the upper levels are running totals over its few rows, and the
    smallest (-sum, label) of the levels in turn is the path. An unlabelled level opens nothing below it.
    """
    levels = ["level_one", "level_two", "level_three"]
    sums = df.groupBy(*levels).agg(F.sum("call_count").alias("n3"))
    for depth in (2, 1):
        sums = sums.withColumn(f"n{depth}", F.sum("n3").over(Window.partitionBy(*levels[:depth])))
    steps = [F.struct((-F.col(f"n{d}")).alias("down"), F.col(level).alias("label")) for d, level in enumerate(levels, 1)]
    path = sums.agg(F.min(F.struct(*[s.alias(f"s{d}") for d, s in enumerate(steps, 1)])).alias("p"))
    rows = F.explode(F.array(*[F.struct(F.lit(d).cast("bigint").alias("depth"), F.col(f"p.s{d}").alias("s")) for d in (1, 2, 3)]))
    opened = (
        (F.col("r.depth") == 1)
        | (F.col("p.s1.label").isNotNull() & ((F.col("r.depth") == 2) | F.col("p.s2.label").isNotNull()))
    )
    return (
        path.where("p IS NOT NULL")
        .select("p", rows.alias("r"))
        .where(opened)
        .select("r.depth", F.col("r.s.label").alias("label"), (-F.col("r.s.down")).alias("call_count"))
    )
