"""Nearest-preceding attribution and window membership on a keyed timeline.

Both operators ask for a running value over the anchors of a key up to each
event: the latest anchor (a running ``max`` of (time, id)), or the number of
anchors whose window is open (a running ``sum`` of +1/-1). Neither ever forms
event-anchor pairs.

One plan serves keys of any size, a scan in two levels:

1. anchors and events shrink to one row per distinct (key, instant), combined
   map-side;
2. those are scanned per (key, slice of time): no group is larger than the
   instants of one slice, a minute unless ``slice_of`` says otherwise (any
   function of the instant that never falls as time goes on);
3. the last row of each slice, its whole fold, is scanned per key; that hands
   the fold of all earlier slices to each slice, one narrow row apiece;
4. the answers at events' instants join back onto the events, an equi join
   whose event side adaptive execution may split.

Nothing is counted beforehand: building the plan runs no job, and there is
no list of large keys, no size at which the plan changes.

Timestamps are expected as TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpay.functions.columns import days, minute_number
from callpay.operators.filters import require
from callpay.operators.keys import join_keys


def _running(
    events: DataFrame,
    points: DataFrame,
    by: Sequence[str],
    event_ts: str,
    fold: Callable[[Column], Column],
    merge: Callable[[Column, Column], Column],
    at_instant: Sequence[Column],
    value: Column,
    slice_of: Callable[[str], Column],
) -> DataFrame:
    """``events`` plus ``_run``, the fold of ``points`` (key, _at, number) up to each event.

    ``at_instant`` combines the points of one instant in plain numbers, a hash aggregate; ``value`` makes of
    them what ``fold`` takes. Events without key or time match no answer.
    """
    asked = events.select(*by, F.col(event_ts).alias("_at"), F.lit(1).alias("_asked"))
    timed = require(points.unionByName(asked, allowMissingColumns=True), *by, "_at")
    instants = (
        # the planner would see to this filter in one reader of ``scanned`` only, and so not share its shuffles
        timed.where(slice_of("_at").isNotNull())
        .groupBy(*by, "_at")
        .agg(*at_instant, F.max("_asked").alias("_asked"))
        .select(*by, "_at", slice_of("_at").alias("_slice"), value.alias("_value"), "_asked")
    )
    in_slice = Window.partitionBy(*by, "_slice").orderBy("_at")
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = instants.select(
        *by, "_slice", "_at", "_asked", fold(F.col("_value")).over(so_far).alias("_here"),
        F.lead("_at").over(in_slice).isNull().alias("_last"),
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # names _asked, always true here, so that both readers of ``scanned`` need the same columns and share its shuffles
    ends = scanned.where("_last AND (_asked IS NULL OR _asked = 1)")
    carried = ends.select(*by, "_slice", fold(F.col("_here")).over(earlier).alias("_carry"))
    answers = (
        scanned.where("_asked = 1")
        .join(carried, [*by, "_slice"])
        .select(*by, "_at", merge(F.col("_here"), F.col("_carry")).alias("_run"))
    )
    # both sides are shuffled for this join, so that a hot instant can be split (see join_per_key)
    at = answers.withColumnRenamed("_at", "_b_at")
    joined = join_keys(events, at, by, "left", null_safe=True, extra=F.col(event_ts).eqNullSafe(F.col("_b_at")))
    return joined.select(*events.columns, "_run")


def attribute_nearest(
    events: DataFrame,
    anchors: DataFrame,
    *,
    by: Sequence[str],
    event_ts: str,
    anchor_ts: str,
    anchor_id: str,
    within_days: int,
    out: str,
    slice_of: Callable[[str], Column] = minute_number,
) -> DataFrame:
    """Every event, with the id of the latest anchor of its key in (event - N days, event].

    Anchors at one instant: the highest id wins. Every event comes back exactly
    once; one without key, time or anchor gets NULL. If the latest preceding
    anchor is too old, so is every other, hence one bound check at the end.
    """
    points = anchors.select(
        *by,
        F.col(anchor_ts).alias("_at"),
        F.col(anchor_id).alias("_id"),
        F.lit(1).alias("_point"),
    )
    latest = [F.max("_id").alias("_id"), F.count("_point").alias("_points")]
    value = F.when(F.col("_points") > 0, F.struct(F.col("_at").alias("at"), F.col("_id").alias("id")))
    run = _running(
        events, points, by, event_ts, F.max, lambda here, carry: F.coalesce(here, carry), latest, value, slice_of
    )
    in_window = F.col("_run.at") > F.col(event_ts) - days(within_days)
    return run.withColumn(out, F.when(in_window, F.col("_run.id"))).drop("_run")


def count_in_window(
    events: DataFrame,
    anchors: DataFrame,
    *,
    by: Sequence[str],
    event_ts: str,
    anchor_ts: str,
    within_days: int,
    out: str,
    slice_of: Callable[[str], Column] = minute_number,
) -> DataFrame:
    """Every event, with the number of anchors of its key in (event - N days, event].

    This is the interval join counted without its pairs: each anchor opens its
    window (+1) at its own time and closes it (-1) N days later.
    """
    turns = F.array(
        F.struct(F.col(anchor_ts).alias("_at"), F.lit(1).cast("bigint").alias("_step")),
        F.struct((F.col(anchor_ts) + days(within_days)).alias("_at"), F.lit(-1).cast("bigint").alias("_step")),
    )
    steps = anchors.select(*by, F.inline(turns))
    run = _running(
        events, steps, by, event_ts, F.sum,
        lambda here, carry: F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0)),
        [F.sum("_step").alias("_step")], F.col("_step"), slice_of,
    )
    return run.withColumn(out, F.coalesce(F.col("_run"), F.lit(0)).cast("bigint")).drop("_run")
