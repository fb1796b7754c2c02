"""Attribution and window counts against brute force, with slices of several widths."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callpay.functions.columns import minute_number
from callpay.operators.asof import attribute_nearest, count_in_window

START = datetime(2024, 3, 30, 22)
#: A minute, a day, an instant, all of time.
SLICES = [minute_number, F.to_date, F.col, lambda c: F.lit(0)]


def make(seed, n_events=120, n_anchors=160, keys=5, hot_share=0.4):
    """Coarse instants, so ties and exact window edges are frequent; one key holds much of the data."""
    rnd = random.Random(seed)

    def key():
        r = rnd.random()
        return None if r < 0.08 else 0 if r < hot_share else rnd.randrange(1, keys)

    def instant():
        return START + timedelta(hours=12 * rnd.randrange(0, 20), microseconds=rnd.choice([0, 0, 1, 999_999]))

    events = [(i, key(), None if rnd.random() < 0.05 else instant()) for i in range(n_events)]
    anchors = [(1000 + i, key(), None if rnd.random() < 0.05 else instant()) for i in range(n_anchors)]
    return events, anchors


def candidates(event, anchors, days):
    _, key, at = event
    if key is None or at is None:
        return []
    return [
        (a_at, a_id) for a_id, a_key, a_at in anchors
        if a_key == key and a_at is not None and at - timedelta(days=days) < a_at <= at
    ]


def frames(spark, events, anchors):
    return (
        spark.createDataFrame(events, "event_id long, k long, at timestamp_ntz"),
        spark.createDataFrame(anchors, "anchor_id long, k long, anchor_at timestamp_ntz"),
    )


@pytest.mark.parametrize("slice_of", SLICES)
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_equals_brute_force(spark, seed, slice_of):
    events, anchors = make(seed)
    e, a = frames(spark, events, anchors)
    got = attribute_nearest(
        e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", anchor_id="anchor_id", within_days=3, out="near",
        slice_of=slice_of,
    )
    assert got.columns == ["event_id", "k", "at", "near"]
    want = {ev[0]: (max(candidates(ev, anchors, 3))[1] if candidates(ev, anchors, 3) else None) for ev in events}
    rows = [(r.event_id, r.near) for r in got.collect()]
    assert len(rows) == len(events) and dict(rows) == want


@pytest.mark.parametrize("slice_of", SLICES)
@pytest.mark.parametrize("seed", [4, 5])
def test_count_equals_brute_force(spark, seed, slice_of):
    events, anchors = make(seed)
    e, a = frames(spark, events, anchors)
    got = count_in_window(
        e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", within_days=3, out="n", slice_of=slice_of
    )
    assert {r.event_id: r.n for r in got.collect()} == {ev[0]: len(candidates(ev, anchors, 3)) for ev in events}


def test_two_column_key(spark):
    e = spark.createDataFrame(
        [(1, 1, 7, START), (2, 2, 7, START)], "event_id long, tenant long, k long, at timestamp_ntz"
    )
    a = spark.createDataFrame([(9, 1, 7, START)], "anchor_id long, tenant long, k long, anchor_at timestamp_ntz")
    for slice_of in SLICES:
        got = attribute_nearest(
            e, a, by=["tenant", "k"], event_ts="at", anchor_ts="anchor_at", anchor_id="anchor_id", within_days=3,
            out="near", slice_of=slice_of,
        )
        assert {r.event_id: r.near for r in got.collect()} == {1: 9, 2: None}


def test_window_edges(spark):
    """Same instant counts, exactly N days earlier does not, one millisecond less does."""
    at = datetime(2024, 1, 10, 12)
    e = spark.createDataFrame([(i, i, at) for i in (1, 2, 3, 4)], "event_id long, k long, at timestamp_ntz")
    a = spark.createDataFrame(
        [
            (11, 1, at),
            (12, 2, at - timedelta(days=3)),
            (13, 3, at - timedelta(days=3) + timedelta(milliseconds=1)),
            (14, 4, at + timedelta(milliseconds=1)),
        ],
        "anchor_id long, k long, anchor_at timestamp_ntz",
    )
    for slice_of in SLICES:
        got = attribute_nearest(
            e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", anchor_id="anchor_id", within_days=3, out="near",
            slice_of=slice_of,
        )
        assert {r.event_id: r.near for r in got.collect()} == {1: 11, 2: None, 3: 13, 4: None}


def test_result_does_not_depend_on_session_zone(spark):
    events, anchors = make(6)
    e, a = frames(spark, events, anchors)
    results = []
    for zone in ("UTC", "America/New_York", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = attribute_nearest(
            e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", anchor_id="anchor_id", within_days=3, out="near",
        )
        results.append(sorted((r.event_id, r.near) for r in got.select("event_id", "near").na.fill(-1).collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] == results[2]


def jobs_of(spark, build):
    """What ``build`` returns, and the number of jobs it ran."""
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        return build(), len(context.statusTracker().getJobIdsForGroup("building"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_building_runs_no_job_and_one_plan_serves_all(spark):
    """No key is looked at beforehand: the plan of one hot key and of many small ones is the same, without pairs."""
    shapes = []
    for hot_share in (0.0, 1.0):
        e, a = frames(spark, *make(7, hot_share=hot_share))
        for operator, more in ((attribute_nearest, {"anchor_id": "anchor_id"}), (count_in_window, {})):
            got, jobs = jobs_of(
                spark, lambda: operator(e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", within_days=3, out="x", **more)
            )
            assert jobs == 0
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert "Cartesian" not in plan and plan.count("Join") == 2
            shapes.append(len(plan.splitlines()))
    assert shapes[:2] == shapes[2:]
    assert jobs_of(spark, lambda: e.count())[1] > 0


def test_one_key_holding_most_rows_is_sliced(spark):
    """90 % of 60,000 events and anchors on one key: no task may see them all."""
    n = 30_000
    base = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 10 != 0, 0).otherwise(F.col("id")).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 7).cast("decimal(18,6)"))).alias("t"),
    )
    e = base.select(F.col("id").alias("event_id"), "k", F.col("t").alias("at"))
    a = base.select(F.col("id").alias("anchor_id"), "k", F.col("t").alias("anchor_at"))
    got = attribute_nearest(
        e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", anchor_id="anchor_id", within_days=3, out="near",
    )
    assert got.where("near <=> event_id").count() == n
