"""Plan shape: what reaches the scan, what is combined early, what is split under skew."""

from datetime import date, datetime

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from callpay.operators import checks
from callpay.operators.asof import attribute_nearest
from callpay.operators.joins import lookup_rate
from callpay.operators.keys import flag_duplicates, join_per_key, keep_first
from callpay.operators.matching import match_ids_in_text
from callpay.plans import consume
from catalogue.models import Models
from catalogue.queries import QUERIES
from catalogue.roles import table


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    Models(spark, SF_SMALL).paid.write.parquet(str(tmp_path / "paid"))
    stored = spark.read.parquet(str(tmp_path / "paid"))
    text = plan(
        consume.slice_mart(stored, ["Kenya"], [date(2024, 1, 8)], "country_name", "disposed_at_utc").select("call_log_id")
    )
    assert "In(country_name, [Kenya])" in text or "EqualTo(country_name,Kenya)" in text
    assert "GreaterThanOrEqual(disposed_at_utc" in text and "LessThan(disposed_at_utc" in text
    assert "ReadSchema: struct<call_log_id:bigint,disposed_at_utc:timestamp_ntz,country_name:string>" in text


def test_inbound_counts_read_three_columns(spark):
    text = plan(QUERIES["inbound_drivers"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    assert "partial_count" in text
    assert "EqualTo(event_type,signup)" in text or "event_type" in text


def test_dedupe_cuts_copies_before_the_shuffle(spark):
    li = table(spark, SF_SMALL, "lineitem")
    text = plan(keep_first(li, ["l_orderkey"], [F.col("l_linenumber")]))
    before_exchange = text.split("Exchange")[1]
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text and "WindowGroupLimit" in before_exchange


def test_agents_take_one_shuffle(spark):
    text = plan(Models(spark, SF_SMALL).agents)
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Window" not in tree


def test_seed_is_broadcast_without_a_job(spark):
    text = plan(Models(spark, SF_SMALL).dispositions)
    assert "BroadcastHashJoin" in text and "LocalTableScan" in text


def test_rates_are_broadcast_by_size_only(spark):
    """No counting job and no hint: the size limit decides, either way with one result."""
    m = Models(spark, SF_SMALL)
    paid, results = m.payments(), []
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", limit)
        try:
            priced = lookup_rate(paid, m.fx, "currency_code", "paid_at_utc")
            results.append((sorted(map(str, priced.collect())), priced._jdf.queryExecution().executedPlan().toString()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert results[0][0] == results[1][0]
    assert "SortMergeJoin" in results[1][1]


def test_default_drill_reads_once(spark):
    text = plan(consume.default_drill(Models(spark, SF_SMALL).inbound))
    assert text.count("FileScan parquet") <= 2
    assert "rangepartitioning" not in plan(QUERIES["fx_resolve"](spark, SF_SMALL))


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def run_and_show(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_one_number_in_most_notes_is_split(spark, small_skew_limits):
    """A third and more of all notes name the same id."""
    notes = spark.range(0, 200_000, 1, 16).selectExpr(
        "id AS call_id", "CASE WHEN id % 2 = 0 THEN 'ref 5' ELSE concat('ref ', id) END AS note"
    )
    ids = spark.range(0, 100_000, 1, 4).selectExpr("id AS real")
    matched = match_ids_in_text(notes, "call_id", "note", ids, "real", "found")
    rows, text = run_and_show(matched.agg(F.count("*").alias("n"), F.count_if(F.col("found") == 5).alias("five")))
    assert (rows[0].n, rows[0].five) == (100_000 + 50_000, 100_000 + 1)
    assert "skew=true" in text


def third_on_one_key(spark, key="k"):
    """200,000 rows, a third of them on one key, with a payload that does not compress."""
    return spark.range(0, 200_000, 1, 16).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS {key}", "sha2(cast(id AS string), 256) AS payload"
    )


def test_one_repeated_key_is_split(spark, small_skew_limits):
    flagged = flag_duplicates(third_on_one_key(spark), ["k"], "twice")
    rows, text = run_and_show(flagged.groupBy("twice").agg(F.count("*").alias("n"), F.max("payload")))
    assert {r.twice: r.n for r in rows} == {True: 66_667, False: 133_333}
    assert "skew=true" in text


def test_join_to_an_aggregate_of_the_same_key_is_split(spark, small_skew_limits):
    df = third_on_one_key(spark)
    per_key = df.groupBy("k").agg(F.count("*").alias("n"))
    rows, text = run_and_show(join_per_key(df, per_key, ["k"]).agg(F.sum("n").alias("s"), F.max("payload")))
    assert rows[0].s == 66_667**2 + 133_333
    assert "skew=true" in text


def test_per_key_join_ignores_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, t string")
    per_key = spark.createDataFrame([(1, 10), (None, 20)], "k int, v int")
    assert {r.t: r.v for r in join_per_key(df, per_key, ["k"]).collect()} == {"a": 10, "b": None, "c": None}


def test_one_instant_of_one_contract_is_split(spark, small_skew_limits):
    """Most payments on one contract at one instant: the answer joins back onto them in pieces."""
    n = 120_000
    e = spark.range(0, n, 1, 16).selectExpr(
        "id AS event_id", "0L AS k", "sha2(cast(id AS string), 256) AS payload",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CASE WHEN id % 3 = 0 THEN 0 ELSE int(id % 5000) END) AS at",
    )
    a = spark.createDataFrame([(7, 0, datetime(2023, 12, 31, 23))], "anchor_id long, k long, anchor_at timestamp_ntz")
    near = attribute_nearest(
        e, a, by=["k"], event_ts="at", anchor_ts="anchor_at", anchor_id="anchor_id", within_days=3, out="near",
    )
    rows, text = run_and_show(near.agg(F.count_if(F.col("near") == 7).alias("n"), F.max("payload")))
    window = sum(1 for i in range(n) if i % 3 == 0 or (i % 5000) < 71 * 60)
    assert rows[0].n == window
    assert "skew=true" in text


def test_orphans_are_counted_after_shrinking(spark):
    li = table(spark, SF_SMALL, "lineitem")
    text = plan(checks.relationships(li, "l_partkey", table(spark, SF_SMALL, "part"), "p_partkey"))
    tree = text.split("\n\n")[0]
    assert tree.index("HashAggregate") < tree.rindex("HashAggregate") and "LeftAnti" in text


def test_key_rules_of_a_model_share_one_scan_and_one_shuffle(spark, tmp_path):
    from callpay.plans.quality import UNIQUE, checks_of
    from callpay.sources.contracts import country_seed

    country_seed(spark).write.parquet(str(tmp_path / "seed"))
    results = checks_of("country_code_mapping", {"country_code_mapping": spark.read.parquet(str(tmp_path / "seed"))})
    assert len(UNIQUE["country_code_mapping"]) == 3 and len(results) == 2
    steps = results[1]._jdf.queryExecution().executedPlan().toString()
    assert steps.count("FileScan") == 1 and steps.count("Expand") == 1
    assert steps.count("Exchange hashpartitioning") == 1 and steps.count("Exchange") == 2
