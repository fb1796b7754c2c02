"""Rate resolution, upsert, and the NULL rules of the checks."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException

from callpay.operators import checks, fx
from callpay.sources.tables import ensure_fx_table, export_json_by_date, materialize, read_mart, store_rates

D1, D2, D3 = date(2026, 8, 4), date(2026, 8, 5), date(2026, 8, 6)
AT = datetime(2026, 8, 7)
RATE = "rate_date date, currency string, usd_to_local_rate double"


def pairs(df):
    return sorted((r.rate_date, r.currency) for r in df.collect())


def test_missing_rates_per_day_and_currency(spark):
    p = spark.createDataFrame(
        [(datetime(2026, 8, 4, 1),), (datetime(2026, 8, 4, 9),), (datetime(2026, 8, 5),), (None,)], "paid_at_utc timestamp_ntz"
    )
    cached = spark.createDataFrame([(D1, "KES", 1.0)], RATE)
    got = fx.missing_rates(p, cached, ["KES", "UGX"])
    assert pairs(got) == [(D1, "UGX"), (D2, "KES"), (D2, "UGX")]
    text = spark.createDataFrame([("2026-08-04 10:00:00",), ("never",)], "t string")
    from callpay.functions.columns import try_ts

    assert [r.rate_date for r in fx.needed_dates(text, try_ts("t")).collect()] == [D1]


@pytest.fixture
def resolved(spark):
    missing = spark.createDataFrame([(d, c) for d in (D1, D2) for c in ("KES", "UGX")], "rate_date date, currency string")
    history = spark.createDataFrame([(D1, "KES", 129.0)], RATE)

    def resolve(latest_rows):
        latest = spark.createDataFrame(latest_rows, "currency string, usd_to_local_rate double")
        return fx.resolve_rates(missing, history, latest, AT)

    return resolve


def test_served_days_use_history_others_fall_back(resolved):
    got = {
        (r.rate_date, r.currency): (r.usd_to_local_rate, r.rate_is_estimated, r.rate_source)
        for r in resolved([("KES", 130.0), ("UGX", 3700.0)]).collect()
    }
    assert got == {
        (D1, "KES"): (129.0, False, "history"),
        (D1, "UGX"): (None, False, "history"),
        (D2, "KES"): (130.0, True, "latest_fallback"),
        (D2, "UGX"): (3700.0, True, "latest_fallback"),
    }


def test_run_summary_states(spark, resolved):
    needed = spark.createDataFrame([(D1,), (D2,), (D3,)], "rate_date date")

    def state(df, **kw):
        return tuple(fx.fx_summary(needed, df, **kw).first())

    assert state(resolved([("KES", 130.0), ("UGX", 3700.0)])) == ("ok", 3, 2, 0)
    assert state(resolved([])) == ("partial_failure", 1, 2, 1)
    assert state(resolved([]).where("false")) == ("up_to_date", 0, 3, 0)
    assert state(resolved([]), source_given=False) == ("no_api_key", 0, 0, 0)


def rates(spark, *rows):
    return fx.rates_from_rows(spark, [(d, c, r, False, "history", AT) for d, c, r in rows])


def test_upsert_updates_inserts_and_refuses_repeated_keys(spark):
    target = rates(spark, (D1, "KES", 1.0), (D1, "UGX", 2.0))
    got = fx.upsert_by_key(target, rates(spark, (D1, "KES", 9.0), (D2, "KES", 3.0)), ["rate_date", "currency"])
    assert sorted((r.rate_date, r.currency, r.usd_to_local_rate) for r in got.collect()) == [
        (D1, "KES", 9.0), (D1, "UGX", 2.0), (D2, "KES", 3.0),
    ]
    with pytest.raises(Exception, match="repeat a key"):
        fx.upsert_by_key(target, rates(spark, (D2, "KES", 1.0), (D2, "KES", 2.0)), ["rate_date", "currency"]).collect()


def test_stored_rates_keep_untouched_days(spark, tmp_path):
    path = str(tmp_path / "fx")
    assert ensure_fx_table(spark, path).count() == 0
    store_rates(spark, path, rates(spark, (D1, "KES", 1.0), (D1, "UGX", 2.0), (D2, "KES", 3.0)))
    for _ in range(2):
        store_rates(spark, path, rates(spark, (D1, "KES", 9.0), (D3, "KES", 4.0)))
    got = sorted((r.rate_date, r.currency, r.usd_to_local_rate) for r in ensure_fx_table(spark, path).collect())
    assert got == [(D1, "KES", 9.0), (D1, "UGX", 2.0), (D2, "KES", 3.0), (D3, "KES", 4.0)]
    store_rates(spark, path, rates(spark))
    assert ensure_fx_table(spark, path).count() == 4
    assert [r.rate_date for r in fx.latest_rates(ensure_fx_table(spark, path), 2).collect()] == [D3, D2]


def test_a_reader_finishes_with_the_rates_it_started_with(spark, tmp_path):
    path = str(tmp_path / "fx")

    def rows(df):
        return sorted((r.rate_date, r.currency, r.usd_to_local_rate) for r in df.collect())

    store_rates(spark, path, rates(spark, (D1, "KES", 1.0), (D1, "UGX", 2.0), (D2, "KES", 3.0)))
    reader = ensure_fx_table(spark, path)
    store_rates(spark, path, rates(spark, (D1, "KES", 9.0), (D2, "KES", 8.0), (D3, "KES", 4.0)))
    assert rows(reader) == [(D1, "KES", 1.0), (D1, "UGX", 2.0), (D2, "KES", 3.0)]
    assert rows(ensure_fx_table(spark, path)) == [(D1, "KES", 9.0), (D1, "UGX", 2.0), (D2, "KES", 8.0), (D3, "KES", 4.0)]
    # days that were written and not published, as a lost run leaves them, do not count
    rates(spark, (D1, "KES", 77.0)).write.partitionBy("rate_date").parquet(f"{path}/data/version=lost")
    assert rows(ensure_fx_table(spark, path))[0] == (D1, "KES", 9.0)
    # rows without a day are a day of their own
    store_rates(spark, path, rates(spark, (None, "KES", 5.0)))
    store_rates(spark, path, rates(spark, (None, "UGX", 6.0)))
    undated = ensure_fx_table(spark, path).where("rate_date IS NULL")
    assert sorted((r.currency, r.usd_to_local_rate) for r in undated.collect()) == [("KES", 5.0), ("UGX", 6.0)]


def test_export_is_one_file_per_day_and_leaves_other_days(spark, tmp_path):
    out = tmp_path / "export"
    export_json_by_date(rates(spark, (D1, "KES", 1.0), (D1, "UGX", 2.0)), str(out), "rate_date")
    export_json_by_date(rates(spark, (D2, "KES", 1.0)), str(out), "rate_date")
    files = sorted(str(f.parent.relative_to(out)) for f in out.rglob("*.json"))
    assert files == ["y=2026/m=08/d=04", "y=2026/m=08/d=05"]


def test_materialize(spark, tmp_path):
    df = spark.range(3)
    assert materialize(df, "as_view", "view").count() == 3
    materialize(df, "as_table", "table", str(tmp_path))
    assert read_mart(spark, "as_table").count() == 3
    # a published table is never overwritten in place; another run has another folder
    with pytest.raises(AnalysisException):
        materialize(spark.range(2), "as_table", "table", str(tmp_path))
    materialize(spark.range(2), "as_table", "table", str(tmp_path / "next"))
    assert read_mart(spark, "as_table").count() == 2
    with pytest.raises(ValueError):
        materialize(df, "x", "stream")


def test_key_rules_of_one_table_together(spark):
    rows = [(1, "a", 1.0, True), (1, "a", None, True), (2, None, 2.0, True), (2, "b", 2.0, False), (None, "c", 1.0, True),
            (None, "c", 5.0, True), (3, "b", 1.0, True), (3, "d", 1.0, True)]
    df = spark.createDataFrame(rows, "k long, t string, v double, ok boolean")
    rules = [
        checks.unique_rule("k"), checks.unique_rule("t"), checks.unique_combination_rule(["t", "k"]),
        checks.unique_combination_rule(["k", "t"]), checks.one_to_one_rule("k", "v"), checks.one_to_one_rule("k", "t"),
        checks.one_to_one_rule("k", "t", "ok AND v = 1"),
    ]
    got = checks.measure_keys(df, rules, "x.")
    assert [(r.check, r.target, r.failures) for r in got.collect()] == [
        ("unique", "x.k", 3), ("unique", "x.t", 3), ("unique_combination", "x.t,k", 2), ("unique_combination", "x.k,t", 2),
        ("one_to_one", "x.k->v", 1), ("one_to_one", "x.k->t", 1), ("one_to_one", "x.k->t", 1),
    ]
    assert all(r.failures == 0 and r.passed for r in checks.measure_keys(df.limit(0), rules).collect())


def outcome(df):
    r = df.first()
    return r.failures, r.passed


def test_null_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (7, "")], "n int, t string")
    assert outcome(checks.not_null(df, "n")) == (2, False)
    assert outcome(checks.unique(df, "n")) == (1, False)
    assert outcome(checks.accepted_values(df, "n", [1, 7])) == (0, True)
    assert outcome(checks.accepted_values(df, "n", [1])) == (1, False)
    assert outcome(checks.accepted_range(df, "n", low=1)) == (0, True)
    assert outcome(checks.accepted_range(df, "n", low=1, inclusive=False)) == (2, False)
    assert outcome(checks.accepted_range(df, "n", high=6)) == (1, False)
    assert outcome(checks.unique_combination(df, ["n", "t"])) == (2, False)
    assert outcome(checks.key_present(df, "t")) == (1, False)
    assert outcome(checks.has_rows(df.where("false"))) == (1, False)
    assert outcome(checks.expect(df, "n < 5")) == (1, False)
    parents = spark.createDataFrame([(1,)], "id int")
    assert outcome(checks.relationships(df, "n", parents, "id")) == (1, False)
    assert outcome(checks.relationships(df, "n", parents, "id", where="n < 5")) == (0, True)
    assert outcome(checks.one_to_one(df, "t", "n")) == (0, True)
    two = spark.createDataFrame([("a", 1), ("a", 2), ("a", None)], "t string, n int")
    assert outcome(checks.one_to_one(two, "t", "n")) == (1, False)


def test_row_rules_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 AS m").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [checks.not_null_rule("id"), checks.accepted_values_rule("m", [0, 1]), checks.has_rows_rule()]
    suite = checks.measure(df, rules, "t.")
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {(r.check, r.target): r.failures for r in suite.collect()} == {
        ("not_null", "t.id"): 0, ("accepted_values", "t.m"): 3, ("has_rows", "t.*"): 0,
    }


@pytest.mark.parametrize(
    "now,loaded,fresh",
    [
        (datetime(2026, 8, 7, 7), datetime(2026, 8, 7, 4), True),
        (datetime(2026, 8, 7, 7), datetime(2026, 8, 7, 3, 59), False),
        (datetime(2026, 8, 7, 5, 59), datetime(2026, 8, 6, 4), True),
        (datetime(2026, 8, 7, 6), datetime(2026, 8, 6, 4), False),
    ],
)
def test_freshness_counts_from_the_last_deadline(spark, now, loaded, fresh):
    loads = spark.createDataFrame([("calls", loaded - timedelta(days=9)), ("calls", loaded)], "source_name string, loaded_at timestamp_ntz")
    assert outcome(checks.freshness(loads, now=now)) == (0 if fresh else 1, fresh)


def test_coverage_warns(spark):
    p = spark.createDataFrame(
        [(datetime(2026, 8, 4, 1), "KES"), (datetime(2026, 8, 5), "KES"), (datetime(2026, 8, 5), None)],
        "paid_at_utc timestamp_ntz, currency_code string",
    )
    stored = spark.createDataFrame([(D1, "UGX"), (D2, "KES")], "rate_date date, currency_code string")
    row = checks.covers_dates(p, stored).first()
    assert (row.severity, row.failures) == ("WARN", 1)
    assert checks.covers_dates(p, stored, dates_only=True).first().failures == 0
