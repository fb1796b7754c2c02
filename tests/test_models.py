"""Staging, matching and marts on hand-made rows with hand-computed answers."""

from datetime import date, datetime, timedelta

import pytest

from callpay.functions import columns as C
from callpay.plans import consume, marts
from callpay.plans.intermediate import attribute_payments, code_calls, summarise_payments
from callpay.plans.staging import stage_agents, stage_calls, stage_dispositions, stage_fx, stage_payments
from callpay.sources.contracts import (
    AGENT_COLUMNS, CALL_COLUMNS, DISPOSITION_COLUMNS, FX_SCHEMA, PAYMENT_COLUMNS, PAYMENT_KEY_SHORT, country_seed,
)


def text_frame(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def calls(spark, *rows):
    """(id, local time, centre, user, note)"""
    raw = [(i, t, c, "CONNECTED", " outbound ", "1000", u, " camp ", n) for i, t, c, u, n in rows]
    return stage_calls(text_frame(spark, raw, CALL_COLUMNS), country_seed(spark))


def dispositions(spark, *rows):
    """(id, tenant, contract, time[, call type, one, two, three])"""
    raw = []
    for r in rows:
        i, tenant, contract, at, *rest = r
        kind, one, two, three = rest or ("Outbound Team", "A", "", "")
        raw.append((i, tenant, "c", contract, at, " me ", kind, one, two, three))
    return stage_dispositions(text_frame(spark, raw, DISPOSITION_COLUMNS), country_seed(spark))


def raw_payments(spark, *rows):
    """(time, tenant, contract, amount[, provider])"""
    return text_frame(
        spark, [(r[0], r[1], r[2], r[4] if len(r) > 4 else "MPESA", "prog", r[3]) for r in rows], PAYMENT_COLUMNS
    )


def payments(spark, *rows, **kw):
    return stage_payments(raw_payments(spark, *rows), country_seed(spark), **kw)


def fx(spark, *rows):
    full = [(d, c, r, e, "history", datetime(2026, 8, 7)) for d, c, r, e in rows]
    return stage_fx(spark.createDataFrame(full, FX_SCHEMA))


def by(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_blank_means_spaces_only(spark):
    df = spark.createDataFrame([("  ",), ("",), (" a ",), ("\n",), (None,)], "t string")
    got = [r[0] for r in df.select(C.clean_string("t")).collect()]
    assert got == [None, None, "a", "\n", None]
    assert [r[0] for r in df.select(C.clean_string("t", " \n")).collect()] == [None, None, "a", None, None]


def test_casts_never_fail(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("abc",), ("",), ("99999999999999999999",)], "t string")
    assert [r[0] for r in df.select(C.try_long("t")).collect()] == [12, None, None, None, None]
    assert [r[0] for r in df.select(C.try_double("t")).collect()] == [12.0, 12.5, None, None, 1e20]
    ts = spark.createDataFrame([("2026-08-05 06:57:26.609",), ("2026-13-05",)], "t string")
    assert [r[0] for r in ts.select(C.try_ts("t")).collect()] == [datetime(2026, 8, 5, 6, 57, 26, 609000), None]


def test_ratios_without_denominator(spark):
    row = spark.sql("SELECT 1L AS a, 0L AS b").select(C.safe_divide("a", "b"), C.convert_amount("a", "b")).first()
    assert row[0] is None and row[1] is None


def test_calls_get_market_and_utc(spark):
    df = calls(
        spark,
        ("1", "2026-08-05 01:30:00", "1", "u", "x"),
        ("2", "2026-08-05 01:30:00", "4", "u", "x"),
        ("3", "2026-08-05 01:30:00", "9", "u", " "),
        ("4", "soon", "2", "", "x"),
    )
    got = by(df, "call_id", "country_name", "call_placed_at_utc", "agent_ameyo_user_id", "notes_raw")
    assert got["1"] == ("Kenya", datetime(2026, 8, 4, 22, 30), "u", "x")
    assert got["2"] == ("Nigeria", datetime(2026, 8, 5, 0, 30), "u", "x")
    assert got["3"] == (None, None, "u", None)
    assert got["4"] == ("Uganda", None, None, "x")
    row = df.first()
    assert (row.call_dial_type, row.campaign_name, row.total_talk_time_ms) == ("outbound", "camp", 1000.0)
    assert df.columns == [
        "call_id", "agent_ameyo_user_id", "campaign_name", "call_dial_type", "system_disposition",
        "ameyo_contact_center_id", "total_talk_time_ms", "notes_raw", "call_placed_at_local", "_source_file",
        "_ingested_at", "country_name", "atlas_tenant_id", "currency_code", "call_placed_at_utc",
    ]


def test_payment_identity(spark):
    rows = [
        ("2026-08-05 10:00:00.001", "1001", "7", "10.0"),
        ("2026-08-05 10:00:00.001", "1001", "7", "10.0"),
        ("2026-08-05 10:00:00.001", "1001", "7", "12.0"),
        ("2026-08-05 10:00:00.002", "1001", "7", "0.0", "MANUAL"),
        ("2026-08-05 10:00:00.003", "1001", "", "abc"),
    ]
    full = payments(spark, *rows)
    assert sorted(str(r.amount_local) for r in full.collect()) == ["0.0", "10.0", "12.0", "None"]
    flags = {r.amount_local: r.is_zero_amount for r in full.collect()}
    assert flags == {10.0: False, 12.0: False, 0.0: True, None: None}
    short = payments(spark, *rows, key_cols=PAYMENT_KEY_SHORT)
    assert sorted(r.payment_row_key for r in short.collect()) == [
        "1001--2026-08-05 10:00:00.003", "1001-7-2026-08-05 10:00:00.001", "1001-7-2026-08-05 10:00:00.002",
    ]


def test_earliest_delivery_of_a_payment_survives(spark):
    rows = raw_payments(spark, ("2026-08-05 10:00:00", "1001", "7", "10.0"))
    late, early = (rows.selectExpr("*", f"'{n}' AS _source_file", f"timestamp_ntz'{t}' AS _ingested_at")
                   for n, t in (("late.csv", "2026-08-07"), ("early.csv", "2026-08-06")))
    got = stage_payments(late.unionByName(early), country_seed(spark)).collect()
    assert [(r._source_file, r._ingested_at) for r in got] == [("early.csv", datetime(2026, 8, 6))]


def test_agents_prefer_names_then_last(spark):
    raw = text_frame(
        spark,
        [
            ("Kenya", "a", "Attrition", "Ann"), ("Kenya", "a", "Upsell", "Ann"),
            ("Kenya", "b", "Upsell", " "), ("Kenya", "b", "Attrition", "Bo"),
            ("Kenya", "c", "T", "Cy"), ("Kenya", "c", "T", "Cy"),
            ("Uganda", "a", "", "Al"), ("Kenya", "  ", "T", "nobody"),
            ("", "d", "T", "x"), ("", "d", "T", "y"),
        ],
        AGENT_COLUMNS,
    )
    got = {
        (r.country_name, r.ameyo_user_id): (r.team, r.atlas_user_name, r.has_conflicting_source_rows)
        for r in stage_agents(raw).collect()
    }
    assert got == {
        ("Kenya", "a"): ("Upsell", "Ann", True),
        ("Kenya", "b"): ("Attrition", "Bo", True),
        ("Kenya", "c"): ("T", "Cy", True),
        ("Uganda", "a"): (None, "Al", False),
        (None, "d"): ("T", "y", True),
    }


def test_notes_are_matched_by_existence(spark):
    d = dispositions(spark, *[(str(i), "1001", "1", "2026-08-05 10:00:00") for i in (71667828, 71, 500, 400)], ("x", "1001", "1", "t"))
    notes = {
        "real": "ref 71667828 ok", "prose": "silence", "phones": "254757421943 254757421943", "two": "500, then 400",
        "zeros": "no 0071", "long": "12345678901234567890", "blank": "   ", "null": None, "glued": "a500b",
    }
    coded = code_calls(calls(spark, *[(k, "2026-08-05 10:00:00", "1", "u", n) for k, n in notes.items()]), d)
    got = by(coded, "call_id", "matched_call_log_id", "is_coded")
    assert {k: v[0] for k, v in got.items() if v[1]} == {"real": 71667828, "two": 400, "zeros": 71, "glued": 500}
    assert len(got) == len(notes)


def test_repeated_call_ids_share_their_match(spark):
    d = dispositions(spark, ("5", "1001", "1", "2026-08-05 10:00:00"))
    c = calls(spark, ("k", "2026-08-05 10:00:00", "1", "u", "5"), ("k", "2026-08-05 10:00:00", "1", "u", "none"))
    assert [r.matched_call_log_id for r in code_calls(c, d).collect()] == [5, 5]


def test_attribution_conversion_and_summary(spark):
    d = dispositions(
        spark,
        ("1", "1001", "7", "2026-08-04 09:00:00"),
        ("2", "1001", "7", "2026-08-04 12:00:00"),
        ("3", "1002", "8", "2026-08-01 10:00:00"),
        ("4", "1001", "", "2026-08-04 09:00:00"),
        ("5", "1002", "9", "2026-08-04 09:00:00"),
        ("6", "1002", "9", "2026-08-04 09:00:00"),
    )
    p = payments(
        spark,
        ("2026-08-04 10:00:00", "1001", "7", "100"),
        ("2026-08-04 13:00:00", "1001", "7", "200"),
        ("2026-08-05 13:00:00", "1001", "7", "300"),
        ("2026-08-04 10:00:00", "1002", "8", "50"),
        ("2026-08-04 10:00:00", "1002", "9", "60"),
        ("2026-08-04 10:00:00", "1001", "", "70"),
        ("2026-08-04 10:00:00", "1001", "7", "0", "MANUAL"),
        ("2026-08-04 10:00:00", "1001", "7", "oops"),
        ("2026-08-04 10:00:00", "1004", "7", "80"),
    )
    rates = fx(spark, (date(2026, 8, 4), "KES", 100.0, False), (date(2026, 8, 5), "KES", 150.0, True))
    attributed = attribute_payments(p, d, rates)
    got = by(attributed, "amount_local", "attributed_call_log_id", "amount_usd", "is_attributed_to_a_call")
    assert got == {
        100.0: (1, 1.0, True), 200.0: (2, 2.0, True), 300.0: (2, 2.0, True), 50.0: (None, None, False),
        60.0: (6, None, True), 70.0: (None, 0.7, False), 80.0: (1, None, True),
    }
    by_tenant = attribute_payments(p, d, rates, by=("atlas_tenant_id", "contract_id"))
    assert by(by_tenant, "amount_local", "attributed_call_log_id")[80.0] is None
    s = by(
        summarise_payments(attributed), "call_log_id", "attributed_payment_count", "attributed_payment_amount_local",
        "attributed_payment_amount_usd", "has_unconverted_payment", "used_estimated_fx_rate", "first_attributed_payment_at",
    )
    assert s == {
        1: (2, 180.0, 1.0, True, False, datetime(2026, 8, 4, 10)),
        2: (2, 500.0, 4.0, False, True, datetime(2026, 8, 4, 13)),
        6: (1, 60.0, None, True, False, datetime(2026, 8, 4, 10)),
    }
    mart = marts.paid_post_call(d, summarise_payments(attributed), as_of=datetime(2026, 8, 7, 9))
    got = by(mart, "call_log_id", "is_paid_post_call", "attributed_payment_count", "is_window_closed")
    assert got == {
        1: (True, 2, True), 2: (True, 2, False), 3: (False, 0, True), 4: (False, 0, True), 5: (False, 0, True), 6: (True, 1, True),
    }
    rates = consume.paid_rates(mart).first()
    assert (rates.total_dispositions, rates.with_contract, rates.paid_post_call) == (6, 5, 3)
    assert rates.rate_all == 0.5 and rates.rate_with_contract == 0.6


@pytest.mark.parametrize("offset,closed", [(-1, False), (0, True), (1, True)])
def test_window_closes_at_exactly_three_days(spark, offset, closed):
    df = spark.sql("SELECT timestamp_ntz'2026-08-04 09:00:00' AS t")
    as_of = datetime(2026, 8, 7, 9) + timedelta(seconds=offset)
    assert df.select(C.is_window_closed("t", 3, as_of)).first()[0] is closed


def test_clock_without_as_of_is_utc_now(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        now = spark.range(1).select(C.clock(None)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    from datetime import timezone

    assert abs(datetime.now(timezone.utc).replace(tzinfo=None) - now) < timedelta(minutes=1)


def test_coding_rate_and_inbound(spark):
    d = dispositions(
        spark,
        ("5", "1001", "1", "2026-08-04 23:30:00", "Inbound Team", "Enquiry", "", " "),
        ("6", "1001", "1", "2026-08-04 23:40:00", "Inbound Team", "Enquiry", "Bill", ""),
        ("7", "1001", "1", "2026-08-04 23:40:00", "Outbound Team", "Enquiry", "Bill", ""),
        ("8", "1009", "1", "2026-08-04 23:40:00", "Inbound Team", "", "", ""),
    )
    c = calls(
        spark, ("a", "2026-08-05 01:00:00", "1", "u", "5"), ("b", "2026-08-05 02:00:00", "1", "u", "no"),
        ("c", "2026-08-05 02:00:00", "9", "u", "5"),
    )
    agents = stage_agents(text_frame(spark, [("Kenya", "u", "T", "Ann")], AGENT_COLUMNS))
    rate = marts.coding_rate(code_calls(c, d), agents)
    got = by(rate, "market", "call_date_local", "total_outbound_calls", "coded_calls", "coding_rate", "agent_name")
    assert got == {"Kenya": (date(2026, 8, 5), 2, 1, 0.5, "Ann"), None: (date(2026, 8, 5), 1, 1, 1.0, None)}
    inbound = marts.inbound_drivers(d)
    got = {(r.market, r.level_one, r.level_two, r.level_three): r.call_count for r in inbound.collect()}
    assert got == {
        ("Kenya", "Enquiry", "Not specified", "Not specified"): 1,
        ("Kenya", "Enquiry", "Bill", "Not specified"): 1,
        (None, "Not specified", "Not specified", "Not specified"): 1,
    }
    assert consume.top_label(inbound, "level_one").first().level_one == "Enquiry"
    paid = marts.paid_post_call(
        d, summarise_payments(attribute_payments(payments(spark), d, fx(spark))), as_of=datetime(2026, 8, 9)
    )
    plain = marts.daily_summary(rate, paid, inbound).collect()
    # Kenya: local day 5 against UTC day 4; the unknown market gives one row per metric
    got = {(str(r.day), r.market, r.total_outbound_calls, r.total_dispositions, r.inbound_call_count) for r in plain}
    assert got == {
        ("2026-08-05", "Kenya", 2, None, None), ("2026-08-04", "Kenya", None, 3, 2),
        ("2026-08-05", None, 1, None, None), ("2026-08-04", None, None, 1, None), ("2026-08-04", None, None, None, 1),
    }
    assert len(plain) == 5
    assert len(marts.daily_summary(rate, paid, inbound, null_safe=True).collect()) == 4


def test_slices(spark):
    df = spark.createDataFrame(
        [("Kenya", date(2026, 8, 4)), ("Kenya", date(2026, 8, 5)), ("Uganda", date(2026, 8, 4))], "market string, day date"
    )
    assert consume.slice_mart(df, []).count() == 0
    assert consume.slice_mart(df, ["Kenya"]).count() == 2
    assert consume.slice_mart(df, ["Kenya", "Uganda"], [date(2026, 8, 4)]).count() == 2
    stamped = df.selectExpr("market", "cast(day AS timestamp_ntz) + INTERVAL '23' HOUR AS at")
    assert consume.slice_mart(stamped, ["Kenya"], [date(2026, 8, 5)], day_col="at").count() == 1


def test_kpis_of_an_empty_slice(spark):
    schema = (
        "day date, market string, total_outbound_calls long, coded_calls long, total_dispositions long, "
        "paid_post_call_count long, value_recovered_usd double, value_recovered_usd_is_estimated boolean, "
        "still_in_window_count long, inbound_call_count long"
    )
    row = consume.kpi_totals(spark.createDataFrame([], schema)).first()
    assert row.total_outbound_calls == 0 and row.coding_rate is None and row.value_recovered_usd is None
    assert row.value_recovered_usd_is_estimated is False
