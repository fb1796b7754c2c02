"""The whole daily run on small CSV extracts."""

from datetime import date, datetime

import pytest

from callpay import PipelineConfig
from callpay.plans.pipeline import ChecksFailed, run_pipeline
from callpay.sources.contracts import SOURCES
from callpay.sources.tables import read_mart, read_runs

AS_OF = datetime(2026, 8, 7, 6, 30)

CALLS = """ch_call_id,ch_date_added,ch_contact_center_id,ch_system_disposition,ch_call_type,total_talk_time,udh_user_id,campaign_name,udh_notes
1,2026-08-04 09:00:00.000,1,CONNECTED,outbound,1000,joe,upsell,ref 501
2,2026-08-04 10:00:00.000,1,CONNECTED,outbound,2000,joe,upsell,silence
3,2026-08-05 01:30:00.000,4,CONNECTED,outbound,,amy,attrition,"said ""503"", twice
503"
"""
DISPOSITIONS = """call_log_id,tenant_id,customer_id,contract_id,created_timestamp_utc,createdby,call_type,level_one,level_two,level_three
501,1001,9,7,2026-08-04 06:05:00.000,joe,Outbound Team,Sales,,
502,1001,9,,2026-08-04 07:05:00.000,joe,Inbound Team,Enquiry,Billing,
503,1004,8,8,2026-08-05 00:31:00.000,amy,Inbound Team,Complaints,,
"""
PAYMENTS = """pay_timestamp_utc,tenant_id,contract_id,payment_request_provider,create_program,amount
2026-08-04 08:00:00.000,1001,7,MPESA,p,129.0
2026-08-04 08:00:00.000,1001,7,MPESA,p,129.0
2026-08-05 09:00:00.000,1004,8,BANK,p,3000.0
2026-08-05 09:00:00.000,1004,8,MANUAL,p,0.0
2026-08-01 09:00:00.000,1004,8,BANK,p,500.0
"""
AGENTS = """contact_centre,ameyo_user_id,team,atlas_user_name
Kenya,joe,Upsell,Joe A
Kenya,joe,Attrition,Joe A
Nigeria,amy,Upsell,Amy B
"""


def deliver(folder, dispositions=DISPOSITIONS):
    folder.mkdir(exist_ok=True)
    texts = {"ameyo_calls": CALLS, "atlas_dispositions": dispositions, "payments": PAYMENTS, "agent_mapping": AGENTS}
    for name, text in texts.items():
        (folder / SOURCES[name].file_name).write_text(text)
    return str(folder)


def rate_tables(spark):
    history = spark.createDataFrame(
        [(date(2026, 8, 4), "KES", 129.0)], "rate_date date, currency string, usd_to_local_rate double"
    )
    latest = spark.createDataFrame(
        [("KES", 130.0), ("UGX", 3700.0), ("TZS", 2600.0), ("NGN", 1500.0)], "currency string, usd_to_local_rate double"
    )
    return history, latest


def test_daily_run(spark, tmp_path):
    folder, root = deliver(tmp_path / "in"), str(tmp_path / "out")
    cfg = PipelineConfig(as_of=AS_OF)
    result = run_pipeline(spark, folder, root, cfg, *rate_tables(spark))

    loads = {r.source_name: (r.rows_loaded, r.rejected) for r in result.loads.collect()}
    assert loads == {"ameyo_calls": (3, 0), "atlas_dispositions": (3, 0), "payments": (5, 0), "agent_mapping": (3, 0)}
    assert tuple(result.fx.first()) == ("ok", 9, 3, 0)

    coding = {
        (str(r.call_date_local), r.market, r.agent_name): (r.total_outbound_calls, r.coded_calls, r.agent_has_conflicting_mapping)
        for r in result.tables["fct_coding_rate"].collect()
    }
    assert coding == {("2026-08-04", "Kenya", "Joe A"): (2, 1, True), ("2026-08-05", "Nigeria", "Amy B"): (1, 1, False)}

    paid = {
        r.call_log_id: (r.is_paid_post_call, r.attributed_payment_amount_local, r.attributed_payment_amount_usd,
                        r.used_estimated_fx_rate, r.is_window_closed)
        for r in result.tables["fct_paid_post_call"].collect()
    }
    assert paid == {
        501: (True, 129.0, 1.0, False, True), 502: (False, None, None, False, False), 503: (True, 3000.0, 2.0, True, False),
    }
    daily = {(str(r.day), r.market): r for r in result.tables["agg_daily_summary"].collect()}
    assert set(daily) == {("2026-08-04", "Kenya"), ("2026-08-05", "Nigeria")}
    kenya = daily[("2026-08-04", "Kenya")]
    assert (kenya.total_outbound_calls, kenya.total_dispositions, kenya.inbound_call_count, kenya.value_recovered_usd) == (2, 2, 1, 1.0)

    checks = result.checks.collect()
    failed = [(r.check, r.target, r.severity) for r in checks if not r.passed]
    # the day without any history rate has only TZS, UGX, NGN, KES estimates; 4 August lacks all but KES
    assert failed == []
    assert len([c for c in checks if "." in c.target]) == 33 + 9
    assert len([c for c in checks if c.check == "freshness"]) == 9
    assert spark.table("agg_daily_summary").count() == 2


def test_second_run_skips_unchanged_files_and_keeps_results(spark, tmp_path):
    folder, root = deliver(tmp_path / "in"), str(tmp_path / "out")
    first = run_pipeline(spark, folder, root, PipelineConfig(as_of=AS_OF), *rate_tables(spark))
    later = PipelineConfig(as_of=AS_OF.replace(day=8, hour=12))
    second = run_pipeline(spark, folder, root, later, *rate_tables(spark))
    assert {r.reason for r in second.loads.collect()} == {"unchanged_since_last_run"}
    assert second.fx.first().rows_upserted == 0

    def rows(run):
        return sorted(map(str, run.tables["fct_paid_post_call"].drop("is_window_closed").collect()))

    # the first run's tables are still there to be read
    assert rows(first) == rows(second) and len(rows(first)) == 3
    assert first.tables["fct_paid_post_call"].where("is_window_closed").count() == 1
    assert read_mart(spark, "fct_paid_post_call", root).where("is_window_closed").count() == 3


def test_broken_model_stops_the_run(spark, tmp_path):
    doubled = DISPOSITIONS + DISPOSITIONS.splitlines()[1] + "\n"
    folder, root = deliver(tmp_path / "in", doubled), str(tmp_path / "out")
    with pytest.raises(ChecksFailed, match="unique stg_atlas__dispositions.call_log_id: 1"):
        run_pipeline(spark, folder, root, PipelineConfig(as_of=AS_OF), *rate_tables(spark))
    with pytest.raises(LookupError):
        read_mart(spark, "agg_daily_summary", root)
    go_on = PipelineConfig(as_of=AS_OF, stop_on_failure=False)
    result = run_pipeline(spark, folder, str(tmp_path / "out2"), go_on, *rate_tables(spark))
    assert result.checks.where("NOT passed AND severity = 'ERROR'").count() >= 1


def test_run_without_rate_sources(spark, tmp_path):
    folder, root = deliver(tmp_path / "in"), str(tmp_path / "out")
    result = run_pipeline(spark, folder, root, PipelineConfig(as_of=AS_OF))
    assert result.fx.first().status == "no_api_key"
    paid = result.tables["fct_paid_post_call"].where("is_paid_post_call").collect()
    assert all(r.attributed_payment_amount_usd is None and r.has_unconverted_payment for r in paid)
    coverage = result.checks.where("check = 'covers_dates'").first()
    assert (coverage.severity, coverage.passed) == ("WARN", False)


def test_runs_of_one_clock_and_back_filled_runs_stay_readable(spark, tmp_path):
    folder, root = deliver(tmp_path / "in"), str(tmp_path / "out")
    clock = AS_OF.replace(day=8, hour=12)
    runs = [run_pipeline(spark, folder, root, PipelineConfig(as_of=at), *rate_tables(spark)) for at in (clock, clock, AS_OF)]
    closed = [r.tables["fct_paid_post_call"].where("is_window_closed").count() for r in runs]
    assert closed == [3, 3, 1]
    # the back-filled run was published last and is the one that is read
    assert read_mart(spark, "fct_paid_post_call", root).where("is_window_closed").count() == 1
    sequence = read_runs(spark, root).orderBy("sequence").collect()
    assert [r.sequence for r in sequence] == [1, 2, 3] and len({r.path for r in sequence}) == 3
