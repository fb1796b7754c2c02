"""The daily run: land, stage, match, publish, check."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpay.config import PipelineConfig
from callpay.functions.columns import clock, try_ts
from callpay.operators.checks import run_suite
from callpay.operators.fx import fx_summary, missing_rates, needed_dates, resolve_rates, resolved_only
from callpay.plans import marts, quality
from callpay.plans.intermediate import attribute_payments, code_calls, summarise_payments
from callpay.plans.staging import stage_agents, stage_calls, stage_dispositions, stage_fx, stage_payments
from callpay.sources.contracts import SOURCES, country_seed
from callpay.sources.landing import load_extracts, read_manifest, read_raw
from callpay.sources.tables import ensure_fx_table, export_json_by_date, materialize, read_runs, record_run, store_rates


class ChecksFailed(RuntimeError):
    """A model broke one of its checks; nothing downstream of it was built."""


@dataclass
class RunResult:
    """Everything a run published."""

    loads: DataFrame
    fx: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    checks: DataFrame | None = None


def refresh_rates(
    spark: SparkSession,
    raw_payments: DataFrame,
    root: str,
    run_root: str,
    cfg: PipelineConfig,
    history: DataFrame | None,
    latest: DataFrame | None,
) -> tuple[DataFrame, DataFrame]:
    """Resolve and store what is missing. Returns (stored rates, one-row run summary).

    With neither a history nor a latest table nothing is looked up.
    """
    path = f"{root}/fx_rates"
    stored = ensure_fx_table(spark, path)
    paid_at = try_ts("pay_timestamp_utc")
    missing = missing_rates(raw_payments, stored, cfg.currencies, paid_at)
    nothing = spark.createDataFrame([], "rate_date date, currency string, usd_to_local_rate double")
    resolved = resolve_rates(
        missing,
        history if history is not None else nothing,
        latest if latest is not None else nothing.drop("rate_date"),
        cfg.as_of,
    )
    given = history is not None or latest is not None
    summary = materialize(
        fx_summary(needed_dates(raw_payments, paid_at), resolved, given), "fx_run_summary", "table", run_root
    )
    if not given:
        return stored, summary
    updates = materialize(resolved_only(resolved), "fx_updates", "table", run_root)
    export_json_by_date(updates, f"{root}/fx_export", "rate_date")
    return store_rates(spark, path, updates), summary


def run_pipeline(
    spark: SparkSession,
    input_dir: str,
    root: str,
    cfg: PipelineConfig = PipelineConfig(),
    fx_history: DataFrame | None = None,
    fx_latest: DataFrame | None = None,
) -> RunResult:
    """One daily run below ``root``, a folder every executor can reach.

    Staged tables are stored typed and columnar because several models read
    them; each later model is stored once and read back by its consumers. Every
    run, also a second one for the same clock, rebuilds into a folder of its own, so
    readers of the last run are not disturbed and a failed run leaves it standing.
    """
    now = cfg.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    raw_root, model_root = f"{root}/raw", f"{root}/models/{run_id}"
    result = RunResult(loads=load_extracts(spark, input_dir, raw_root, loaded_at=now), fx=None)
    raw = {name: read_raw(spark, raw_root, c) for name, c in SOURCES.items()}
    fx_raw, result.fx = refresh_rates(spark, raw["payments"], root, model_root, cfg, fx_history, fx_latest)

    seed = country_seed(spark)
    tables, checks = result.tables, []

    def record(name: str, results: list[DataFrame], stops: bool = False) -> None:
        """Run checks now and keep their results; a broken model stops the run."""
        if not results:
            return
        stored = materialize(run_suite(results), f"checks_{name}", "table", model_root)
        checks.append(stored)
        broken = quality.failed(stored).collect()
        if broken and stops and cfg.stop_on_failure:
            raise ChecksFailed("; ".join(f"{r.check} {r.target}: {r.failures}" for r in broken))

    def publish(name: str, df: DataFrame, kind: str = "table") -> DataFrame:
        tables[name] = materialize(df, name, kind, model_root)
        record(name, quality.checks_of(name, tables), stops=True)
        return tables[name]

    publish("country_code_mapping", seed, "view")
    calls = publish("stg_ameyo__calls", stage_calls(raw["ameyo_calls"], seed))
    dispositions = publish("stg_atlas__dispositions", stage_dispositions(raw["atlas_dispositions"], seed))
    payments = publish("stg_atlas__payments", stage_payments(raw["payments"], seed, cfg.payment_key_cols))
    agents = publish("stg_agent_mapping", stage_agents(raw["agent_mapping"]))
    fx = publish("stg_fx__rates", stage_fx(fx_raw), "view")

    coded = publish("int_calls__coded", code_calls(calls, dispositions))
    attribution = publish(
        "int_payment_attribution",
        attribute_payments(payments, dispositions, fx, cfg.window_days, cfg.attribution_key),
    )
    summary = publish("int_call_payment_summary", summarise_payments(attribution))

    coding = publish("fct_coding_rate", marts.coding_rate(coded, agents))
    paid = publish("fct_paid_post_call", marts.paid_post_call(dispositions, summary, cfg.window_days, now))
    inbound = publish(
        "fct_inbound_call_drivers", marts.inbound_drivers(dispositions, cfg.inbound_type, cfg.missing_label)
    )
    publish("agg_daily_summary", marts.daily_summary(coding, paid, inbound, cfg.null_safe_days))

    record("raw", [quality.raw_checks(raw, payments, fx)])
    loads = read_manifest(spark, raw_root).select("source_name", "loaded_at").unionByName(
        fx_raw.select(F.lit("fx_rates").alias("source_name"), F.col("fetched_at").alias("loaded_at"))
    )
    record_run(spark, root, run_id, model_root, now)
    # marts are as fresh as the last run that published them, seen from the run's own clock
    published = read_runs(spark, root).where(F.col("as_of") <= clock(now))
    builds = published.select(
        F.explode(F.array(*[F.lit(n) for n in quality.MART_TARGETS])).alias("source_name"), F.col("as_of").alias("loaded_at")
    )
    record("freshness", [quality.freshness_checks(loads, builds, now)])
    result.checks = run_suite(checks)
    return result
