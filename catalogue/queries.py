"""One query per operator or model. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpay.functions.columns import clean_string, local_to_utc, try_double, try_long, try_ts
from callpay.operators import asof, checks, fx
from callpay.operators.joins import in_order
from callpay.operators.keys import flag_duplicates, hash_key, keep_first
from callpay.operators.matching import explode_digit_runs
from callpay.config import PipelineConfig
from callpay.plans import consume, marts, staging
from callpay.plans.pipeline import run_pipeline
from callpay.sources import extracts, landing, tables
from callpay.sources.contracts import MARKET_ORDER, PAYMENT_COLUMNS, PAYMENT_KEY_SHORT, SOURCES, country_seed
from callpay.session import scratch_path
from callpay.streaming import arrivals, settlement
from catalogue import roles
from catalogue.models import Models
from catalogue.roles import AS_OF, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

METADATA = ("_source_file", "_ingested_at")
SLICE_MARKETS = ["Kenya", "Nigeria"]
SLICE_DAYS = [date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 15)]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Doubles that come from sums or ratios, rounded for comparison."""
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def shown(df: DataFrame) -> DataFrame:
    return df.drop(*METADATA)


# --- staging -----------------------------------------------------------------


@query
def clean_and_type_strings(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = c.select(
        F.col("c_custkey").cast("string").alias("key_text"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "   ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("name_text"),
        F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("balance_text"),
        F.when(F.col("c_nationkey") == 7, "unknown").otherwise(F.col("c_nationkey").cast("string")).alias("nation_text"),
    )
    return raw.select(
        try_long("key_text").alias("custkey"),
        clean_string("name_text").alias("name"),
        try_double("balance_text").alias("balance"),
        try_long("nation_text").alias("nation"),
    )


@query
def local_clock_to_utc(spark, sf_dir):
    """Timestamps from text, moved to UTC by a per-row offset."""
    o = table(spark, sf_dir, "orders")
    placed = try_ts(F.col("o_orderdate").cast("string"))
    offset = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 1)
    return o.select("o_orderkey", local_to_utc(placed, offset).alias("placed_at_utc"))


@query
def bridge_calls_to_market(spark, sf_dir):
    return shown(Models(spark, sf_dir).calls)


@query
def bridge_dispositions(spark, sf_dir):
    return shown(Models(spark, sf_dir).dispositions)


@query
def stage_payments(spark, sf_dir):
    return shown(Models(spark, sf_dir).payments())


@query
def stage_payments_short_key(spark, sf_dir):
    return shown(Models(spark, sf_dir).payments(key_cols=PAYMENT_KEY_SHORT))


@query
def hash_key_payments(spark, sf_dir):
    raw = roles.raw_payments(spark, sf_dir)
    return raw.select("pay_timestamp_utc", "contract_id", "amount", hash_key(PAYMENT_COLUMNS).alias("payment_key"))


@query
def stage_agents(spark, sf_dir):
    return shown(Models(spark, sf_dir).agents)


@query
def stage_fx(spark, sf_dir):
    return Models(spark, sf_dir).fx


@query
def dedupe_lineitem_by_key(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return keep_first(li, keys, [F.col(c).asc_nulls_last() for c in li.columns if c not in keys])


@query
def flag_repeated_lineitem_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return flag_duplicates(li, ["l_orderkey", "l_linenumber"], "is_repeated")


# --- matching and attribution ------------------------------------------------


@query
def digit_run_candidates(spark, sf_dir):
    """Every number named in any document, whole texts."""
    return explode_digit_runs(table(spark, sf_dir, "documents"), "text", "candidate", ["doc_id"])


@query
def code_calls(spark, sf_dir):
    return Models(spark, sf_dir).coded.select(
        "call_id", "agent_ameyo_user_id", "country_name", "matched_call_log_id", "is_coded"
    )


@query
def candidate_calls_in_window(spark, sf_dir):
    """The interval join, counted: calls on the payment's contract in the three days before it."""
    m = Models(spark, sf_dir)
    return asof.count_in_window(
        m.payments().select("payment_row_key", "contract_id", "paid_at_utc"), m.dispositions,
        by=["contract_id"], event_ts="paid_at_utc", anchor_ts="disposed_at_utc", within_days=3, out="candidate_calls",
    )


@query
def candidate_calls_sliced(spark, sf_dir):
    """The same with slices of a day instead of a minute."""
    m = Models(spark, sf_dir)
    return asof.count_in_window(
        m.payments().select("payment_row_key", "contract_id", "paid_at_utc"), m.dispositions,
        by=["contract_id"], event_ts="paid_at_utc", anchor_ts="disposed_at_utc", within_days=3, out="candidate_calls",
        slice_of=F.to_date,
    )


@query
def attribute_payments(spark, sf_dir):
    return rounded(shown(Models(spark, sf_dir).attribution()), amount_usd=6)


@query
def attribute_payments_sliced(spark, sf_dir):
    """Attribution with slices of a day instead of a minute."""
    return rounded(shown(Models(spark, sf_dir).attribution(slice_of=F.to_date)), amount_usd=6)


@query
def attribute_payments_by_tenant(spark, sf_dir):
    by = ("atlas_tenant_id", "contract_id")
    return rounded(shown(Models(spark, sf_dir).attribution(by=by, window_days=1)), amount_usd=6)


@query
def payment_summary(spark, sf_dir):
    return rounded(
        Models(spark, sf_dir).summary, attributed_payment_amount_local=2, attributed_payment_amount_usd=6
    )


def _shipped_and_ordered(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Line items and orders keyed by status: three keys in all, each a large part of the rows."""
    li = table(spark, sf_dir, "lineitem")
    items = li.select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("status"), "l_shipdate")
    return items, table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), "o_orderkey", "o_orderdate")


@query
def nearest_order_by_status(spark, sf_dir):
    """Nearest preceding order of the same status, under extreme key skew and day-grained ties."""
    items, orders = _shipped_and_ordered(spark, sf_dir)
    return asof.attribute_nearest(
        items, orders, by=["status"], event_ts="l_shipdate", anchor_ts="o_orderdate", anchor_id="o_orderkey",
        within_days=3, out="nearest_order",
    )


@query
def orders_in_window_by_status(spark, sf_dir):
    """How many orders of the same status fall into the three days before each shipment."""
    items, orders = _shipped_and_ordered(spark, sf_dir)
    return asof.count_in_window(
        items, orders, by=["status"], event_ts="l_shipdate", anchor_ts="o_orderdate", within_days=3,
        out="orders_in_window",
    )


@query
def nearest_click_before_purchase(spark, sf_dir):
    """The bare operator on typed events: the latest click or view of the user within three days."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    purchases = e.where("event_type = 'purchase'").drop("event_type")
    seen = e.where(F.col("event_type").isin("click", "view")).select("user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("seen_id"))
    return asof.attribute_nearest(
        purchases, seen, by=["user_id"], event_ts="ts", anchor_ts="seen_at", anchor_id="seen_id", within_days=3,
        out="nearest_event",
    )


# --- marts -------------------------------------------------------------------


@query
def coding_rate(spark, sf_dir):
    return rounded(Models(spark, sf_dir).coding, coding_rate=6)


@query
def paid_post_call(spark, sf_dir):
    return rounded(
        shown(Models(spark, sf_dir).paid), attributed_payment_amount_local=2, attributed_payment_amount_usd=6
    )


@query
def inbound_drivers(spark, sf_dir):
    return Models(spark, sf_dir).inbound


@query
def daily_coding(spark, sf_dir):
    return marts.daily_coding(Models(spark, sf_dir).coding)


@query
def daily_paid(spark, sf_dir):
    return rounded(marts.daily_paid(Models(spark, sf_dir).paid), value_recovered_usd=2)


@query
def daily_inbound(spark, sf_dir):
    return marts.daily_inbound(Models(spark, sf_dir).inbound)


def _daily(daily: DataFrame) -> DataFrame:
    return rounded(daily, coding_rate=6, paid_post_call_rate=6, value_recovered_usd=2)


@query
def daily_summary(spark, sf_dir):
    return _daily(Models(spark, sf_dir).daily())


def _without_nigeria(spark, sf_dir) -> Models:
    """Models whose seed lacks one market, so its rows have a NULL market."""
    return Models(spark, sf_dir, country_seed(spark).where("country_name <> 'Nigeria'"))


@query
def daily_summary_unknown_market(spark, sf_dir):
    return _daily(_without_nigeria(spark, sf_dir).daily())


@query
def daily_summary_null_market(spark, sf_dir):
    return _daily(_without_nigeria(spark, sf_dir).daily(null_safe=True))


# --- consumption -------------------------------------------------------------


@query
def slice_mart(spark, sf_dir):
    return _daily(consume.slice_mart(Models(spark, sf_dir).daily(), SLICE_MARKETS, SLICE_DAYS))


@query
def slice_paid_by_time(spark, sf_dir):
    """A slice by day of a mart that stores timestamps."""
    paid = consume.slice_mart(Models(spark, sf_dir).paid, SLICE_MARKETS, SLICE_DAYS, "country_name", "disposed_at_utc")
    return paid.select("call_log_id", "country_name", "disposed_at_utc", "is_paid_post_call")


@query
def kpi_totals(spark, sf_dir):
    daily = consume.slice_mart(Models(spark, sf_dir).daily(), list(MARKET_ORDER))
    return rounded(consume.kpi_totals(daily), coding_rate=6, paid_post_call_rate=6, value_recovered_usd=2)


@query
def market_coding(spark, sf_dir):
    return in_order(rounded(consume.market_coding(Models(spark, sf_dir).coding), coding_rate=6), "market", MARKET_ORDER)


def _market_paid(paid: DataFrame) -> DataFrame:
    return rounded(
        consume.market_paid(paid), value_recovered_local=2, value_recovered_usd=2, paid_post_call_rate=6
    )


@query
def market_paid(spark, sf_dir):
    """Flagship: per market, how many calls were followed by a payment, and how much was paid."""
    return _market_paid(Models(spark, sf_dir).paid)


@query
def paid_rate_two_denominators(spark, sf_dir):
    return rounded(consume.paid_rates(Models(spark, sf_dir).paid), rate_all=6, rate_with_contract=6)


@query
def worst_agents_first(spark, sf_dir):
    keys = ["call_date_local", "market", "campaign_name", "agent_ameyo_user_id"]
    mart = rounded(Models(spark, sf_dir).coding, coding_rate=6)
    return consume.worst_first(mart.select(*keys, "total_outbound_calls", "coded_calls", "coding_rate"), "coding_rate", keys)


@query
def present_markets(spark, sf_dir):
    m = Models(spark, sf_dir)
    return consume.present_markets(m.daily(), m.coding)


@query
def present_days(spark, sf_dir):
    return consume.present_days(Models(spark, sf_dir).daily())


@query
def drill_levels(spark, sf_dir):
    return consume.drill_levels(Models(spark, sf_dir).inbound)


@query
def drill_level_two(spark, sf_dir):
    return consume.drill(Models(spark, sf_dir).inbound, ["L1"])


@query
def drill_level_three(spark, sf_dir):
    return consume.drill(Models(spark, sf_dir).inbound, ["L1", "M2"])


@query
def share_of_total(spark, sf_dir):
    return rounded(consume.share_of_total(consume.drill(Models(spark, sf_dir).inbound), "call_count"), share=6)


@query
def top_driver(spark, sf_dir):
    return consume.top_label(Models(spark, sf_dir).inbound, "level_one")


@query
def default_drill(spark, sf_dir):
    return consume.default_drill(Models(spark, sf_dir).inbound)


# --- exchange rates ----------------------------------------------------------


@query
def fx_needed_dates(spark, sf_dir):
    return fx.needed_dates(roles.raw_payments(spark, sf_dir), try_ts("pay_timestamp_utc"))


@query
def fx_needed_pairs(spark, sf_dir):
    return fx.missing_rates(Models(spark, sf_dir).payments(), roles.raw_fx(spark, sf_dir))


@query
def fx_uncovered_dates(spark, sf_dir):
    m = Models(spark, sf_dir)
    return fx.uncovered_dates(m.payments(), m.fx)


def _rate_sources(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all needed pairs, the known rates as history, the highest known rate per currency)."""
    known = roles.raw_fx(spark, sf_dir)
    latest = known.groupBy("currency").agg(F.max("usd_to_local_rate").alias("usd_to_local_rate"))
    nothing = known.where(F.lit(False))
    return fx.missing_rates(Models(spark, sf_dir).payments(), nothing), known, latest


@query
def fx_resolve(spark, sf_dir):
    return fx.resolve_rates(*_rate_sources(spark, sf_dir), fetched_at=AS_OF)


@query
def fx_run_summary(spark, sf_dir):
    needed = fx.needed_dates(roles.raw_payments(spark, sf_dir), try_ts("pay_timestamp_utc"))
    pairs, history, latest = _rate_sources(spark, sf_dir)
    return fx.fx_summary(needed, fx.resolve_rates(pairs, history, latest.where(F.lit(False)), AS_OF))


@query
def fx_upsert(spark, sf_dir):
    updates = fx.resolved_only(fx.resolve_rates(*_rate_sources(spark, sf_dir), fetched_at=AS_OF))
    return fx.upsert_by_key(roles.raw_fx(spark, sf_dir), updates, ["rate_date", "currency"])


@query
def fx_store_rates(spark, sf_dir):
    """The same upsert against a stored table: the touched days are written anew and published as one version."""
    path = scratch_path(spark, "fx_rates")
    tables.store_rates(spark, path, roles.raw_fx(spark, sf_dir))
    updates = fx.resolved_only(fx.resolve_rates(*_rate_sources(spark, sf_dir), fetched_at=AS_OF))
    return tables.store_rates(spark, path, updates)


@query
def fx_export_json(spark, sf_dir):
    path = scratch_path(spark, "fx_export")
    tables.export_json_by_date(roles.raw_fx(spark, sf_dir), path, "rate_date")
    schema = "rate_date date, currency string, usd_to_local_rate double, y string, m string, d string"
    return spark.read.schema(schema).json(path)


@query
def fx_latest_rows(spark, sf_dir):
    return fx.latest_rates(roles.raw_fx(spark, sf_dir), 10)


# --- checks ------------------------------------------------------------------


@query
def check_not_null(spark, sf_dir):
    return checks.not_null(Models(spark, sf_dir).dispositions, "contract_id")


@query
def check_unique(spark, sf_dir):
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query
def check_relationships(spark, sf_dir):
    return checks.relationships(
        table(spark, sf_dir, "lineitem"), "l_partkey", table(spark, sf_dir, "supplier"), "s_suppkey",
        where="l_returnflag <> 'N'",
    )


@query
def check_unique_combination(spark, sf_dir):
    return checks.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_range(spark, sf_dir):
    return checks.accepted_range(table(spark, sf_dir, "customer"), "c_acctbal", low=0)


@query
def check_expression(spark, sf_dir):
    return checks.expect(table(spark, sf_dir, "lineitem"), "l_tax <= l_discount")


@query
def check_one_to_one(spark, sf_dir):
    return checks.one_to_one(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query
def check_keys_of_a_table(spark, sf_dir):
    """Every key rule of one table, in one scan and one shuffle."""
    rules = [
        checks.unique_rule("o_orderkey"),
        checks.unique_rule("o_custkey"),
        checks.unique_combination_rule(["o_custkey", "o_orderdate"]),
        checks.one_to_one_rule("o_custkey", "o_orderpriority"),
        checks.one_to_one_rule("o_custkey", "o_orderstatus", "o_totalprice > 100000"),
    ]
    return checks.measure_keys(table(spark, sf_dir, "orders"), rules, "orders.")


@query
def several_values_per_key(spark, sf_dir):
    return checks.several_values(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query
def check_has_rows(spark, sf_dir):
    return checks.has_rows(table(spark, sf_dir, "events"))


@query
def check_key_present(spark, sf_dir):
    return checks.key_present(roles.raw_dispositions(spark, sf_dir), "contract_id")


@query
def check_covers_dates(spark, sf_dir):
    m = Models(spark, sf_dir)
    return checks.covers_dates(m.payments(), m.fx)


@query
def check_freshness(spark, sf_dir):
    """Users as sources, their events as loads; one of the fixed targets never loaded anything."""
    loads = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_name"), "ts")
    return checks.freshness(
        loads, loaded_at="ts", now=datetime(2024, 1, 30, 7, 30), allowance=timedelta(hours=2), targets=["1", "user never seen"]
    )


@query
def check_suite(spark, sf_dir):
    """All row rules of a table in one scan, with key checks added."""
    orders = table(spark, sf_dir, "orders")
    rules = [
        checks.has_rows_rule(),
        checks.not_null_rule("o_orderkey"),
        checks.accepted_values_rule("o_orderstatus", ["F", "O"]),
        checks.accepted_range_rule("o_totalprice", low=1000, high=200000, inclusive=False),
        checks.expect_rule("o_orderstatus <> 'F' OR o_totalprice > 5000"),
    ]
    return checks.run_suite([checks.measure(orders, rules, "orders."), checks.unique(orders, "o_custkey", "orders.")])


# --- landing -----------------------------------------------------------------


@query
def load_plan(spark, sf_dir):
    """Documents as delivered files, customers as the registry, labelled documents as already landed."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select(F.col("doc_id").cast("string").alias("file_name"), F.sha2("text", 256).alias("file_hash"))
    done = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    manifest = done.select(F.lit("documents").alias("source_name"), F.sha2("text", 256).alias("file_hash"))
    registry = table(spark, sf_dir, "customer").select(
        F.lit("documents").alias("source_name"), F.col("c_custkey").cast("string").alias("file_name")
    )
    return landing.plan_loads(registry, found, manifest)


@query
def new_documents(spark, sf_dir):
    """Documents whose content was not landed before."""
    docs = table(spark, sf_dir, "documents")
    hashes = docs.select("doc_id", F.col("source").alias("source_name"), F.sha2("text", 256).alias("file_hash"))
    manifest = hashes.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return landing.new_files(hashes, manifest).select("doc_id", "source_name", "file_hash")


@contextmanager
def _splits(spark, size: int) -> Iterator[None]:
    """Files are read in splits of ``size`` bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _split_size(rows: DataFrame, row_bytes: int) -> int:
    """Splits of 16 KB, or larger for large tables: 64 a file or so."""
    return max(1 << 14, rows.count() * row_bytes // 256)


def _written_lines(lines: DataFrame, folder: str) -> None:
    """(bucket, id, value) as one text file per bucket, in the order of ids."""
    lines.repartition("bucket").sortWithinPartitions("bucket", "id").select("bucket", "value").write.partitionBy("bucket").text(folder)


@query
def file_manifest(spark, sf_dir):
    """Orders as text, four files that take many splits each, and their identities."""
    folder, orders = scratch_path(spark, "orders_as_text"), table(spark, sf_dir, "orders")
    value = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus")
    _written_lines(orders.select((F.col("o_orderkey") % 4).alias("bucket"), F.col("o_orderkey").alias("id"), value.alias("value")), folder)
    with _splits(spark, _split_size(orders, 10)):
        hashes = extracts.file_hashes(spark, [folder])
        return hashes.select(F.regexp_extract("uri", "bucket=([0-9]+)", 1).cast("int").alias("bucket"), "file_hash")


def _dirty_delivery(spark, sf_dir) -> str:
    """An agent list made from all orders, with every fault an extract may have, in four files of a folder."""
    key = F.col("o_orderkey")
    agent = F.concat(F.lit("Kenya,u"), key.cast("string"))
    fault = key % 13
    value = (
        F.when(fault == 0, F.concat(agent, F.lit(",Upsell,long,er")))
        .when(fault == 1, agent)
        .when(fault == 2, "")
        .when(fault == 3, F.concat(agent, F.lit(',Upsell,"two\nlines"')))
        .when(fault == 4, F.concat(agent, F.lit(',"said ""hi""",x')))
        .when(fault == 5, F.concat(agent, F.lit(',"a, b",x')))
        .when(fault == 6, "  ")
        .when(fault == 7, F.concat(agent, F.lit(",,")))
        .otherwise(F.concat(agent, F.lit(",Team,"), "o_orderstatus"))
    )
    rows = table(spark, sf_dir, "orders").select((key % 4).alias("bucket"), key.alias("id"), value.alias("value"))
    header = "\ufeff" + ",".join(SOURCES["agent_mapping"].columns)
    heads = rows.select("bucket").distinct().select("bucket", F.lit(-1).cast("bigint").alias("id"), F.lit(header).alias("value"))
    folder = scratch_path(spark, "dirty")
    _written_lines(heads.unionByName(rows), f"{folder}/{SOURCES['agent_mapping'].file_name}")
    return folder


@query
def land_dirty_extract(spark, sf_dir):
    """Rows that are too long, too short, blank, quoted and over two lines, read in many splits: valid and rejected ones."""
    contract, root, folder = SOURCES["agent_mapping"], scratch_path(spark, "raw"), _dirty_delivery(spark, sf_dir)
    with _splits(spark, _split_size(table(spark, sf_dir, "orders"), 24)):
        landing.load_extracts(spark, folder, root, only=["agent_mapping"], loaded_at=AS_OF)
    return _landed_rows(spark, root, contract)


def _landed_rows(spark, root: str, contract) -> DataFrame:
    """Valid rows and rejected ones, these with their reason and line."""
    valid, rejects = landing.read_landed(spark, root, contract)
    cells = F.concat_ws("|", *contract.columns)
    return valid.select(F.lit("valid").alias("kind"), cells.alias("row"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("bigint").alias("line_number")).unionByName(
        rejects.select(F.lit("rejected").alias("kind"), F.col("raw_line").alias("row"), "reason", "line_number")
    )


@query
def load_dirty_summary(spark, sf_dir):
    """The same delivery in numbers."""
    root, folder = scratch_path(spark, "raw"), _dirty_delivery(spark, sf_dir)
    return landing.load_extracts(spark, folder, root, only=["agent_mapping"], loaded_at=AS_OF)


@query
def load_wrong_header(spark, sf_dir):
    """All payments and agents delivered, the agents under another header: left out and said so."""
    folder, root = scratch_path(spark, "delivered"), scratch_path(spark, "raw")
    for name, rows in (
        ("payments", roles.raw_payments(spark, sf_dir)),
        ("agent_mapping", roles.raw_agents(spark, sf_dir).withColumnRenamed(SOURCES["agent_mapping"].columns[0], "renamed")),
    ):
        rows.write.options(header=True, escape='"', emptyValue="").csv(f"{folder}/{SOURCES[name].file_name}")
    return landing.load_extracts(
        spark, folder, root, only=["payments", "agent_mapping"], loaded_at=AS_OF, skip_wrong_headers=True
    )


@query
def stage_landed_payments(spark, sf_dir):
    """Payments landed and staged, with where and when each row came from."""
    root = scratch_path(spark, "raw")
    landing.load_extracts(spark, _delivered(spark, sf_dir), root, only=["payments"], loaded_at=AS_OF)
    staged = staging.stage_payments(landing.read_raw(spark, root, SOURCES["payments"]), country_seed(spark))
    return staged.select(
        "payment_row_key", "contract_id", "paid_at_utc", F.regexp_replace("_source_file", "^part-.*[.]", "part.").alias("source_file"), "_ingested_at"
    )


def _delivered(spark, sf_dir) -> str:
    """The raw roles written out as CSV extracts, part files in a folder of the extract's name."""
    folder = scratch_path(spark, "delivered")
    made = {
        "ameyo_calls": roles.raw_calls, "atlas_dispositions": roles.raw_dispositions,
        "payments": roles.raw_payments, "agent_mapping": roles.raw_agents,
    }
    for name, role in made.items():
        role(spark, sf_dir).write.options(
            header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(f"{folder}/{SOURCES[name].file_name}")
    return folder


@query
def land_csv_roundtrip(spark, sf_dir):
    """Write the payments extract, land it, read the raw layer back."""
    root = scratch_path(spark, "raw")
    landing.load_extracts(spark, _delivered(spark, sf_dir), root, only=["payments"], loaded_at=AS_OF)
    return landing.read_raw(spark, root, SOURCES["payments"]).drop(*METADATA)


@query
def load_summary(spark, sf_dir):
    """Land all four extracts; one row per source."""
    return landing.load_extracts(spark, _delivered(spark, sf_dir), scratch_path(spark, "raw"), loaded_at=AS_OF)


@query
def load_summary_second_run(spark, sf_dir):
    """The same delivery again: every source is skipped."""
    folder, root = _delivered(spark, sf_dir), scratch_path(spark, "raw")
    landing.load_extracts(spark, folder, root, loaded_at=AS_OF)
    return landing.load_extracts(spark, folder, root, loaded_at=AS_OF + timedelta(days=1))


@query
def load_after_crash(spark, sf_dir):
    """A load that lands its rows and dies before it is recorded, repeated on the next day."""
    folder, root = _delivered(spark, sf_dir), scratch_path(spark, "raw")
    contract = SOURCES["payments"]
    files = extracts.find_files(spark, folder, [contract.file_name])
    found = files.join(extracts.file_hashes(spark, [r.path for r in files.select("path").collect()]), "uri").collect()
    landing.land(spark, contract, found, root, AS_OF, "crashed")
    summary = landing.load_extracts(spark, folder, root, only=["payments"], loaded_at=AS_OF + timedelta(days=1))
    readable = landing.read_raw(spark, root, contract).select(F.count(F.lit(1))).scalar()
    return summary.withColumn("rows_readable", readable)


@query
def daily_run(spark, sf_dir):
    """The whole daily run over delivered extracts; the published coding mart, read back from the last run."""
    root = scratch_path(spark, "daily_run")
    cfg = PipelineConfig(as_of=AS_OF, stop_on_failure=False)
    run_pipeline(spark, _delivered(spark, sf_dir), root, cfg, *_rate_sources(spark, sf_dir)[1:])
    return rounded(tables.read_mart(spark, "fct_coding_rate", root), coding_rate=6)


# --- streaming ---------------------------------------------------------------


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return arrivals.stream_table(spark, schema, f"{sf_dir}/events.parquet*")


@query
def stream_landing(spark, sf_dir):
    out = scratch_path(spark, "stream_landing")
    return arrivals.land_stream(_event_stream(spark, sf_dir), f"{out}/table", f"{out}/checkpoint")


@query
def stream_dirty_extract(spark, sf_dir):
    """The dirty delivery of ``land_dirty_extract`` landed by a stream, two files a micro-batch."""
    contract, root, folder = SOURCES["agent_mapping"], scratch_path(spark, "raw"), _dirty_delivery(spark, sf_dir)
    with _splits(spark, _split_size(table(spark, sf_dir, "orders"), 24)):
        arrivals.land_extracts(
            spark, folder, root, f"{root}/checkpoint", ["agent_mapping"], loaded_at=AS_OF, batch_files=2
        )
    return _landed_rows(spark, root, contract)


@query
def stream_then_batch_load(spark, sf_dir):
    """All extracts landed by a stream, run twice; then the batch load finds nothing new and every row is there."""
    root, folder = scratch_path(spark, "raw"), _delivered(spark, sf_dir)
    for _ in range(2):
        arrivals.land_extracts(spark, folder, root, f"{root}/checkpoint", loaded_at=AS_OF)
    summary = landing.load_extracts(spark, folder, root, loaded_at=AS_OF + timedelta(days=1))
    readable = [
        landing.read_raw(spark, root, c).groupBy().agg(F.count(F.lit(1)).alias("rows_readable")).select(
            F.lit(c.name).alias("source_name"), "rows_readable"
        )
        for c in SOURCES.values()
    ]
    return summary.join(checks.run_suite(readable), "source_name")


@query
def stream_dedupe(spark, sf_dir):
    """Events of 100 and more arrive twice; one copy lands."""
    out = scratch_path(spark, "stream_dedupe")
    sent = F.explode(F.sequence(F.lit(1), F.when(F.col("value") >= 100, 2).otherwise(1)))
    twice = _event_stream(spark, sf_dir).select("*", sent.alias("_sent")).drop("_sent")
    return arrivals.land_new(twice, ["event_id"], f"{out}/table", f"{out}/checkpoint")


@query
def stream_attribution(spark, sf_dir):
    """Payments attributed as they arrive; equal to the batch result here."""
    out = scratch_path(spark, "stream_attribution")
    payments = _event_stream(spark, sf_dir).where("event_type = 'purchase'").select(
        F.col("event_id").alias("payment_id"), F.col("user_id").alias("contract_id"), F.col("ts").alias("paid_at_utc")
    )

    def dispositions() -> DataFrame:
        return Models(spark, sf_dir).dispositions.where("contract_id IS NOT NULL")

    return arrivals.attribute_stream(payments, dispositions, f"{out}/table", f"{out}/checkpoint")


#: Rows of so many days arrive together in ``stream_late_calls``.
ARRIVAL_DAYS = 15


@query
def stream_late_calls(spark, sf_dir):
    """Two streams with state: every third call arrives a delivery later than the payments it precedes, and still counts."""
    out = scratch_path(spark, "stream_late_calls")
    payments = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("event_id").alias("payment_id"), F.col("user_id").alias("contract_id"), F.col("ts").alias("paid_at_utc")
    )
    calls = Models(spark, sf_dir).dispositions.select("call_log_id", "contract_id", "disposed_at_utc")

    def delivery(ts: str):
        return F.floor(F.unix_date(F.to_date(ts)) / ARRIVAL_DAYS)

    sent = {
        "payments": payments.withColumn("_delivery", delivery("paid_at_utc")),
        "calls": calls.withColumn("_delivery", delivery("disposed_at_utc") + F.when(F.col("call_log_id") % 3 == 0, 1).otherwise(0)),
    }
    for name, rows in sent.items():
        rows.write.partitionBy("_delivery").parquet(f"{out}/sent/{name}")
    span = spark.read.parquet(f"{out}/sent/calls").unionByName(
        spark.read.parquet(f"{out}/sent/payments"), allowMissingColumns=True
    ).agg(F.min("_delivery").alias("first"), F.max("_delivery").alias("last")).first()

    def settle() -> DataFrame:
        streams = [arrivals.stream_table(spark, df.schema, f"{out}/landed/{n}") for n, df in (("payments", payments), ("calls", calls))]
        return settlement.settle_stream(*streams, f"{out}/settled", f"{out}/checkpoint", late_days=2 * ARRIVAL_DAYS)

    for n in range(span["first"] or 0, (span["last"] or 0) + 1):
        for name in sent:
            new = spark.read.parquet(f"{out}/sent/{name}").where(F.col("_delivery") == n).drop("_delivery")
            new.write.mode("append").parquet(f"{out}/landed/{name}")
        settle()
    far = "9000-01-01"
    settlement.closing_row(payments, paid_at_utc=far).write.mode("append").parquet(f"{out}/landed/payments")
    settlement.closing_row(calls, disposed_at_utc=far, contract_id=-1).write.mode("append").parquet(f"{out}/landed/calls")
    return settle()
