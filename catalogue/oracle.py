"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Written from the definitions, not from the DataFrame code: attribution is an
ASOF join with one bound check, dedupe ranks with ``row_number``, sums per call
are subqueries, counts come from joins. Each statement is the shared definitions it needs plus
one final SELECT.
"""

from __future__ import annotations

# name -> (SQL, names it needs), in dependency order.
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "seed": (
        """SELECT * FROM (VALUES ('Kenya', 1::BIGINT, 1001::BIGINT, 3, 'KES'), ('Uganda', 2, 1002, 3, 'UGX'),
           ('Tanzania', 3, 1003, 3, 'TZS'), ('Nigeria', 4, 1004, 1, 'NGN'))
           AS t(country_name, ameyo_contact_center_id, atlas_tenant_id, tz, currency_code)""",
        (),
    ),
    "calls": (
        """SELECT CAST(event_id AS VARCHAR) AS call_id, CAST(user_id AS VARCHAR) AS agent_ameyo_user_id,
             event_type AS campaign_name, 'outbound' AS call_dial_type, event_type AS system_disposition,
             user_id % 4 + 1 AS ameyo_contact_center_id, value AS total_talk_time_ms, props AS notes_raw,
             ts AS call_placed_at_local, s.country_name, s.atlas_tenant_id, s.currency_code,
             ts - to_hours(s.tz) AS call_placed_at_utc
           FROM events LEFT JOIN seed s ON s.ameyo_contact_center_id = user_id % 4 + 1""",
        ("seed",),
    ),
    "disp": (
        """SELECT event_id AS call_log_id, 1001 + user_id % 4 AS atlas_tenant_id, user_id AS customer_id,
             CASE WHEN event_id % 8 <> 0 THEN user_id END AS contract_id, ts AS disposed_at_utc,
             'agent ' || user_id AS created_by,
             CASE WHEN event_type = 'signup' THEN 'Inbound Team' ELSE 'Outbound Team' END AS call_type,
             'L' || (event_id % 4) AS level_one,
             CASE WHEN event_id % 3 <> 0 THEN 'M' || (event_id % 5) END AS level_two,
             CASE WHEN event_id % 2 <> 0 THEN 'N' || (event_id % 7) END AS level_three,
             s.country_name, s.ameyo_contact_center_id, s.currency_code
           FROM events LEFT JOIN seed s ON s.atlas_tenant_id = 1001 + user_id % 4
           WHERE event_type IN ('click', 'view', 'signup')""",
        ("seed",),
    ),
    "sent": (
        """SELECT e.*, rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS ts_text,
             CASE WHEN event_id % 50 = 0 THEN 'MANUAL' ELSE ' mobile ' END AS provider,
             CASE WHEN event_id % 50 = 0 THEN '0.0' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount
           FROM events e, (VALUES (1), (2)) AS c(n)
           WHERE event_type = 'purchase' AND (n = 1 OR value >= 100)""",
        (),
    ),
    "keyed": (
        """SELECT *, sha256(ts_text || '|' || (1001 + user_id % 4) || '|' || user_id || '|' || provider || '|' || props
             || '|' || amount) AS full_key,
             (1001 + user_id % 4) || '-' || user_id || '-' || ts_text AS short_key
           FROM sent""",
        ("sent",),
    ),
    "pay": (
        """SELECT k.full_key AS payment_row_key, trim(provider) AS payment_provider, props AS ingest_program,
             1001 + user_id % 4 AS atlas_tenant_id, user_id AS contract_id, CAST(amount AS DOUBLE) AS amount_local,
             ts AS paid_at_utc, s.country_name, s.ameyo_contact_center_id, s.currency_code,
             CAST(amount AS DOUBLE) = 0 AS is_zero_amount, k.short_key
           FROM (SELECT *, row_number() OVER (PARTITION BY full_key ORDER BY event_id) AS rn FROM keyed) k
           LEFT JOIN seed s ON s.atlas_tenant_id = 1001 + user_id % 4
           WHERE rn = 1""",
        ("keyed", "seed"),
    ),
    "fx": (
        """SELECT d AS rate_date, currency_code, CAST(100.7 AS DOUBLE) + 10 * ameyo_contact_center_id + day(d) AS usd_to_local_rate,
             day(d) % 2 = 0 AS rate_is_estimated,
             CASE WHEN day(d) % 2 = 0 THEN 'latest_fallback' ELSE 'history' END AS rate_source,
             CAST(d AS TIMESTAMP) AS fetched_at
           FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase') x, seed
           WHERE day(d) % 7 <> 0""",
        ("seed",),
    ),
    "agents": (
        """WITH raw AS (
             SELECT s.country_name, CAST(c_custkey // 10 AS VARCHAR) AS ameyo_user_id, c_mktsegment AS team,
               CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS atlas_user_name
             FROM customer JOIN seed s ON s.ameyo_contact_center_id = (c_custkey // 10) % 4 + 1
             WHERE c_custkey % 10 = 0 OR c_nationkey < 2)
           SELECT country_name, ameyo_user_id, team, atlas_user_name, n > 1 AS has_conflicting_source_rows
           FROM (SELECT *, count(*) OVER (PARTITION BY country_name, ameyo_user_id) AS n,
                   row_number() OVER (PARTITION BY country_name, ameyo_user_id
                     ORDER BY atlas_user_name IS NOT NULL DESC, team DESC NULLS LAST, atlas_user_name DESC NULLS LAST) AS rn
                 FROM raw)
           WHERE rn = 1""",
        ("seed",),
    ),
    "coded": (
        """WITH hits AS (
             SELECT call_id, min(d.call_log_id) AS matched_call_log_id
             FROM (SELECT call_id, TRY_CAST(unnest(regexp_extract_all(notes_raw, '[0-9]+')) AS BIGINT) AS candidate FROM calls) c
             JOIN disp d ON d.call_log_id = c.candidate GROUP BY call_id)
           SELECT calls.*, matched_call_log_id, matched_call_log_id IS NOT NULL AS is_coded
           FROM calls LEFT JOIN hits USING (call_id)""",
        ("calls", "disp"),
    ),
    "attr": (
        """WITH said AS (
             SELECT contract_id, atlas_tenant_id, disposed_at_utc, max(call_log_id) AS call_log_id FROM disp
             WHERE contract_id IS NOT NULL GROUP BY ALL),
           asked AS (SELECT * EXCLUDE (short_key) FROM pay WHERE is_zero_amount = false),
           last_said AS (
             SELECT p.payment_row_key, d.call_log_id, d.disposed_at_utc > p.paid_at_utc - INTERVAL {days} DAY AS in_time
             FROM asked p ASOF JOIN said d ON p.contract_id = d.contract_id {tenant} AND p.paid_at_utc >= d.disposed_at_utc),
           found AS (
             SELECT *, (SELECT call_log_id FROM last_said l WHERE l.payment_row_key = a.payment_row_key AND l.in_time) AS attributed_call_log_id,
               (SELECT {'rate': usd_to_local_rate, 'guess': rate_is_estimated} FROM fx
                WHERE rate_date = a.paid_at_utc::DATE AND fx.currency_code = a.currency_code) AS quote
             FROM asked a)
           SELECT * EXCLUDE (quote), quote.rate AS usd_to_local_rate, quote.guess AS fx_rate_is_estimated,
             attributed_call_log_id IS NOT NULL AS is_attributed_to_a_call, amount_local / quote.rate AS amount_usd
           FROM found""",
        ("pay", "disp", "fx"),
    ),
    "summ": (
        """SELECT paid.call_log_id,
             (SELECT count(*) FROM attr a WHERE a.attributed_call_log_id = paid.call_log_id) AS attributed_payment_count,
             (SELECT sum(amount_local) FROM attr a WHERE a.attributed_call_log_id = paid.call_log_id) AS attributed_payment_amount_local,
             (SELECT sum(amount_usd) FROM attr a WHERE a.attributed_call_log_id = paid.call_log_id) AS attributed_payment_amount_usd,
             paid.call_log_id IN (SELECT attributed_call_log_id FROM attr WHERE amount_usd IS NULL AND attributed_call_log_id IS NOT NULL)
               AS has_unconverted_payment,
             paid.call_log_id IN (SELECT attributed_call_log_id FROM attr WHERE fx_rate_is_estimated AND attributed_call_log_id IS NOT NULL)
               AS used_estimated_fx_rate,
             (SELECT min(paid_at_utc) FROM attr a WHERE a.attributed_call_log_id = paid.call_log_id) AS first_attributed_payment_at
           FROM (SELECT DISTINCT attributed_call_log_id AS call_log_id FROM attr WHERE attributed_call_log_id IS NOT NULL) paid""",
        ("attr",),
    ),
    "coding": (
        """WITH placed AS (
             SELECT CAST(call_placed_at_local AS DATE) AS call_date_local, country_name AS market, campaign_name, agent_ameyo_user_id, is_coded
             FROM coded),
           made AS (SELECT * EXCLUDE (is_coded), count(*) AS n FROM placed GROUP BY ALL),
           hit AS (SELECT * EXCLUDE (is_coded), count(*) AS n FROM placed WHERE is_coded GROUP BY ALL)
           SELECT m.call_date_local, m.market, m.campaign_name, m.agent_ameyo_user_id, a.atlas_user_name AS agent_name, a.team AS agent_team,
             a.has_conflicting_source_rows AS agent_has_conflicting_mapping, m.n AS total_outbound_calls,
             coalesce(h.n, 0) AS coded_calls, coalesce(h.n, 0) / m.n::DOUBLE AS coding_rate
           FROM made m
           LEFT JOIN hit h ON (h.call_date_local, h.market, h.campaign_name, h.agent_ameyo_user_id)
             IS NOT DISTINCT FROM (m.call_date_local, m.market, m.campaign_name, m.agent_ameyo_user_id)
           LEFT JOIN agents a ON (a.country_name, a.ameyo_user_id) = (m.market, m.agent_ameyo_user_id)""",
        ("coded", "agents"),
    ),
    "paid": (
        """SELECT d.*, s.attributed_payment_amount_local, s.attributed_payment_amount_usd, s.first_attributed_payment_at,
             coalesce(s.attributed_payment_count, 0) AS attributed_payment_count,
             coalesce(s.attributed_payment_count, 0) > 0 AS is_paid_post_call,
             coalesce(s.has_unconverted_payment, false) AS has_unconverted_payment,
             coalesce(s.used_estimated_fx_rate, false) AS used_estimated_fx_rate,
             d.disposed_at_utc + INTERVAL 3 DAY AS window_closes_at_utc,
             TIMESTAMP '2024-01-29 00:00:00' >= d.disposed_at_utc + INTERVAL 3 DAY AS is_window_closed
           FROM disp d LEFT JOIN summ s USING (call_log_id)""",
        ("disp", "summ"),
    ),
    "inbound": (
        """SELECT CAST(disposed_at_utc AS DATE) AS disposition_date_utc, country_name AS market,
             coalesce(level_one, 'Not specified') AS level_one, coalesce(level_two, 'Not specified') AS level_two,
             coalesce(level_three, 'Not specified') AS level_three, count(*) AS call_count
           FROM disp WHERE call_type = 'Inbound Team' GROUP BY ALL""",
        ("disp",),
    ),
    "day_coding": (
        """SELECT call_date_local AS day, market, CAST(sum(total_outbound_calls) AS BIGINT) AS total_outbound_calls,
             CAST(sum(coded_calls) AS BIGINT) AS coded_calls FROM coding GROUP BY ALL""",
        ("coding",),
    ),
    "day_paid": (
        """SELECT CAST(disposed_at_utc AS DATE) AS day, country_name AS market, count(*) AS total_dispositions,
             count(*) FILTER (is_paid_post_call) AS paid_post_call_count,
             sum(attributed_payment_amount_usd) AS value_recovered_usd,
             count(*) FILTER (used_estimated_fx_rate) > 0 AS value_recovered_usd_is_estimated,
             count(*) FILTER (NOT is_window_closed) AS still_in_window_count
           FROM paid GROUP BY ALL""",
        ("paid",),
    ),
    "day_inbound": (
        """SELECT disposition_date_utc AS day, market, CAST(sum(call_count) AS BIGINT) AS inbound_call_count
           FROM inbound GROUP BY ALL""",
        ("inbound",),
    ),
    "daily": (
        """WITH three AS (
             SELECT 1 AS part, day, market FROM day_coding UNION ALL SELECT 2, day, market FROM day_paid
             UNION ALL SELECT 3, day, market FROM day_inbound),
           -- a day and market that equal themselves are one row for all three; others stay apart
           listed AS (
             SELECT DISTINCT CASE WHEN coalesce(day {eq} day AND market {eq} market, false) THEN 0 ELSE part END AS part, day, market
             FROM three)
           SELECT e.day, e.market, total_outbound_calls, coded_calls, coded_calls / total_outbound_calls::DOUBLE AS coding_rate,
             total_dispositions, paid_post_call_count, paid_post_call_count / total_dispositions::DOUBLE AS paid_post_call_rate,
             value_recovered_usd, value_recovered_usd_is_estimated, still_in_window_count, inbound_call_count
           FROM listed e
           LEFT JOIN day_coding c ON e.part IN (0, 1) AND (c.day, c.market) IS NOT DISTINCT FROM (e.day, e.market)
           LEFT JOIN day_paid p ON e.part IN (0, 2) AND (p.day, p.market) IS NOT DISTINCT FROM (e.day, e.market)
           LEFT JOIN day_inbound i ON e.part IN (0, 3) AND (i.day, i.market) IS NOT DISTINCT FROM (e.day, e.market)""",
        ("day_coding", "day_paid", "day_inbound"),
    ),
    "resolved": (
        """WITH pairs AS (SELECT DISTINCT CAST(ts AS DATE) AS rate_date, currency_code AS currency
                          FROM events, seed WHERE event_type = 'purchase'),
             hist AS (SELECT * FROM fx),
             late AS (SELECT currency_code, max(usd_to_local_rate) AS rate FROM fx GROUP BY 1)
           SELECT p.rate_date, p.currency,
             CASE WHEN p.rate_date IN (SELECT rate_date FROM hist) THEN h.usd_to_local_rate ELSE l.rate END AS usd_to_local_rate,
             p.rate_date NOT IN (SELECT rate_date FROM hist) AS rate_is_estimated,
             CASE WHEN p.rate_date IN (SELECT rate_date FROM hist) THEN 'history' ELSE 'latest_fallback' END AS rate_source,
             TIMESTAMP '2024-01-29 00:00:00' AS fetched_at
           FROM pairs p LEFT JOIN hist h ON h.rate_date = p.rate_date AND h.currency_code = p.currency
           LEFT JOIN late l ON l.currency_code = p.currency""",
        ("fx", "seed"),
    ),
    "upserted": (
        """SELECT * FROM resolved WHERE usd_to_local_rate IS NOT NULL
           UNION ALL
           SELECT rate_date, currency_code, usd_to_local_rate, rate_is_estimated, rate_source, fetched_at FROM fx
           WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.usd_to_local_rate IS NOT NULL
                             AND r.rate_date = fx.rate_date AND r.currency = fx.currency_code)""",
        ("resolved", "fx"),
    ),
}


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for n in names:
        if n not in seen:
            _needed(_PARTS[n][1], seen)
            seen.append(n)
    return seen


def _sql(select: str, *names: str, days: int = 3, tenant: str = "", eq: str = "=", seed: str = "") -> str:
    fill = {"{days}": str(days), "{tenant}": tenant, "{eq}": eq}
    parts = []
    for n in _needed(names, []):
        body = _PARTS[n][0] + (seed if n == "seed" else "")
        for mark, text in fill.items():
            body = body.replace(mark, text)
        parts.append(f"{n} AS ({body})")
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def _check(name: str, target: str, failures: str, source: str, severity: str = "ERROR") -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{target}' AS target, '{severity}' AS severity, "
        f"CAST(n AS BIGINT) AS failures, n = 0 AS passed FROM (SELECT {failures} AS n FROM {source})"
    )


_ATTR = "SELECT * EXCLUDE (amount_usd), round(amount_usd, 6) AS amount_usd FROM attr"
_DAILY_COLUMNS = """day, market, total_outbound_calls, coded_calls, round(coding_rate, 6) AS coding_rate, total_dispositions,
  paid_post_call_count, round(paid_post_call_rate, 6) AS paid_post_call_rate, round(value_recovered_usd, 2) AS value_recovered_usd,
  value_recovered_usd_is_estimated, still_in_window_count, inbound_call_count"""
_DAILY = f"SELECT {_DAILY_COLUMNS} FROM daily"
_NO_NIGERIA = " WHERE country_name <> 'Nigeria'"
_WINDOW_COUNT = """SELECT p.payment_row_key, p.contract_id, p.paid_at_utc, count(d.call_log_id) AS candidate_calls
  FROM pay p LEFT JOIN disp d ON d.contract_id = p.contract_id AND d.disposed_at_utc <= p.paid_at_utc
    AND d.disposed_at_utc > p.paid_at_utc - INTERVAL 3 DAY
  GROUP BY ALL"""
_SLICE = "IN (DATE '2024-01-08', DATE '2024-01-09', DATE '2024-01-15')"

_DIRTY = """WITH placed AS (
             SELECT o_orderstatus, 'Kenya|u' || o_orderkey AS agent, o_orderkey % 13 AS fault,
               2 + coalesce(sum(CASE WHEN o_orderkey % 13 = 3 THEN 2 ELSE 1 END) OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_number
             FROM orders)"""

ORACLE: dict[str, str] = {
    "clean_and_type_strings": """SELECT c_custkey AS custkey,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS name,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
        CAST(CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS BIGINT) AS nation FROM customer""",
    "local_clock_to_utc": """SELECT o_orderkey, o_orderdate - to_hours(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 END)
        AS placed_at_utc FROM orders""",
    "bridge_calls_to_market": _sql("SELECT * FROM calls", "calls"),
    "bridge_dispositions": _sql("SELECT * FROM disp", "disp"),
    "stage_payments": _sql("SELECT * EXCLUDE (short_key) FROM pay", "pay"),
    "stage_payments_short_key": _sql(
        """SELECT short_key AS payment_row_key, payment_provider, ingest_program, atlas_tenant_id, contract_id, amount_local,
           paid_at_utc, country_name, ameyo_contact_center_id, currency_code, is_zero_amount
           FROM (SELECT *, row_number() OVER (PARTITION BY short_key
                 ORDER BY payment_provider, ingest_program, amount_local) AS rn FROM pay) WHERE rn = 1""",
        "pay",
    ),
    "hash_key_payments": _sql(
        """SELECT ts_text AS pay_timestamp_utc, CAST(user_id AS VARCHAR) AS contract_id, amount, full_key AS payment_key
           FROM keyed""",
        "keyed",
    ),
    "stage_agents": _sql("SELECT * FROM agents", "agents"),
    "stage_fx": _sql("SELECT * FROM fx", "fx"),
    "dedupe_lineitem_by_key": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
    "flag_repeated_lineitem_keys": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_repeated FROM lineitem""",
    "digit_run_candidates": """SELECT doc_id, candidate FROM (SELECT doc_id, TRY_CAST(unnest(list_distinct(
        regexp_extract_all(text, '[0-9]+'))) AS BIGINT) AS candidate FROM documents) WHERE candidate IS NOT NULL""",
    "code_calls": _sql(
        "SELECT call_id, agent_ameyo_user_id, country_name, matched_call_log_id, is_coded FROM coded", "coded"
    ),
    "candidate_calls_in_window": _sql(_WINDOW_COUNT, "pay", "disp"),
    "candidate_calls_sliced": _sql(_WINDOW_COUNT, "pay", "disp"),
    "attribute_payments": _sql(_ATTR, "attr"),
    "attribute_payments_sliced": _sql(_ATTR, "attr"),
    "attribute_payments_by_tenant": _sql(_ATTR, "attr", days=1, tenant="AND d.atlas_tenant_id = p.atlas_tenant_id"),
    "nearest_order_by_status": """WITH a AS (SELECT o_orderstatus AS status, o_orderdate, max(o_orderkey) AS id FROM orders GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, l_linestatus AS status, l_shipdate,
          CASE WHEN a.o_orderdate > l_shipdate - INTERVAL 3 DAY THEN a.id END AS nearest_order
        FROM lineitem ASOF LEFT JOIN a ON a.status = l_linestatus AND l_shipdate >= a.o_orderdate""",
    "orders_in_window_by_status": """WITH d AS (SELECT o_orderstatus AS status, o_orderdate AS d_at, count(*) AS n FROM orders GROUP BY ALL),
        c AS (SELECT status, d_at, sum(n) OVER (PARTITION BY status ORDER BY d_at) AS upto FROM d),
        x AS (SELECT DISTINCT l_linestatus AS status, l_shipdate FROM lineitem),
        y AS (SELECT x.status, x.l_shipdate, coalesce(a.upto, 0) - coalesce(b.upto, 0) AS n FROM x
              ASOF LEFT JOIN c a ON a.status = x.status AND x.l_shipdate >= a.d_at
              ASOF LEFT JOIN c b ON b.status = x.status AND x.l_shipdate - INTERVAL 3 DAY >= b.d_at)
        SELECT l_orderkey, l_linenumber, l_linestatus AS status, l.l_shipdate, CAST(y.n AS BIGINT) AS orders_in_window
        FROM lineitem l JOIN y ON y.status = l_linestatus AND y.l_shipdate = l.l_shipdate""",
    "nearest_click_before_purchase": """WITH r AS (SELECT p.event_id, c.event_id AS seen, row_number() OVER (
          PARTITION BY p.event_id ORDER BY c.ts DESC, c.event_id DESC) AS rn
          FROM events p JOIN events c ON c.user_id = p.user_id AND c.ts <= p.ts AND c.ts > p.ts - INTERVAL 3 DAY
          WHERE p.event_type = 'purchase' AND c.event_type IN ('click', 'view'))
        SELECT p.event_id, p.user_id, p.ts, r.seen AS nearest_event FROM events p
        LEFT JOIN r ON r.event_id = p.event_id AND r.rn = 1 WHERE p.event_type = 'purchase'""",
    "payment_summary": _sql(
        """SELECT * REPLACE (round(attributed_payment_amount_local, 2) AS attributed_payment_amount_local,
             round(attributed_payment_amount_usd, 6) AS attributed_payment_amount_usd) FROM summ""",
        "summ",
    ),
    "coding_rate": _sql("SELECT * REPLACE (round(coding_rate, 6) AS coding_rate) FROM coding", "coding"),
    "paid_post_call": _sql(
        """SELECT * REPLACE (round(attributed_payment_amount_local, 2) AS attributed_payment_amount_local,
             round(attributed_payment_amount_usd, 6) AS attributed_payment_amount_usd) FROM paid""",
        "paid",
    ),
    "inbound_drivers": _sql("SELECT * FROM inbound", "inbound"),
    "daily_coding": _sql("SELECT * FROM day_coding", "day_coding"),
    "daily_paid": _sql("SELECT * REPLACE (round(value_recovered_usd, 2) AS value_recovered_usd) FROM day_paid", "day_paid"),
    "daily_inbound": _sql("SELECT * FROM day_inbound", "day_inbound"),
    "daily_summary": _sql(_DAILY, "daily"),
    "daily_summary_unknown_market": _sql(_DAILY, "daily", seed=_NO_NIGERIA),
    "daily_summary_null_market": _sql(_DAILY, "daily", eq="IS NOT DISTINCT FROM", seed=_NO_NIGERIA),
    "slice_mart": _sql(f"{_DAILY} WHERE market IN ('Kenya', 'Nigeria') AND day {_SLICE}", "daily"),
    "slice_paid_by_time": _sql(
        f"""SELECT call_log_id, country_name, disposed_at_utc, is_paid_post_call FROM paid
            WHERE country_name IN ('Kenya', 'Nigeria') AND CAST(disposed_at_utc AS DATE) {_SLICE}""",
        "paid",
    ),
    "kpi_totals": _sql(
        """SELECT CAST(sum(total_outbound_calls) AS BIGINT) AS total_outbound_calls, CAST(sum(coded_calls) AS BIGINT) AS coded_calls,
             CAST(sum(total_dispositions) AS BIGINT) AS total_dispositions,
             CAST(sum(paid_post_call_count) AS BIGINT) AS paid_post_call_count,
             round(sum(value_recovered_usd), 2) AS value_recovered_usd,
             bool_or(value_recovered_usd_is_estimated) AS value_recovered_usd_is_estimated,
             CAST(sum(inbound_call_count) AS BIGINT) AS inbound_call_count,
             CAST(sum(still_in_window_count) AS BIGINT) AS still_in_window_count,
             round(sum(coded_calls) / CAST(sum(total_outbound_calls) AS DOUBLE), 6) AS coding_rate,
             round(sum(paid_post_call_count) / CAST(sum(total_dispositions) AS DOUBLE), 6) AS paid_post_call_rate
           FROM daily WHERE market IS NOT NULL""",
        "daily",
    ),
    "market_coding": _sql(
        """SELECT market, CAST(sum(total_outbound_calls) AS BIGINT) AS total_outbound_calls,
             CAST(sum(coded_calls) AS BIGINT) AS coded_calls,
             round(sum(coded_calls) / CAST(sum(total_outbound_calls) AS DOUBLE), 6) AS coding_rate
           FROM coding GROUP BY market""",
        "coding",
    ),
    "market_paid": _sql(
        """SELECT country_name AS market, count(*) AS total_dispositions, count(contract_id) AS with_contract,
             count(*) FILTER (is_paid_post_call) AS paid_post_call,
             round(sum(attributed_payment_amount_local), 2) AS value_recovered_local,
             round(sum(attributed_payment_amount_usd), 2) AS value_recovered_usd,
             bool_or(used_estimated_fx_rate) AS value_recovered_usd_is_estimated, max(currency_code) AS currency_code,
             round(count(*) FILTER (is_paid_post_call) / CAST(count(contract_id) AS DOUBLE), 6) AS paid_post_call_rate
           FROM paid GROUP BY 1""",
        "paid",
    ),
    "paid_rate_two_denominators": _sql(
        """SELECT count(*) AS total_dispositions, count(contract_id) AS with_contract,
             count(*) FILTER (is_paid_post_call) AS paid_post_call,
             round(count(*) FILTER (is_paid_post_call) / CAST(count(*) AS DOUBLE), 6) AS rate_all,
             round(count(*) FILTER (is_paid_post_call) / CAST(count(contract_id) AS DOUBLE), 6) AS rate_with_contract
           FROM paid""",
        "paid",
    ),
    "worst_agents_first": _sql(
        """SELECT call_date_local, market, campaign_name, agent_ameyo_user_id, total_outbound_calls, coded_calls,
             round(coding_rate, 6) AS coding_rate FROM coding ORDER BY 7 NULLS LAST, 1, 2, 3, 4""",
        "coding",
    ),
    "present_markets": _sql(
        """SELECT country_name AS market, CAST(ameyo_contact_center_id AS BIGINT) AS position FROM seed
           WHERE country_name IN (SELECT market FROM daily UNION SELECT market FROM coding)""",
        "daily", "coding",
    ),
    "present_days": _sql("SELECT DISTINCT day FROM daily WHERE day IS NOT NULL ORDER BY day", "daily"),
    "drill_levels": _sql(
        """SELECT level_one, level_two, level_three,
             CAST(CASE GROUPING_ID(level_one, level_two, level_three) WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS BIGINT) AS depth,
             CAST(sum(call_count) AS BIGINT) AS call_count FROM inbound GROUP BY ROLLUP (level_one, level_two, level_three)""",
        "inbound",
    ),
    "drill_level_two": _sql(
        """SELECT level_two, CAST(sum(call_count) AS BIGINT) AS call_count FROM inbound WHERE level_one = 'L1'
           GROUP BY 1 ORDER BY 2 DESC, 1""",
        "inbound",
    ),
    "drill_level_three": _sql(
        """SELECT level_three, CAST(sum(call_count) AS BIGINT) AS call_count FROM inbound
           WHERE level_one = 'L1' AND level_two = 'M2' GROUP BY 1 ORDER BY 2 DESC, 1""",
        "inbound",
    ),
    "share_of_total": _sql(
        """SELECT level_one, CAST(sum(call_count) AS BIGINT) AS call_count,
             round(sum(call_count) / CAST((SELECT sum(call_count) FROM inbound) AS DOUBLE), 6) AS share
           FROM inbound GROUP BY 1""",
        "inbound",
    ),
    "top_driver": _sql(
        """SELECT level_one, CAST(sum(call_count) AS BIGINT) AS call_count FROM inbound GROUP BY 1
           ORDER BY 2 DESC, 1 LIMIT 1""",
        "inbound",
    ),
    "default_drill": _sql(
        """, l1 AS (SELECT level_one AS label, sum(call_count) AS n FROM inbound GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1),
           l2 AS (SELECT level_two AS label, sum(call_count) AS n FROM inbound
                  WHERE level_one = (SELECT label FROM l1) GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1),
           l3 AS (SELECT level_three AS label, sum(call_count) AS n FROM inbound
                  WHERE level_one = (SELECT label FROM l1) AND level_two = (SELECT label FROM l2)
                  GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1)
           SELECT CAST(1 AS BIGINT) AS depth, label, CAST(n AS BIGINT) AS call_count FROM l1
           UNION ALL SELECT 2, label, CAST(n AS BIGINT) FROM l2 UNION ALL SELECT 3, label, CAST(n AS BIGINT) FROM l3""",
        "inbound",
    ),
    "fx_needed_dates": """SELECT DISTINCT CAST(ts AS DATE) AS rate_date FROM events WHERE event_type = 'purchase' ORDER BY 1""",
    "fx_needed_pairs": _sql(
        """SELECT DISTINCT CAST(ts AS DATE) AS rate_date, currency_code AS currency FROM events, seed
           WHERE event_type = 'purchase'
           EXCEPT SELECT rate_date, currency_code FROM fx""",
        "fx",
    ),
    "fx_uncovered_dates": _sql(
        """SELECT DISTINCT CAST(paid_at_utc AS DATE) AS rate_date, currency_code FROM pay
           EXCEPT SELECT rate_date, currency_code FROM fx""",
        "pay", "fx",
    ),
    "fx_resolve": _sql("SELECT * FROM resolved", "resolved"),
    "fx_run_summary": _sql(
        """, need AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'),
           hist AS (SELECT rate_date, currency_code FROM fx)
           SELECT CASE WHEN (SELECT count(*) FROM need WHERE d NOT IN (SELECT rate_date FROM hist)) = 0
                       THEN 'ok' ELSE 'partial_failure' END AS status,
             (SELECT count(*) FROM hist) AS rows_upserted, (SELECT count(*) FROM need) AS dates_needed,
             (SELECT count(*) FROM need WHERE d NOT IN (SELECT rate_date FROM hist)) AS dates_failed""",
        "fx",
    ),
    "fx_upsert": _sql("SELECT * FROM upserted", "upserted"),
    "fx_store_rates": _sql("SELECT * FROM upserted", "upserted"),
    "fx_export_json": _sql(
        """SELECT rate_date, currency_code AS currency, usd_to_local_rate, strftime(rate_date, '%Y') AS y,
             strftime(rate_date, '%m') AS m, strftime(rate_date, '%d') AS d FROM fx""",
        "fx",
    ),
    "fx_latest_rows": _sql(
        """SELECT rate_date, currency_code AS currency, usd_to_local_rate, rate_is_estimated, rate_source, fetched_at
           FROM fx ORDER BY rate_date DESC, currency_code LIMIT 10""",
        "fx",
    ),
    "check_not_null": _sql(_check("not_null", "contract_id", "count(*) FILTER (contract_id IS NULL)", "disp"), "disp"),
    "check_unique": _check(
        "unique", "l_orderkey", "count(*)", "(SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)"
    ),
    "check_accepted_values": _check(
        "accepted_values", "o_orderstatus", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", "orders"
    ),
    "check_relationships": _check(
        "relationships", "l_partkey", "count(*)",
        "lineitem WHERE l_returnflag <> 'N' AND l_partkey NOT IN (SELECT s_suppkey FROM supplier)",
    ),
    "check_unique_combination": _check(
        "unique_combination", "l_orderkey,l_linenumber", "count(*)",
        "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    ),
    "check_range": _check("accepted_range", "c_acctbal", "count(*) FILTER (c_acctbal < 0)", "customer"),
    "check_expression": _check("expect", "l_tax <= l_discount", "count(*) FILTER (l_tax > l_discount)", "lineitem"),
    "check_one_to_one": _check(
        "one_to_one", "o_custkey->o_orderpriority", "count(*)",
        "(SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1)",
    ),
    "several_values_per_key": """SELECT o_custkey, count(DISTINCT o_orderpriority) AS value_count FROM orders
        GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1""",
    "check_has_rows": _check("has_rows", "*", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END", "events"),
    "check_key_present": _sql(
        _check("key_present", "contract_id", "count(*) FILTER (contract_id IS NULL)", "disp"), "disp"
    ),
    "check_covers_dates": _sql(
        _check(
            "covers_dates", "rate_date", "count(*)",
            """(SELECT CAST(paid_at_utc AS DATE), currency_code FROM pay
                EXCEPT SELECT rate_date, currency_code FROM fx)""",
            "WARN",
        ),
        "pay", "fx",
    ),
    "check_freshness": """WITH seen AS (SELECT CAST(user_id AS VARCHAR) AS target, ts FROM events
          UNION ALL SELECT 'user never seen', NULL UNION ALL SELECT '1', NULL),
        late AS (SELECT target, coalesce(max(ts) < TIMESTAMP '2024-01-30 04:00:00', true) AS late FROM seen GROUP BY target)
        SELECT 'freshness' AS "check", target, 'ERROR' AS severity, CAST(late AS BIGINT) AS failures, NOT late AS passed
        FROM late""",
    "check_suite": " UNION ALL ".join(
        [
            _check("has_rows", "orders.*", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END", "orders"),
            _check("not_null", "orders.o_orderkey", "count(*) FILTER (o_orderkey IS NULL)", "orders"),
            _check("accepted_values", "orders.o_orderstatus", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", "orders"),
            _check(
                "accepted_range", "orders.o_totalprice",
                "count(*) FILTER (o_totalprice <= 1000 OR o_totalprice >= 200000)", "orders",
            ),
            _check(
                "expect", "orders.o_orderstatus <> ''F'' OR o_totalprice > 5000",
                "count(*) FILTER (o_orderstatus = 'F' AND o_totalprice <= 5000)", "orders",
            ),
            _check(
                "unique", "orders.o_custkey", "count(*)",
                "(SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
            ),
        ]
    ),
    "load_plan": """WITH found AS (SELECT CAST(doc_id AS VARCHAR) AS file_name, sha256(text) AS file_hash FROM documents),
        done AS (SELECT DISTINCT sha256(text) AS file_hash FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
        SELECT 'documents' AS source_name, r.file_name, f.file_hash,
          CASE WHEN f.file_hash IS NULL THEN 'file_not_found' WHEN d.file_hash IS NOT NULL THEN 'unchanged_since_last_run' END AS reason
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS file_name FROM customer) r
        LEFT JOIN found f USING (file_name) LEFT JOIN done d ON d.file_hash = f.file_hash""",
    "new_documents": """SELECT doc_id, source AS source_name, sha256(text) AS file_hash FROM documents
        WHERE (source, sha256(text)) NOT IN (
          SELECT (source, sha256(text)) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))""",
    "land_csv_roundtrip": _sql(
        """SELECT ts_text AS pay_timestamp_utc, CAST(1001 + user_id % 4 AS VARCHAR) AS tenant_id,
             CAST(user_id AS VARCHAR) AS contract_id, provider AS payment_request_provider, props AS create_program,
             amount, full_key AS _payment_row_key FROM keyed""",
        "keyed",
    ),
    "load_summary": _sql(
        """SELECT source_name, false AS skipped, CAST(NULL AS VARCHAR) AS reason, rows_loaded, CAST(0 AS BIGINT) AS rejected FROM (
             SELECT 'ameyo_calls' AS source_name, count(*) AS rows_loaded FROM events
             UNION ALL SELECT 'atlas_dispositions', count(*) FROM disp
             UNION ALL SELECT 'payments', count(*) FROM sent
             UNION ALL SELECT 'agent_mapping', count(*) FROM customer)""",
        "disp", "sent",
    ),
    "load_summary_second_run": """SELECT source_name, true AS skipped, 'unchanged_since_last_run' AS reason,
        CAST(0 AS BIGINT) AS rows_loaded, CAST(0 AS BIGINT) AS rejected
        FROM (VALUES ('ameyo_calls'), ('atlas_dispositions'), ('payments'), ('agent_mapping')) AS t(source_name)""",
    "stream_landing": "SELECT * FROM events",
    "stream_dedupe": "SELECT * FROM events",
    "daily_run": _sql("SELECT * REPLACE (round(coding_rate, 6) AS coding_rate) FROM coding", "coding"),
    "load_after_crash": _sql(
        """SELECT 'payments' AS source_name, false AS skipped, CAST(NULL AS VARCHAR) AS reason,
             count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rejected, count(*) AS rows_readable FROM sent""",
        "sent",
    ),
    "file_manifest": """WITH lines AS (SELECT o_orderkey % 4 AS bucket, o_orderkey || ',' || o_orderstatus AS line,
             row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1 AS i FROM orders),
        coded AS (SELECT *, CAST('0x' || substr(sha256(line), 1, 15) AS BIGINT)::HUGEINT AS a,
             CAST('0x' || substr(sha256(line), 16, 15) AS BIGINT)::HUGEINT AS b FROM lines),
        sums AS (SELECT bucket, sum(strlen(line) + 1) AS size, count(*) AS n, sum(a) AS a, sum(a * i) AS ai, sum(b) AS b, sum(b * i) AS bi
                 FROM coded GROUP BY bucket)
        SELECT bucket::INTEGER AS bucket, sha256(concat_ws(':', size, n, a, ai, b, bi)) AS file_hash FROM sums""",
    "land_dirty_extract": f"""{_DIRTY}
        SELECT 'valid' AS kind, CASE fault WHEN 3 THEN agent || '|Upsell|two' || chr(10) || 'lines' WHEN 4 THEN agent || '|said "hi"|x'
             WHEN 5 THEN agent || '|a, b|x' WHEN 7 THEN agent || '||' ELSE agent || '|Team|' || o_orderstatus END AS row,
             CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS line_number
        FROM placed WHERE fault NOT IN (0, 1, 2, 6)
        UNION ALL
        SELECT 'rejected', CASE fault WHEN 0 THEN replace(agent, '|', ',') || ',Upsell,long,er' WHEN 1 THEN replace(agent, '|', ',')
             WHEN 2 THEN '' ELSE '  ' END,
             'expected 4 fields, got ' || CASE fault WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE 1 END, line_number::BIGINT
        FROM placed WHERE fault IN (0, 1, 2, 6)""",
    "load_dirty_summary": f"""{_DIRTY}
        SELECT 'agent_mapping' AS source_name, false AS skipped, CAST(NULL AS VARCHAR) AS reason,
             count(*) FILTER (fault NOT IN (0, 1, 2, 6)) AS rows_loaded, count(*) FILTER (fault IN (0, 1, 2, 6)) AS rejected FROM placed""",
    "load_wrong_header": _sql(
        """SELECT 'payments' AS source_name, false AS skipped, CAST(NULL AS VARCHAR) AS reason, count(*) AS rows_loaded,
             CAST(0 AS BIGINT) AS rejected FROM sent
           UNION ALL SELECT 'agent_mapping', true, 'wrong_header', 0, 0""",
        "sent",
    ),
    "stage_landed_payments": _sql(
        """SELECT payment_row_key, contract_id, paid_at_utc, 'part.csv' AS source_file, TIMESTAMP '2024-01-29 00:00:00' AS _ingested_at
           FROM pay""",
        "pay",
    ),
    "stream_attribution": _sql(
        """, ranked AS (SELECT e.event_id, d.call_log_id, row_number() OVER (PARTITION BY e.event_id
             ORDER BY d.disposed_at_utc DESC, d.call_log_id DESC) AS rn
             FROM events e JOIN disp d ON d.contract_id = e.user_id AND d.disposed_at_utc <= e.ts
               AND d.disposed_at_utc > e.ts - INTERVAL 3 DAY WHERE event_type = 'purchase')
           SELECT e.event_id AS payment_id, e.user_id AS contract_id, e.ts AS paid_at_utc,
             r.call_log_id AS attributed_call_log_id
           FROM events e LEFT JOIN ranked r ON r.event_id = e.event_id AND r.rn = 1 WHERE event_type = 'purchase'""",
        "disp",
    ),
}
ORACLE["stream_late_calls"] = ORACLE["stream_attribution"]
ORACLE["stream_dirty_extract"] = ORACLE["land_dirty_extract"]
ORACLE["stream_then_batch_load"] = f"""SELECT source_name, true AS skipped, 'unchanged_since_last_run' AS reason,
    CAST(0 AS BIGINT) AS rows_loaded, CAST(0 AS BIGINT) AS rejected, rows_loaded AS rows_readable FROM ({ORACLE["load_summary"]})"""
ORACLE["check_keys_of_a_table"] = " UNION ALL ".join(
    _check(check, f"orders.{target}", "count(*)", f"(SELECT {keys} FROM orders GROUP BY {keys} HAVING {fails})")
    for check, target, keys, fails in (
        ("unique", "o_orderkey", "o_orderkey", "count(*) > 1"),
        ("unique", "o_custkey", "o_custkey", "count(*) > 1"),
        ("unique_combination", "o_custkey,o_orderdate", "o_custkey, o_orderdate", "count(*) > 1"),
        ("one_to_one", "o_custkey->o_orderpriority", "o_custkey", "count(DISTINCT o_orderpriority) > 1"),
        ("one_to_one", "o_custkey->o_orderstatus", "o_custkey",
         "count(DISTINCT o_orderstatus) FILTER (o_totalprice > 100000) > 1"),
    )
)
