"""SQL for every query of `parity.queries` that SQL can express, for an independent engine.

The common tables are written the plain way, with self-joins and separate aggregates, and
share nothing with the DataFrame plans but the meaning.
"""

from __future__ import annotations

from parity.queries import BREACH, SHARE, TOP_N, TOP_SHARE, WARNING, Z


def _pad(prefix: str, number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, CAST(greatest(length({digits}), {width}) AS INTEGER), '0')"


def _day(key: str) -> str:
    return f"DATE '2024-01-01' + CAST({key} % 30 AS INTEGER)"


def _currency(even: str) -> str:
    return f"CASE WHEN {even} THEN 'THB' ELSE 'USD' END"


def _money(*names: str) -> str:
    return ", ".join(f"round({n}, 2) + 0.0 AS {n}" for n in names)


def _ratio(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def _text(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


_ANY = "max(CASE WHEN {0} THEN 1 WHEN NOT {0} THEN 0 END) = 1"

_COMMON = {
    "tx": f"""
        SELECT CAST(event_id AS VARCHAR) AS tx_id, ts AS event_ts, CAST(ts AS DATE) AS value_date,
               {_pad("A", "user_id", 6)} AS account_id,
               CASE WHEN event_id % 3 = 0 THEN 'CP000000' ELSE {_pad("CP", "(user_id + 1)", 6)} END AS counterparty_id,
               {_currency("event_id % 2 = 0")} AS currency,
               CASE WHEN event_type IN ('click', 'error') THEN 'OUT' ELSE 'IN' END AS direction,
               value AS amount, event_type AS product,
               'CH' || CAST(event_id % 5 AS VARCHAR) AS channel
        FROM events""",
    "cf": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS cf_id,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of_date,
               CAST(date_trunc('month', l_shipdate) AS DATE)
                   + CAST((l_orderkey * 7 + l_linenumber) % 121 - 10 AS INTEGER) AS maturity_date,
               {_pad("CP", "l_suppkey", 6)} AS counterparty_id,
               {_currency("l_returnflag <> 'R'")} AS currency,
               CASE WHEN l_linestatus = 'O' THEN 'IN' ELSE 'OUT' END AS direction,
               l_extendedprice AS amount, 'loan' AS source
        FROM lineitem""",
    "bal": f"""
        SELECT {_day("c_custkey")} AS as_of_date, {_pad("A", "c_custkey", 6)} AS account_id,
               {_currency("(c_custkey // 30) % 2 = 0")} AS currency, c_acctbal AS balance,
               c_mktsegment AS customer_segment
        FROM customer""",
    "col": f"""
        SELECT {_day("p_partkey")} AS as_of_date, {_pad("COL", "p_partkey", 8)} AS collateral_id,
               {_pad("CP", "(p_partkey % 1000)", 6)} AS counterparty_id,
               {_currency("(p_partkey // 30) % 2 = 0")} AS currency, p_retailprice AS market_value,
               (p_size % 21) / 100.0::DOUBLE AS haircut_pct,
               CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS INTEGER) AS eligible_lcr
        FROM part""",
    "lim_rows": f"""
        SELECT {_day("o_orderkey")} AS as_of_date,
               CASE WHEN o_custkey % 10 = 0 THEN 'CP000000'
                    ELSE {_pad("CP", "(o_custkey // 10 + 1)", 6)} END AS counterparty_id,
               CASE (o_orderkey // 60) % 3 WHEN 0 THEN 'intraday' WHEN 1 THEN 'settlement'
                    ELSE 'credit' END AS limit_type,
               {_currency("(o_orderkey // 30) % 2 = 0")} AS currency, o_totalprice
        FROM orders""",
    "lim": """
        SELECT as_of_date, counterparty_id, limit_type, currency,
               sum(o_totalprice) * 0.0004::DOUBLE + 200 AS limit_amount
        FROM lim_rows GROUP BY as_of_date, counterparty_id, limit_type, currency""",
    "txb": """
        SELECT *, date_trunc('hour', event_ts) AS bucket_start_ts,
               CASE WHEN direction = 'IN' THEN amount ELSE -amount END AS signed_amount
        FROM tx""",
    "net": """
        SELECT value_date, currency, bucket_start_ts, sum(signed_amount) AS net_cashflow,
               sum(CASE WHEN direction = 'IN' THEN amount ELSE 0 END) AS inflow,
               sum(CASE WHEN direction = 'OUT' THEN amount ELSE 0 END) AS outflow,
               count(*) AS tx_count
        FROM txb GROUP BY ALL""",
    "running": """
        SELECT *, sum(net_cashflow) OVER (PARTITION BY value_date, currency ORDER BY bucket_start_ts) AS cum_net_cashflow
        FROM net""",
    "snap": """
        SELECT *, min(cum_net_cashflow) OVER w AS min_cum_net_cashflow, max(cum_net_cashflow) OVER w AS max_cum_net_cashflow
        FROM running WINDOW w AS (PARTITION BY value_date, currency ORDER BY bucket_start_ts)""",
    "delta": """
        SELECT *, cum_net_cashflow - lag(cum_net_cashflow)
                  OVER (PARTITION BY currency ORDER BY value_date, bucket_start_ts) AS delta_cum
        FROM snap""",
    "stats": """
        SELECT currency, avg(delta_cum) AS mu, stddev_pop(delta_cum) AS sigma FROM delta GROUP BY currency""",
    "zscore": """
        SELECT d.*, CASE WHEN sigma > 0 THEN (delta_cum - mu) / sigma ELSE 0.0 END AS delta_z
        FROM delta d JOIN stats USING (currency)""",
    "flagged": f"SELECT *, delta_z <= -{Z}::DOUBLE AS flag_liquidity_drop FROM zscore",
    "drops": f"""
        SELECT value_date, currency, {_ANY.format("flag_liquidity_drop")} AS flag_liquidity_drop_any,
               min(delta_z) AS min_delta_z
        FROM flagged GROUP BY ALL""",
    "closing": """
        SELECT value_date, currency, cum_net_cashflow AS eod_cum_net_cashflow
        FROM snap QUALIFY row_number() OVER (PARTITION BY value_date, currency ORDER BY bucket_start_ts DESC) = 1""",
    "extremes": """
        SELECT value_date, currency, min(cum_net_cashflow) AS worst_cum_net_cashflow,
               max(cum_net_cashflow) AS best_cum_net_cashflow
        FROM snap GROUP BY ALL""",
    "cp": """
        SELECT value_date, currency, counterparty_id, sum(signed_amount) AS cp_net_flow,
               sum(abs(signed_amount)) AS cp_gross_flow
        FROM txb GROUP BY ALL""",
    "outflows": """
        SELECT value_date, currency, counterparty_id, sum(amount) AS cp_outflow, count(*) AS cp_out_count
        FROM tx WHERE direction = 'OUT' GROUP BY ALL""",
    "totals": "SELECT value_date, currency, sum(cp_gross_flow) AS total_gross_flow FROM cp GROUP BY ALL",
    "shares": """
        SELECT cp.*, total_gross_flow,
               CASE WHEN total_gross_flow > 0 THEN cp_gross_flow / total_gross_flow ELSE 0.0 END AS cp_share
        FROM cp LEFT JOIN totals USING (value_date, currency)""",
    "ranked": """
        SELECT *, CAST(row_number() OVER (PARTITION BY value_date, currency
                                          ORDER BY cp_share DESC, counterparty_id) AS INTEGER) AS cp_rank
        FROM shares""",
    "conc": f"""
        SELECT value_date, currency, max(CASE WHEN cp_rank = 1 THEN cp_share ELSE 0.0 END) AS top1_share,
               sum(CASE WHEN cp_rank <= {TOP_N} THEN cp_share ELSE 0.0 END) AS "topN_share",
               CAST({TOP_N} AS INTEGER) AS "topN"
        FROM ranked GROUP BY ALL""",
    "util": f"""
        SELECT *, utilization >= {WARNING}::DOUBLE AS flag_limit_warning, utilization >= {BREACH}::DOUBLE AS flag_limit_breach
        FROM (SELECT o.value_date, o.currency, o.counterparty_id, cp_outflow, limit_type, limit_amount,
                     CASE WHEN limit_amount > 0 THEN cp_outflow / limit_amount END AS utilization
              FROM outflows o LEFT JOIN (SELECT * FROM lim WHERE limit_type = 'settlement') l
              ON o.value_date = l.as_of_date AND o.currency = l.currency AND o.counterparty_id = l.counterparty_id)""",
    "lim_flags": f"""
        SELECT value_date, currency, {_ANY.format("flag_limit_warning")} AS flag_limit_warning_any,
               {_ANY.format("flag_limit_breach")} AS flag_limit_breach_any, max(utilization) AS max_utilization
        FROM util GROUP BY ALL""",
    "bal_sum": """
        SELECT as_of_date AS value_date, currency, sum(balance) AS total_balance FROM bal GROUP BY ALL""",
    "col_sum": """
        SELECT as_of_date AS value_date, currency, sum(market_value * (1.0::DOUBLE - haircut_pct)) AS eligible_collateral_value
        FROM col WHERE eligible_lcr = 1 GROUP BY ALL""",
    "base": "SELECT * FROM bal_sum LEFT JOIN col_sum USING (value_date, currency)",
    "daily": f"""
        SELECT *, "top1_share" >= {SHARE}::DOUBLE AS flag_concentration,
               concat_ws(',', CASE WHEN "top1_share" >= {SHARE}::DOUBLE THEN 'CONCENTRATION' END,
                              CASE WHEN flag_liquidity_drop_any THEN 'LIQUIDITY_DROP' END,
                              CASE WHEN flag_limit_breach_any THEN 'LIMIT_BREACH' END) AS anomaly_flags
        FROM closing LEFT JOIN extremes USING (value_date, currency)
        LEFT JOIN drops USING (value_date, currency)
        LEFT JOIN lim_flags USING (value_date, currency)
        LEFT JOIN base USING (value_date, currency)
        LEFT JOIN conc USING (value_date, currency)""",
    "ladder_rows": """
        SELECT *, date_diff('day', as_of_date, maturity_date) AS days,
               CASE WHEN days < 0 THEN 'past_due' WHEN days = 0 THEN 't0'
                    WHEN days BETWEEN 1 AND 7 THEN 't1_7d' WHEN days BETWEEN 8 AND 30 THEN 't8_30d'
                    WHEN days BETWEEN 31 AND 90 THEN 't31_90d' ELSE 't90d_plus' END AS maturity_bucket
        FROM cf""",
    "ladder": """
        SELECT as_of_date, currency, maturity_bucket,
               sum(CASE WHEN direction = 'IN' THEN amount ELSE -amount END) AS net_cashflow,
               sum(CASE WHEN direction = 'IN' THEN amount ELSE 0 END) AS inflow,
               sum(CASE WHEN direction = 'OUT' THEN amount ELSE 0 END) AS outflow, count(*) AS cf_count
        FROM ladder_rows GROUP BY ALL""",
}


def _duplicates(table: str, keys: str, name: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, CAST(n = 0 AS VARCHAR) AS passed,
               CASE WHEN n = 0 THEN 'ok' ELSE 'duplicate_rows=' || CAST(n AS VARCHAR) END AS details
        FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n
              FROM (SELECT count(*) AS c FROM {table} GROUP BY {keys} HAVING count(*) > 1))"""


def _nulls(table: str, columns: list[str], name: str) -> str:
    found = ", ".join(
        f"CASE WHEN count(*) FILTER ({c} IS NULL) > 0 THEN '''{c}'': ' || CAST(count(*) FILTER ({c} IS NULL) AS VARCHAR) END"
        for c in columns
    )
    return f"""
        SELECT '{name}' AS check_name, CAST(bad = '' AS VARCHAR) AS passed,
               CASE WHEN bad = '' THEN 'ok' ELSE 'null_counts={{' || bad || '}}' END AS details
        FROM (SELECT concat_ws(', ', {found}) AS bad FROM {table})"""


def _rowcount(table: str, low: int, high: int, name: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, CAST(count(*) BETWEEN {low} AND {high} AS VARCHAR) AS passed,
               'rowcount=' || CAST(count(*) AS VARCHAR) || ', expected=[{low},{high}]' AS details
        FROM {table}"""


_DQ_NULLED = """(SELECT tx_id, nullif(counterparty_id, 'CP000000') AS counterparty_id,
                        nullif(channel, 'CH4') AS channel, amount FROM tx)"""

_DQ_SUITE = [
    _nulls("tx", ["tx_id", "event_ts", "value_date", "account_id", "currency", "direction", "amount"], "tx_no_nulls"),
    _duplicates("tx", "tx_id", "tx_pk_unique"),
    _rowcount("tx", 1, 10_000_000, "tx_volume_sanity"),
    _nulls(
        "cf",
        ["cf_id", "as_of_date", "maturity_date", "counterparty_id", "currency", "direction", "amount"],
        "cf_no_nulls",
    ),
    _duplicates("cf", "cf_id", "cf_pk_unique"),
    _nulls("bal", ["as_of_date", "account_id", "currency", "balance"], "bal_no_nulls"),
    _duplicates("bal", "as_of_date, account_id, currency", "bal_key_unique"),
    _nulls("col", ["as_of_date", "collateral_id", "counterparty_id", "currency", "market_value"], "col_no_nulls"),
    _duplicates("col", "collateral_id", "col_pk_unique"),
    _nulls("lim", ["as_of_date", "counterparty_id", "limit_type", "currency", "limit_amount"], "lim_no_nulls"),
    _duplicates("lim", "as_of_date, counterparty_id, limit_type, currency", "lim_key_unique"),
]

_DAILY = f"""
    SELECT value_date, currency, {_money("eod_cum_net_cashflow", "worst_cum_net_cashflow", "best_cum_net_cashflow")},
           {_text("flag_liquidity_drop_any", "flag_limit_warning_any", "flag_limit_breach_any", "flag_concentration")},
           {_ratio("min_delta_z", "max_utilization", "top1_share")}, round("topN_share", 6) + 0.0 AS "topN_share", "topN",
           {_money("total_balance")}, round(eligible_collateral_value, 3) + 0.0 AS eligible_collateral_value, anomaly_flags
    FROM daily"""

_UTILIZATION = f"""
    SELECT value_date, currency, counterparty_id, {_money("cp_outflow")}, limit_type,
           {_ratio("limit_amount", "utilization")}, {_text("flag_limit_warning", "flag_limit_breach")}
    FROM util"""

_SELECTS = {
    "transactions_table": "SELECT * FROM tx",
    "cashflows_table": "SELECT * FROM cf",
    "balances_table": "SELECT * FROM bal",
    "collateral_table": "SELECT * FROM col",
    "limits_table": f"SELECT as_of_date, counterparty_id, limit_type, {_ratio('limit_amount')}, currency FROM lim",
    "signed_amounts": "SELECT tx_id, direction, signed_amount FROM txb",
    "hour_bucket": "SELECT tx_id, bucket_start_ts FROM txb",
    "fine_buckets": """
        SELECT tx_id, time_bucket(INTERVAL 30 MINUTE, event_ts) AS half_hour_ts,
               date_trunc('minute', event_ts) AS bucket_start_ts FROM tx""",
    "zoned_bucket": """
        SELECT tx_id, date_trunc('hour', event_ts + INTERVAL 330 MINUTE) - INTERVAL 330 MINUTE AS bucket_start_ts
        FROM tx""",
    "maturity_bucket": "SELECT cf_id, as_of_date, maturity_date, maturity_bucket FROM ladder_rows",
    "net_cashflow_by_bucket": f"""
        SELECT value_date, currency, bucket_start_ts, {_money("net_cashflow", "inflow", "outflow")}, tx_count FROM net""",
    "maturity_ladder": f"""
        SELECT as_of_date, currency, maturity_bucket, {_money("net_cashflow", "inflow", "outflow")}, cf_count FROM ladder""",
    "maturity_ladder_sorted": f"""
        SELECT as_of_date, currency, maturity_bucket, {_money("net_cashflow")}, cf_count FROM ladder
        ORDER BY as_of_date, currency, maturity_bucket""",
    "intraday_snapshot": f"""
        SELECT value_date, currency, bucket_start_ts,
               {_money("net_cashflow", "cum_net_cashflow", "min_cum_net_cashflow", "max_cum_net_cashflow")} FROM snap""",
    "delta_and_z": f"""
        SELECT value_date, currency, bucket_start_ts, {_money("delta_cum")}, {_ratio("delta_z")} FROM zscore""",
    "liquidity_drop_flags": f"SELECT value_date, currency, bucket_start_ts, {_text('flag_liquidity_drop')} FROM flagged",
    "daily_drop_rollup": f"""
        SELECT value_date, currency, {_text("flag_liquidity_drop_any")}, {_ratio("min_delta_z")} FROM drops""",
    "daily_from_intraday": f"""
        SELECT value_date, currency, {_money("eod_cum_net_cashflow", "worst_cum_net_cashflow", "best_cum_net_cashflow")}
        FROM closing LEFT JOIN extremes USING (value_date, currency)""",
    "intraday_running_balance": """
        SELECT value_date, currency, bucket_start_ts, bucket_start_ts + INTERVAL 1 HOUR AS bucket_end_ts,
               round(total_balance + cum_net_cashflow, 2) + 0.0 AS running_balance
        FROM snap LEFT JOIN bal_sum USING (value_date, currency)""",
    "counterparty_flows": f"""
        SELECT value_date, currency, counterparty_id, {_money("cp_net_flow", "cp_gross_flow", "cp_outflow")},
               coalesce(cp_out_count, 0) AS cp_out_count
        FROM cp LEFT JOIN outflows USING (value_date, currency, counterparty_id)""",
    "day_gross_total": f"SELECT value_date, currency, {_money('total_gross_flow')} FROM totals",
    "concentration_top": f"""
        SELECT value_date, currency, counterparty_id, {_money("cp_net_flow", "cp_gross_flow", "total_gross_flow")},
               {_ratio("cp_share", "top1_share")}, cp_rank, round("topN_share", 6) + 0.0 AS "topN_share", "topN"
        FROM ranked LEFT JOIN conc USING (value_date, currency) WHERE cp_rank <= {TOP_N}""",
    "concentration_flags": f"""
        SELECT value_date, currency, {_ratio("top1_share")}, round("topN_share", 6) + 0.0 AS "topN_share", "topN",
               CAST(conc.top1_share >= {SHARE}::DOUBLE AS VARCHAR) AS flag_concentration
        FROM conc""",
    "concentration_flags_top_n": f"""
        SELECT value_date, currency, round("topN_share", 6) + 0.0 AS "topN_share",
               CAST(conc."topN_share" >= {TOP_SHARE}::DOUBLE AS VARCHAR) AS flag_concentration
        FROM conc""",
    "counterparty_outflow": f"SELECT value_date, currency, counterparty_id, {_money('cp_outflow')} FROM outflows",
    "limit_utilization": _UTILIZATION,
    "bucketed_limit_utilization": _UTILIZATION,
    "daily_limit_flags": f"""
        SELECT value_date, currency, {_text("flag_limit_warning_any", "flag_limit_breach_any")},
               {_ratio("max_utilization")} FROM lim_flags""",
    "balance_total": f"SELECT value_date, currency, {_money('total_balance')} FROM bal_sum",
    "eligible_collateral": """
        SELECT value_date, currency, round(eligible_collateral_value, 3) + 0.0 AS eligible_collateral_value FROM col_sum""",
    "liquidity_base": f"""
        SELECT value_date, currency, {_money("total_balance")},
               round(eligible_collateral_value, 3) + 0.0 AS eligible_collateral_value,
               round(base.total_balance + coalesce(base.eligible_collateral_value, 0.0), 3) + 0.0 AS total_liquidity
        FROM base""",
    "anomaly_flags": "SELECT value_date, currency, anomaly_flags FROM daily",
    "daily_snapshot": _DAILY,
    "daily_snapshot_staged": _DAILY,
    "daily_snapshot_lazy": _DAILY,
    "monitoring_written": _DAILY,
    "monitoring_rerun": _DAILY,
    "monitoring_versioned": _DAILY,
    "net_cashflow_stream": f"""
        SELECT value_date, currency, bucket_start_ts, {_money("net_cashflow", "inflow", "outflow")}, tx_count FROM net
        WHERE bucket_start_ts + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM tx) - INTERVAL 2 HOUR""",
    "limit_utilization_split": """
        SELECT o.value_date, o.currency, o.counterparty_id, round(max(cp_outflow), 2) + 0.0 AS cp_outflow,
               count(limit_amount) AS n_limits, round(max(cp_outflow / limit_amount), 6) + 0.0 AS max_utilization,
               round(min(cp_outflow / limit_amount), 6) + 0.0 AS min_utilization
        FROM outflows o LEFT JOIN (
            SELECT as_of_date AS value_date, currency, counterparty_id, o_totalprice * 0.0004::DOUBLE + 200 AS limit_amount
            FROM lim_rows WHERE limit_type = 'settlement') USING (value_date, currency, counterparty_id)
        GROUP BY o.value_date, o.currency, o.counterparty_id""",
    "hash_assignment": """
        SELECT o_orderkey, o_orderkey % 7 AS key_group, 'true' AS in_range, 'true' AS stays FROM orders""",
    "transaction_grains": f"""
        SELECT grain, value_date, currency, bucket_start_ts, counterparty_id,
               {_money("net_cashflow", "inflow", "outflow")}, tx_count, {_money("cp_gross_flow")}, cp_out_count
        FROM (SELECT CASE WHEN grouping(bucket_start_ts) = 0 THEN 'bucket'
                          ELSE 'counterparty' END AS grain,
                     value_date, currency, bucket_start_ts, counterparty_id, sum(signed_amount) AS net_cashflow,
                     sum(CASE WHEN direction = 'IN' THEN amount ELSE 0 END) AS inflow,
                     sum(CASE WHEN direction = 'OUT' THEN amount ELSE 0 END) AS outflow, count(*) AS tx_count,
                     sum(abs(signed_amount)) AS cp_gross_flow, count(*) FILTER (direction = 'OUT') AS cp_out_count
              FROM txb
              GROUP BY GROUPING SETS ((value_date, currency, bucket_start_ts), (value_date, currency, counterparty_id)))""",
    "dq_nulls": _nulls(_DQ_NULLED, ["tx_id", "counterparty_id", "channel"], "tx_some_nulls")
    + " UNION ALL "
    + _nulls(_DQ_NULLED, ["tx_id", "amount"], "tx_no_nulls"),
    "dq_duplicates": _duplicates("cf", "cf_id", "cf_pk_unique")
    + " UNION ALL "
    + _duplicates("col", "collateral_id", "col_pk_unique"),
    "dq_rowcount": _rowcount("tx", 1, 10_000_000, "tx_volume_sanity")
    + " UNION ALL "
    + _rowcount("tx", 1, 10, "tx_volume_tiny"),
    "dq_rowcount_footers": _rowcount("events", 1, 10, "events_volume_tiny")
    + " UNION ALL "
    + _rowcount("events", 1, 10_000_000, "events_volume_sanity")
    + " UNION ALL "
    + _nulls("events", ["event_id", "value"], "events_no_nulls"),
    "dq_files": """
        SELECT 'tx_files_complete' AS check_name, CAST(count(*) = 0 AS VARCHAR) AS passed,
               CASE WHEN count(*) = 0 THEN 'ok' ELSE 'files_without={''amount'': 1}' END AS details
        FROM tx WHERE CAST(tx_id AS BIGINT) % 2 = 1
        UNION ALL SELECT 'tx_files_named', 'true', 'ok'""",
    "dq_suite": " UNION ALL ".join(_DQ_SUITE),
    "balance_carried": """
        SELECT value_date, account_id, currency, round(last_value(balance IGNORE NULLS) OVER (
            PARTITION BY account_id, currency ORDER BY value_date ROWS UNBOUNDED PRECEDING), 2) + 0.0 AS balance
        FROM (SELECT account_id, c.currency, first + CAST(i AS INTEGER) AS value_date
              FROM (SELECT DISTINCT account_id FROM bal), (VALUES ('THB'), ('USD')) AS c(currency),
                   (SELECT first, unnest(range(last - first + 1)) AS i
                    FROM (SELECT min(as_of_date) AS first, max(as_of_date) AS last FROM bal)))
        LEFT JOIN (SELECT as_of_date AS value_date, account_id, currency, balance FROM bal)
        USING (value_date, account_id, currency)""",
    "calendar_spine": """
        SELECT value_date, account_id, currency, balance
        FROM (SELECT account_id, c.currency, first + CAST(i AS INTEGER) AS value_date
              FROM (SELECT DISTINCT account_id FROM bal), (VALUES ('THB'), ('USD')) AS c(currency),
                   (SELECT first, unnest(range(last - first + 1)) AS i
                    FROM (SELECT min(as_of_date) AS first, max(as_of_date) AS last FROM bal)))
        LEFT JOIN (SELECT as_of_date AS value_date, account_id, currency, balance FROM bal)
        USING (value_date, account_id, currency)""",
    "padded_keys": f"SELECT o_orderkey, {_pad('K', 'o_orderkey', 3)} AS padded_key FROM orders",
    "partitioned_roundtrip": """
        SELECT value_date, currency, bucket_start_ts,
               round(CASE WHEN value_date = DATE '2024-01-15' THEN 2 ELSE 1 END * net.inflow, 2) + 0.0 AS inflow,
               round(outflow, 2) + 0.0 AS outflow, tx_count
        FROM net""",
    "monitoring_run": f"""
        SELECT 'dq_results' AS output, count(*) AS row_count,
               round(sum(CASE WHEN passed = 'true' THEN 1.0::DOUBLE ELSE 0 END), 2) AS measure_sum
        FROM ({" UNION ALL ".join(_DQ_SUITE)})
        UNION ALL SELECT 'intraday_snapshots', count(*), round(sum(cum_net_cashflow), 2) FROM flagged
        UNION ALL SELECT 'daily_snapshots', count(*), round(sum(eod_cum_net_cashflow), 2) FROM daily
        UNION ALL SELECT 'concentration_top_counterparties', count(*), round(sum(cp_gross_flow), 2)
                  FROM ranked WHERE cp_rank <= {TOP_N}
        UNION ALL SELECT 'maturity_ladder', count(*), round(sum(net_cashflow), 2) FROM ladder
        UNION ALL SELECT 'limit_utilization', count(*), round(sum(cp_outflow), 2) FROM util""",
}


_NO_DATES = {
    "signed_amounts",
    "hour_bucket",
    "fine_buckets",
    "zoned_bucket",
    "dq_nulls",
    "dq_duplicates",
    "dq_rowcount",
    "dq_rowcount_footers",
    "dq_files",
    "dq_suite",
    "padded_keys",
    "hash_assignment",
    "monitoring_run",
}
_OTHER_DATES = {
    "cashflows_table": ["as_of_date", "maturity_date"],
    "balances_table": ["as_of_date"],
    "collateral_table": ["as_of_date"],
    "limits_table": ["as_of_date"],
    "maturity_bucket": ["as_of_date", "maturity_date"],
    "maturity_ladder": ["as_of_date"],
    "maturity_ladder_sorted": ["as_of_date"],
}


def _dates_as_text(name: str, select: str) -> str:
    if name in _NO_DATES:
        return select
    return f"SELECT * REPLACE ({_text(*_OTHER_DATES.get(name, ['value_date']))}) FROM ({select})"


def oracle_sql() -> dict[str, str]:
    common = ",\n".join(f"{name} AS ({body})" for name, body in _COMMON.items())
    return {name: f"WITH {common}\n{_dates_as_text(name, select)}" for name, select in _SELECTS.items()}
