"""DuckDB SQL twins of the registered queries (tables are pre-registered views).

Written from the operator definitions, in the reference's own dataflow where it
has one (row_number first/last, aggregate join-back, MERGE as a full join), so
they check the Spark rewrites rather than repeat them.
"""

from __future__ import annotations

from barlake import queries as q
from barlake import testdata as td

L1, L2, L3 = (f"TIMESTAMP '{v}'" for v in (td.LOAD_1, td.LOAD_2, td.LOAD_3))
D1, D2 = (f"DATE '{v[:10]}'" for v in (td.LOAD_1, td.LOAD_2))

BARS_NULLS = f"""
SELECT CAST(user_id AS VARCHAR) AS ticker, ts AS datetime, CAST(value AS FLOAT) AS open,
       CASE WHEN event_id % {td.NULL_CLOSE_EVERY} = 0 THEN NULL ELSE CAST(value AS FLOAT) END AS close
FROM events"""

VENDOR_COLS = """CAST(user_id AS VARCHAR) AS "Ticker", CAST(ts AS TIMESTAMP) AS "Datetime",
       value AS "Open", value + 1 AS "High", value - 1 AS "Low", {close} AS "Close",
       event_id * 100 AS "Volume",
       CAST(CASE WHEN event_type = 'purchase' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS "Dividends",
       CAST(0.0 AS DOUBLE) AS "Stock Splits" """

SILVER_COLS = """CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS TIMESTAMP) AS datetime,
       CAST(value AS FLOAT) AS open, CAST(value + 1 AS FLOAT) AS high, CAST(value - 1 AS FLOAT) AS low,
       CAST({close} AS FLOAT) AS close, CAST(event_id * 100 AS FLOAT) AS volume,
       CAST(CASE WHEN event_type = 'purchase' THEN 0.5 ELSE 0.0 END AS FLOAT) AS dividends,
       CAST(0.0 AS FLOAT) AS stock_splits"""

CORRECTED_CLOSE = f"CASE WHEN event_type = '{td.CORRECTED_TYPE}' THEN value + {td.CORRECTION} ELSE value END"


def _metrics(bars: str, tie_break: bool = False) -> str:
    """Reference dataflow: first/last by row_number joined, mean joined back, SSE."""
    where = "WHERE ticker IS NOT NULL AND datetime IS NOT NULL"
    first_tie = ", open ASC NULLS FIRST" if tie_break else ""
    last_tie = ", close DESC NULLS LAST" if tie_break else ""
    return f"""
WITH d AS (SELECT *, CAST(datetime AS DATE) AS date FROM ({bars}) b {where}),
ranked AS (
  SELECT ticker, date, open, close,
         row_number() OVER (PARTITION BY ticker, date ORDER BY datetime ASC NULLS FIRST{first_tie}) AS rn_first,
         row_number() OVER (PARTITION BY ticker, date ORDER BY datetime DESC NULLS LAST{last_tie}) AS rn_last
  FROM d),
f AS (SELECT ticker, date, open AS first_open FROM ranked WHERE rn_first = 1),
l AS (SELECT ticker, date, close AS last_close FROM ranked WHERE rn_last = 1),
r AS (SELECT l.ticker, l.date,
             CAST(l.last_close - f.first_open AS DOUBLE) / NULLIF(CAST(f.first_open AS DOUBLE), 0) AS daily_returns
      FROM l JOIN f ON l.ticker = f.ticker AND l.date = f.date),
m AS (SELECT ticker, date, avg(close) AS avg_close FROM d GROUP BY ticker, date),
v AS (SELECT d.ticker, d.date, sum(power(d.close - m.avg_close, 2)) AS sse, count(d.ticker) AS n
      FROM d LEFT JOIN m ON d.ticker = m.ticker AND d.date = m.date GROUP BY d.ticker, d.date),
vol AS (SELECT ticker, date, sqrt(sse / NULLIF(n, 0)) AS daily_volatility FROM v)
SELECT r.ticker, r.date, r.daily_returns, vol.daily_volatility
FROM r LEFT JOIN vol ON r.ticker = vol.ticker AND r.date = vol.date"""


def _rounded_metrics(bars: str, tie_break: bool = False) -> str:
    return f"""SELECT ticker, date, round(daily_returns, 6) AS daily_returns,
       round(daily_volatility, 6) AS daily_volatility FROM ({_metrics(bars, tie_break)}) x"""


def _silver_bars(close: str) -> str:
    return f"SELECT ticker, datetime, open, close FROM (SELECT {SILVER_COLS.format(close=close)} FROM events) s"


def _profile_doc(renamed: bool) -> str:
    def quoted(x: str) -> str:
        return f"coalesce(CAST(to_json({x}) AS VARCHAR), 'null')"

    name = "upper(c_name)" if renamed else "c_name"
    name = f"CASE WHEN c_mktsegment = '{td.UPDATED_SEGMENT}' THEN {name} ELSE c_name END"
    cap = "CASE WHEN c_mktsegment = 'MACHINERY' THEN '\"n/a\"' ELSE CAST(c_custkey * 1000003 AS VARCHAR) END"
    industry = (
        "CASE WHEN c_mktsegment = 'BUILDING' THEN '\"   \"' WHEN c_mktsegment = 'HOUSEHOLD' THEN '42' "
        f"ELSE {quoted('c_mktsegment')} END"
    )
    summary = "'  ' || c_mktsegment || ' segment customer '"
    return (
        f"""'{{"longName":' || {quoted(name)} || ',"longBusinessSummary":' || {quoted(summary)}"""
        f""" || ',"currency":' || {quoted('n_name')} || ',"marketCap":' || {cap}"""
        f""" || ',"industry":' || {industry} || '}}'"""
    )


PROFILE_FROM = "customer LEFT JOIN nation ON c_nationkey = n_nationkey"


def _profile(stamp_of_updated: str, stamp_of_rest: str) -> str:
    seg = td.UPDATED_SEGMENT
    return f"""
SELECT CAST(c_custkey AS VARCHAR) AS ticker,
       CASE WHEN c_mktsegment = '{seg}' THEN upper(c_name) ELSE c_name END AS company_name,
       c_mktsegment || ' segment customer' AS business_summary,
       n_name AS currency,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(c_custkey * 1000003 AS FLOAT) END AS market_cap,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN '42'
            ELSE c_mktsegment END AS industry,
       CASE WHEN c_mktsegment = '{seg}' THEN {stamp_of_updated} ELSE {stamp_of_rest} END AS load_dttm
FROM {PROFILE_FROM}"""


def _event_days(order: str) -> str:
    return f"""SELECT event_id, user_id, ts, value, CAST(ts AS DATE) AS day,
       row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts {order}) AS rn FROM events"""


def _latest(where: str = "") -> str:
    return f"""SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST) AS rn FROM events) x
WHERE rn = 1 {where}"""


def _upsert_side(date_pred: str, factor: str, stamp_value: str) -> str:
    return f"""SELECT ticker, date, daily_returns{factor} AS daily_returns,
       daily_volatility{factor} AS daily_volatility, {stamp_value} AS load_dttm
FROM ({_metrics(BARS_NULLS)}) m WHERE {date_pred}"""


def _gold_rows(bars: str, date_pred: str, stamp_value: str) -> str:
    return f"""SELECT ticker, date,
       round(CAST(CAST(daily_returns AS FLOAT) AS DOUBLE), 6) AS daily_returns,
       round(CAST(CAST(daily_volatility AS FLOAT) AS DOUBLE), 6) AS daily_volatility,
       {stamp_value} AS load_dttm
FROM ({_metrics(bars)}) m WHERE {date_pred}"""


ORACLES: dict[str, str] = {
    "daily_metrics": _rounded_metrics(BARS_NULLS),
    "scan_cast_bars": f"SELECT {SILVER_COLS.format(close='value')} FROM events",
    "filter_between": f"""SELECT CAST(user_id AS VARCHAR) AS ticker, ts AS datetime, CAST(value AS FLOAT) AS open,
       CAST(value AS FLOAT) AS close FROM events
WHERE ts BETWEEN TIMESTAMP '{q.RANGE_LO}' AND TIMESTAMP '{q.RANGE_HI}'""",
    "cleanse_string": """SELECT event_id, raw, NULLIF(TRIM(raw), '') AS cleansed FROM (
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 7 = 0 THEN '  ' || event_type || ' '
                        WHEN event_id % 5 = 0 THEN '   ' ELSE event_type END AS raw FROM events) x""",
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "audit_stamp": f"SELECT event_id, user_id, {L1} AS load_dttm, {D1} AS load_prdt FROM events",
    "row_number_asc": f"""SELECT event_id, user_id, day, CAST(rn AS INTEGER) AS row_number
FROM ({_event_days('ASC NULLS FIRST')}) x""",
    "row_number_desc": f"""SELECT event_id, user_id, day, CAST(rn AS INTEGER) AS row_number
FROM ({_event_days('DESC NULLS LAST')}) x""",
    "first_record_per_day": f"""SELECT event_id, user_id, ts, value, day
FROM ({_event_days('ASC NULLS FIRST')}) x WHERE rn = 1""",
    "last_record_per_day": f"""SELECT event_id, user_id, ts, value, day
FROM ({_event_days('DESC NULLS LAST')}) x WHERE rn = 1""",
    "latest_record": _latest(),
    "latest_in_range": _latest(f"AND ts BETWEEN TIMESTAMP '{q.LATEST_LO}' AND TIMESTAMP '{q.LATEST_HI}'"),
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem",
    "daily_avg_close": f"""SELECT ticker, CAST(datetime AS DATE) AS date, round(avg(close), 6) AS avg_close
FROM ({BARS_NULLS}) b GROUP BY ticker, CAST(datetime AS DATE)""",
    "daily_sse": f"""WITH d AS (SELECT *, CAST(datetime AS DATE) AS date FROM ({BARS_NULLS}) b),
m AS (SELECT ticker, date, avg(close) AS avg_close FROM d GROUP BY ticker, date)
SELECT d.ticker, d.date, round(sum(power(d.close - m.avg_close, 2)), 6) AS sum_squared_errors, count(d.ticker) AS n
FROM d LEFT JOIN m ON d.ticker = m.ticker AND d.date = m.date GROUP BY d.ticker, d.date""",
    "daily_returns": f"SELECT ticker, date, round(daily_returns, 6) AS daily_returns FROM ({_metrics(BARS_NULLS)}) x",
    "daily_volatility": f"""WITH d AS (SELECT *, CAST(datetime AS DATE) AS date FROM ({BARS_NULLS}) b),
m AS (SELECT ticker, date, avg(close) AS avg_close FROM d GROUP BY ticker, date),
v AS (SELECT d.ticker, d.date, sum(power(d.close - m.avg_close, 2)) AS sse, count(d.ticker) AS n
      FROM d LEFT JOIN m ON d.ticker = m.ticker AND d.date = m.date GROUP BY d.ticker, d.date)
SELECT ticker, date, round(sqrt(sse / NULLIF(n, 0)), 6) AS daily_volatility FROM v""",
    "daily_returns_join": f"SELECT ticker, date, round(daily_returns, 6) AS daily_returns FROM ({_metrics(BARS_NULLS)}) x",
    "daily_metrics_join": _rounded_metrics(BARS_NULLS),
    "daily_metrics_lineitem": _rounded_metrics(
        """SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
       l_shipdate + to_seconds((l_orderkey % 1440) * 60 + l_linenumber) AS datetime,
       CAST(l_extendedprice AS FLOAT) AS open, CAST(l_extendedprice * (1 - l_discount) AS FLOAT) AS close
FROM lineitem""",
        tie_break=True,
    ),
    "monthly_metrics_lineitem": _rounded_metrics(
        """SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
       date_trunc('month', l_shipdate)
         + to_seconds((dayofmonth(l_shipdate) - 1) * 2760 + (l_orderkey % 46) * 60 + l_linenumber) AS datetime,
       CAST(l_extendedprice AS FLOAT) AS open, CAST(l_extendedprice * (1 - l_discount) AS FLOAT) AS close
FROM lineitem""",
        tie_break=True,
    ),
    "sql_over_view": f"""SELECT ticker, CAST(datetime AS DATE) AS date, count(*) AS n_bars, count(close) AS n_closes,
       max(close) AS high_close FROM ({BARS_NULLS}) b GROUP BY ticker, CAST(datetime AS DATE)""",
    "sql_over_tables": f"""
SELECT CAST(user_id AS VARCHAR) AS ticker, {D1} AS load_prdt, count(*) AS n_rows, max(value) AS max_close,
       min(CAST(ts AS TIMESTAMP)) AS first_bar
FROM events GROUP BY user_id
UNION ALL
SELECT CAST(user_id AS VARCHAR) AS ticker, {D2} AS load_prdt, count(*) AS n_rows,
       max(value + {td.CORRECTION}) AS max_close, min(CAST(ts AS TIMESTAMP)) AS first_bar
FROM events WHERE event_type = '{td.CORRECTED_TYPE}' GROUP BY user_id""",
    "upsert_metrics": f"""WITH t AS ({_upsert_side(f"date <= DATE '{q.UPSERT_SPLIT_HI}'", '', L1)}),
s AS ({_upsert_side(f"date >= DATE '{q.UPSERT_SPLIT_LO}'", ' * 2', L2)})
SELECT COALESCE(s.ticker, t.ticker) AS ticker, COALESCE(s.date, t.date) AS date,
       round(CASE WHEN s.ticker IS NOT NULL THEN s.daily_returns ELSE t.daily_returns END, 6) AS daily_returns,
       round(CASE WHEN s.ticker IS NOT NULL THEN s.daily_volatility ELSE t.daily_volatility END, 6) AS daily_volatility,
       CASE WHEN s.ticker IS NOT NULL THEN s.load_dttm ELSE t.load_dttm END AS load_dttm
FROM t FULL JOIN s ON t.ticker = s.ticker AND t.date = s.date""",
    "upsert_null_keys": f"""
WITH k AS (SELECT CASE WHEN event_id % {q.NULL_KEY_EVERY} = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS ticker,
                  ts AS datetime, value AS v FROM events),
t AS (SELECT ticker, datetime, v FROM k WHERE datetime < TIMESTAMP '{q.NULL_KEY_SPLIT_HI}'),
s AS (SELECT ticker, datetime, v * 2 AS v, 1 AS matched_side FROM k WHERE datetime >= TIMESTAMP '{q.NULL_KEY_SPLIT_LO}')
SELECT CASE WHEN s.matched_side IS NOT NULL THEN s.ticker ELSE t.ticker END AS ticker,
       CASE WHEN s.matched_side IS NOT NULL THEN s.datetime ELSE t.datetime END AS datetime,
       CASE WHEN s.matched_side IS NOT NULL THEN s.v ELSE t.v END AS v
FROM t FULL JOIN s ON t.ticker = s.ticker AND t.datetime = s.datetime""",
    "append_partitioned": f"""
SELECT event_id, user_id, ts, event_type, value, {L1} AS load_dttm, {D1} AS load_prdt
FROM events WHERE ts < TIMESTAMP '{q.APPEND_SPLIT}'
UNION ALL
SELECT event_id, user_id, ts, event_type, value, {L2} AS load_dttm, {D2} AS load_prdt
FROM events WHERE ts >= TIMESTAMP '{q.APPEND_SPLIT}'""",
    "append_evolved": f"""
SELECT event_id, user_id, ts, value, {L1} AS load_dttm, CAST(NULL AS VARCHAR) AS event_type,
       CAST(NULL AS INTEGER) AS props_len, {D1} AS load_prdt
FROM events WHERE ts < TIMESTAMP '{q.APPEND_SPLIT}'
UNION ALL
SELECT event_id, user_id, ts, CAST(NULL AS DOUBLE) AS value, {L2} AS load_dttm, event_type,
       CAST(length(event_type) AS INTEGER) AS props_len, {D2} AS load_prdt
FROM events WHERE ts >= TIMESTAMP '{q.APPEND_SPLIT}'""",
    "append_widened": f"""
SELECT event_id AS "Event_Id", user_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, {L1} AS load_dttm, {D1} AS load_prdt
FROM events WHERE ts < TIMESTAMP '{q.APPEND_SPLIT}'
UNION ALL
SELECT event_id + 3000000000 AS "Event_Id", user_id, value, {L2} AS load_dttm, {D2} AS load_prdt
FROM events WHERE ts >= TIMESTAMP '{q.APPEND_SPLIT}'""",
    "bars_conform": f"SELECT {SILVER_COLS.format(close=CORRECTED_CLOSE)}, {L3} AS load_dttm FROM events",
    "profile_conform": _profile(L3, L3),
    "bronze_bars": f"""
SELECT {VENDOR_COLS.format(close='value')}, {L1} AS load_dttm, {D1} AS load_prdt FROM events
UNION ALL
SELECT {VENDOR_COLS.format(close=f'value + {td.CORRECTION}')}, {L2} AS load_dttm, {D2} AS load_prdt
FROM events WHERE event_type = '{td.CORRECTED_TYPE}'""",
    "bronze_bars_stream": f"""
SELECT {VENDOR_COLS.format(close='value')}, {L1} AS load_dttm, {D1} AS load_prdt FROM events""",
    "bronze_bars_selected": f"""
SELECT {VENDOR_COLS.format(close='value')}, {L1} AS load_dttm, {D1} AS load_prdt FROM events
WHERE user_id IN ({', '.join(q.SELECTED_TICKERS)}) AND ts >= TIMESTAMP '2024-01-01 06:30:00'""",
    "bronze_info": f"""
SELECT ' ' || CAST(c_custkey AS VARCHAR) || ' ' AS ticker, {_profile_doc(False)} AS info,
       {L1} AS load_dttm, {D1} AS load_prdt FROM {PROFILE_FROM}
UNION ALL
SELECT ' ' || CAST(c_custkey AS VARCHAR) || ' ' AS ticker, {_profile_doc(True)} AS info,
       {L2} AS load_dttm, {D2} AS load_prdt FROM {PROFILE_FROM} WHERE c_mktsegment = '{td.UPDATED_SEGMENT}'""",
    "silver_bars_job": f"""SELECT {SILVER_COLS.format(close=CORRECTED_CLOSE)},
       CASE WHEN event_type = '{td.CORRECTED_TYPE}' THEN {L3} ELSE {L1} END AS load_dttm FROM events""",
    "silver_profile_job": _profile(L3, L1),
    "gold_metrics_job": f"""
{_gold_rows(_silver_bars('value'), "date <= DATE '2024-01-14'", L1)}
UNION ALL
{_gold_rows(_silver_bars(CORRECTED_CLOSE), "date >= DATE '2024-01-15'", L3)}""",
}
