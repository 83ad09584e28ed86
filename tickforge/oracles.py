"""DuckDB SQL oracles, one per registered query (same column names).

The fixtures of ``tickforge.fixtures`` are rebuilt here as CTEs so each
oracle reads the same testdata views as its Spark twin.  DuckDB traps kept in
mind: ``x / 0.0`` is ``inf`` (write ``x / nullif(y, 0)``), ``hour()`` is
BIGINT, ``date_trunc`` on a DATE gives a TIMESTAMP, ``sum(int)`` is HUGEINT.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixtures

PAIR_EVENTS = """pe AS (
  SELECT upper(event_type) AS fsym,
         CASE user_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'BTC' ELSE 'ETH' END AS tsym,
         ts, value, event_id
  FROM events)"""

BUCKET_SQL = "CASE WHEN regexp_matches({c}, '^[0-9]') THEN '_' ELSE substr({c}, 1, 1) END"


def bars_cte(unit: str, name: str = "b") -> str:
    """Numeric bars of a grain (twin of ``fixtures.bars``)."""
    return f"""{name} AS (
  SELECT fsym, tsym, date_trunc('{unit}', ts) AS bar_ts,
         CAST(epoch(date_trunc('{unit}', ts)) AS BIGINT) AS time,
         arg_min(value, ts) AS open,
         floor(max(value)) AS high,
         min(value) AS low,
         floor(arg_max(value, ts)) AS close,
         CAST(count(*) AS DOUBLE) AS volumefrom,
         round(sum(value), 4) AS volumeto
  FROM pe GROUP BY 1, 2, 3)"""


def typed_cte(unit: str, name: str = "t") -> str:
    """Bars as the typed landed form reads back (twin of ``landed_bars`` +
    ``typed_bars``): 'nan' lows and 'None' volumes become NULL."""
    return f"""{bars_cte(unit, name + '_raw')},
{name} AS (
  SELECT fsym, tsym, {BUCKET_SQL.format(c='fsym')} AS fsym_char1, time, bar_ts,
         open, high, CASE WHEN low < 1 THEN NULL ELSE low END AS low, close,
         volumefrom, CASE WHEN volumefrom = 1 THEN NULL ELSE volumeto END AS volumeto
  FROM {name}_raw)"""


def derived_cte(unit: str) -> str:
    """All columns of the derived bars of a grain, as CTE ``dv``."""
    return f"""{PAIR_EVENTS}, {typed_cte(unit)},
w AS (
  SELECT *, lag(close) OVER (PARTITION BY fsym, tsym ORDER BY time) AS close_lag1,
         max(nullif(high, 0)) OVER (PARTITION BY fsym, tsym ORDER BY time) AS all_time_high
  FROM t),
dv AS (
  SELECT bar_ts, time, CAST(bar_ts AS DATE) AS day_date,
         CAST(hour(bar_ts) AS INTEGER) AS hour, CAST(minute(bar_ts) AS INTEGER) AS minute,
         fsym, tsym, open, high, low, close, close_lag1,
         close - close_lag1 AS change,
         (close - close_lag1) / nullif(close_lag1, 0) AS pct_change,
         volumefrom AS volume_fsym, volumeto AS volume_tsym, all_time_high,
         close / nullif(all_time_high, 0) - 1 AS pct_from_ath, fsym_char1
  FROM w)"""


DATE_COLUMN = {"day": "bar_ts AS date", "hour": "day_date AS date", "minute": "day_date AS date"}
OUTPUT = {
    "day": "date, fsym, tsym, open, high, low, close, change, pct_change, volume_fsym, "
    "volume_tsym, all_time_high, pct_from_ath, fsym_char1",
    "hour": "date, hour, fsym, tsym, open, high, low, close, change, pct_change, volume_fsym, "
    "volume_tsym, fsym_char1",
    "minute": "date, hour, minute, fsym, tsym, open, high, low, close, change, pct_change, "
    "volume_fsym, volume_tsym, fsym_char1",
}


def derived_sql(unit: str, columns: str | None = None) -> str:
    """Derived bars of a grain (twin of ``derive_bars``), chosen columns."""
    return f"""WITH {derived_cte(unit)},
o AS (SELECT {DATE_COLUMN[unit]}, * EXCLUDE (bar_ts, day_date) FROM dv)
SELECT {columns or OUTPUT[unit]} FROM o"""


def bars_sql(unit: str, select: str, where: str = "") -> str:
    return f"WITH {PAIR_EVENTS}, {bars_cte(unit)} SELECT {select} FROM b {where}"


# pages of minute bars (twin of fixtures.bar_pages), flattened
PAGES = f"""{PAIR_EVENTS}, {bars_cte('minute', 'mb')},
pg AS (
  SELECT *, CAST(date_diff('day', CAST(bar_ts AS DATE),
                           (SELECT max(CAST(bar_ts AS DATE)) FROM mb)) AS INTEGER) AS page_no
  FROM mb),
pb AS (
  SELECT fsym, tsym, page_no, time, open, high, low, close,
         CASE WHEN page_no = 9 THEN 0.0 ELSE volumefrom END AS volumefrom, volumeto,
         (fsym = 'CLICK' AND page_no = 6) AS failed, bar_ts
  FROM pg),
pp AS (
  SELECT fsym, tsym, page_no, bool_or(failed) AS failed,
         CASE WHEN bool_or(failed) THEN 500 ELSE 200 END AS status,
         bool_and(coalesce(volumefrom = 0, false)) AS zero, min(time) AS time_from,
         count(*) AS n_bars
  FROM pb GROUP BY 1, 2, 3),
fs AS (
  SELECT fsym, tsym, min(page_no) AS stop_page FROM pp WHERE failed OR zero GROUP BY 1, 2),
kept AS (
  SELECT pp.* FROM pp LEFT JOIN fs USING (fsym, tsym)
  WHERE fs.stop_page IS NULL OR pp.page_no < fs.stop_page)"""

# headers of an interrupted back-fill (twin of fixtures.chained_pages + page_headers)
CHAIN = f"""{PAGES},
hd AS (
  SELECT fsym, tsym, page_no, (page_no = 9) AS zero, bool_or(failed) AS failed,
         CASE WHEN bool_or(failed) THEN NULL ELSE count(*) END AS n_bars,
         CASE WHEN bool_or(failed) THEN NULL ELSE min(time) - CASE WHEN page_no % 4 = 1 THEN 90000 ELSE 0 END END AS time_from,
         CASE WHEN bool_or(failed) THEN NULL ELSE max(time) END AS last_time
  FROM pb
  WHERE NOT (fsym = 'VIEW' AND page_no = 4) AND NOT (fsym = 'SIGNUP' AND page_no >= 3)
  GROUP BY 1, 2, 3)"""

PART_SYMBOLS = """ps AS (
  SELECT p_partkey, p_brand, p_size,
         CASE WHEN p_partkey % 7 = 0 THEN CAST(p_size AS VARCHAR) || upper(p_name)
              ELSE upper(p_name) END AS fsym
  FROM part)"""

QUOTES_SQL = "(VALUES ('USD'), ('BTC'), ('ETH')) q(tsym)"

ORDER_INSTANTS = """oi AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
         make_timestamp(epoch_us(o_orderdate) + o_orderkey * 1000000 + (o_orderkey % 4) * 250000) AS instant,
         make_timestamp(epoch_us(o_orderdate) + o_orderkey * 1000000) AS whole,
         o_orderkey % 10 = 0 AS garbage
  FROM orders)"""

EVENT_CHART = "'n-' || lower(event_type)"
CHART_POINTS = f"SELECT {EVENT_CHART} AS chart, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS x, value AS y FROM events"

CHART_KEYS = """ck AS (
  SELECT event_id, 'N_' || upper(event_type) AS key,
         'https://api.example.org/charts/n-' || event_type || CASE WHEN value > 400 THEN '-v2' ELSE '' END AS url
  FROM events)"""

COINS = """SELECT CAST(c_custkey AS VARCHAR) AS Id, c_name AS Symbol, c_mktsegment AS CoinName,
       CAST(c_nationkey AS VARCHAR) AS SortOrder,
       CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS VARCHAR) END AS Balance
FROM customer"""


def holiday_dates(first_year: int, last_year: int) -> list:
    """US federal holidays and observed days, written independently of the
    Spark calendar (plain Python dates) for the oracle."""
    import datetime as dt

    def nth(year, month, weekday, n):  # weekday: Monday = 0
        d = dt.date(year, month, 1)
        d += dt.timedelta(days=(weekday - d.weekday()) % 7)
        return d + dt.timedelta(weeks=n - 1)

    def last(year, month, weekday):
        d = dt.date(year + (month == 12), month % 12 + 1, 1) - dt.timedelta(days=1)
        return d - dt.timedelta(days=(d.weekday() - weekday) % 7)

    out = set()
    for y in range(first_year, last_year + 1):
        fixed = [dt.date(y, 1, 1), dt.date(y, 7, 4), dt.date(y, 12, 25)]
        if y >= 2021:
            fixed.append(dt.date(y, 6, 19))
        if y >= 1978:
            fixed.append(dt.date(y, 11, 11))
        for d in fixed:
            out.add(d)
            if d.weekday() == 5:
                out.add(d - dt.timedelta(days=1))
            if d.weekday() == 6:
                out.add(d + dt.timedelta(days=1))
        if y >= 1986:
            out.add(nth(y, 1, 0, 3))
        out.add(nth(y, 2, 0, 3))
        out.add(last(y, 5, 0))
        out.add(nth(y, 9, 0, 1))
        out.add(nth(y, 10, 0, 2))
        if 1971 <= y <= 1977:
            out.add(nth(y, 10, 0, 4))
        out.add(nth(y, 11, 3, 4))
    return sorted(out)


def _holiday_values() -> str:
    days = holiday_dates(1960, 2040)
    return "(VALUES " + ", ".join(f"(DATE '{d.isoformat()}')" for d in days) + ") h(d)"


def oracle_sql() -> dict[str, str]:
    landing_cutoff = "CAST(epoch(TIMESTAMP '2024-01-29 00:00:00') AS BIGINT)"
    fixture_cutoff = "CAST(epoch(TIMESTAMP '2024-01-19 00:00:00') AS BIGINT)"
    request_ts = "'2024-02-01 06:30:00.250000'"
    typed_day = f"""WITH {PAIR_EVENTS}, {typed_cte('day')}
SELECT CAST(time AS VARCHAR) AS time, open, high, low, close, volumefrom, volumeto, fsym, tsym,
       fsym_char1, strftime(bar_ts, '%Y-%m-%d %H:%M:%S') AS date,
       CAST(year(bar_ts) AS INTEGER) AS year, CAST(month(bar_ts) AS INTEGER) AS month,
       CAST(day(bar_ts) AS INTEGER) AS day, {request_ts} AS request_timestamp
FROM t"""
    scanned_day = typed_day.replace("CAST(time AS VARCHAR) AS time", "time")
    base = "https://min-api.example.com/data"
    tail = "'&e=AGG&extraParams=tickforge_test'"
    manifest = f"""WITH p AS (SELECT fsym, tsym FROM (SELECT DISTINCT p_brand AS fsym FROM part), {QUOTES_SQL})
SELECT fsym, tsym, '{base}/histoday?fsym=' || fsym || '&tsym=' || tsym || '&allData=true' || {tail} AS url,
       'day_all' AS kind FROM p
UNION ALL
SELECT fsym, tsym, '{base}/histohour?fsym=' || fsym || '&tsym=' || tsym || '&limit=2000&toTs='
       || CAST({fixture_cutoff} AS VARCHAR) || {tail}, 'hour_all' FROM p
UNION ALL
SELECT fsym, tsym, '{base}/histominute?fsym=' || fsym || '&tsym=' || tsym || '&limit=1440' || {tail},
       'minute_limit' FROM p"""
    bucket = BUCKET_SQL.format(c="fsym")
    parse_ts = f"""WITH {ORDER_INSTANTS}
SELECT o_orderkey,
       CASE WHEN garbage THEN 'garbage'
            WHEN o_orderkey % 3 = 0 THEN strftime(whole, '%Y-%m-%d %H:%M:%S')
            WHEN o_orderkey % 3 = 1 THEN strftime(whole, '%m/%d/%Y %H:%M:%S')
            ELSE strftime(whole, '%Y%m%d') END AS text_ts,
       CASE WHEN garbage THEN NULL
            WHEN o_orderkey % 3 = 2 THEN CAST(CAST(whole AS DATE) AS TIMESTAMP)
            ELSE whole END AS ts
FROM oi"""
    landing = f"""WITH {PAGES}
SELECT pb.fsym, pb.tsym, {bucket.replace('fsym', 'pb.fsym')} AS fsym_char1,
       CAST(year(bar_ts) AS INTEGER) AS year, CAST(month(bar_ts) AS INTEGER) AS month,
       CAST(day(bar_ts) AS INTEGER) AS day, pb.time, pb.close, pb.volumefrom,
       strftime(bar_ts, '%Y-%m-%d %H:%M:%S') AS date, {request_ts} AS request_timestamp
FROM pb JOIN kept USING (fsym, tsym, page_no)
WHERE pb.time <= {landing_cutoff}"""
    return {
        # derive
        "change_daily": derived_sql("day"),
        "change_hourly": derived_sql("hour"),
        "change_minute": derived_sql("minute"),
        "all_time_high": derived_sql("day", "date, fsym, tsym, high, all_time_high"),
        "change_copies": f"""WITH {PAIR_EVENTS},
e AS (SELECT fsym, tsym, date_trunc('day', ts) AS date, ts, floor(value) AS close FROM pe),
w AS (
  SELECT *, lag(close) OVER (PARTITION BY fsym, tsym ORDER BY date, ts) AS close_lag1,
         max(nullif(close, 0)) OVER (PARTITION BY fsym, tsym ORDER BY date) AS all_time_high
  FROM e)
SELECT fsym, tsym, CAST(date AS TIMESTAMP) AS date, CAST(ts AS TIMESTAMP) AS request_timestamp, close,
       close - close_lag1 AS change, (close - close_lag1) / nullif(close_lag1, 0) AS pct_change, all_time_high FROM w""",
        "change": derived_sql("hour", "fsym, tsym, date, hour, close, close_lag1, change"),
        "pct_change": derived_sql(
            "minute", "fsym, tsym, date, hour, minute, close, close_lag1, pct_change"
        ),
        "pct_from_ath": derived_sql("day", "date, fsym, tsym, close, all_time_high, pct_from_ath"),
        "project_bars": derived_sql("minute"),
        "typed_bars": typed_day,
        "replace_column": f"""WITH {PAIR_EVENTS}, {bars_cte('hour')}
SELECT fsym, tsym, CAST(time AS VARCHAR) AS time, make_timestamp(time * 1000000) AS date,
       TIMESTAMP '2024-02-01 06:30:00.25' AS request_timestamp FROM b""",
        "rename_volumes": f"""WITH {PAIR_EVENTS}, {typed_cte('day')}
SELECT fsym, tsym, CAST(time AS VARCHAR) AS time, volumefrom AS volume_fsym, volumeto AS volume_tsym FROM t""",
        "null_if_zero": bars_sql("hour", "fsym, tsym, time, high, nullif(high, 0) AS high_nz"),
        # landing
        "cutoff_filter": bars_sql("hour", "fsym, tsym, time, close", f"WHERE time <= {fixture_cutoff}"),
        "last_utc_close": bars_sql(
            "hour",
            "fsym, tsym, time, CAST(epoch(date_trunc('day', bar_ts) - INTERVAL 1 DAY) AS BIGINT) AS cutoff",
        ),
        "recent_bars": f"""WITH {PAIR_EVENTS}, {bars_cte('hour')},
r AS (SELECT fsym, tsym, time, close,
             CAST(row_number() OVER (PARTITION BY fsym, tsym ORDER BY time DESC) AS INTEGER) AS recent_rank
      FROM b)
SELECT * FROM r WHERE recent_rank <= 24""",
        "sort_landing": bars_sql("minute", "fsym, tsym, time, close"),
        "stamp_columns": f"""WITH {PAGES}
SELECT fsym, tsym, time, {bucket} AS fsym_char1, bar_ts AS date,
       CAST(year(bar_ts) AS INTEGER) AS year, CAST(month(bar_ts) AS INTEGER) AS month,
       CAST(day(bar_ts) AS INTEGER) AS day, {request_ts} AS request_timestamp
FROM pb WHERE NOT failed""",
        "all_to_string": bars_sql(
            "day",
            "fsym, tsym, time, open, high, CASE WHEN low >= 1 THEN low END AS low, close, "
            "volumefrom, volumeto",
        ),
        "concat_pairs": bars_sql(
            "day", "fsym, tsym, time, close, CASE WHEN tsym = 'ETH' THEN NULL ELSE volumeto END AS volumeto"
        ),
        "backfill_cut": f"WITH {PAGES} SELECT fsym, tsym, page_no, status FROM kept",
        "concat_pages": f"""WITH {PAGES}
SELECT pb.fsym, pb.tsym, pb.time, pb.close, pb.volumefrom
FROM pb JOIN kept USING (fsym, tsym, page_no)""",
        "page_all_zero": f"""WITH {PAGES}
SELECT fsym, tsym, page_no, CASE WHEN failed THEN NULL ELSE zero END AS all_zero FROM pp""",
        # sources
        "flatten_bars": f"""WITH {PAGES}
SELECT fsym, tsym, page_no, time, open, high, low, close, volumefrom, volumeto FROM pb WHERE NOT failed""",
        "json_parse": f"""WITH {PAGES}
SELECT fsym, tsym, page_no, CASE WHEN failed THEN NULL ELSE time_from END AS time_from,
       CASE WHEN failed THEN NULL ELSE CAST(n_bars AS INTEGER) END AS n_bars FROM pp""",
        "flatten_coins": COINS,
        "map_values": """SELECT c_name AS symbol, CASE WHEN c_acctbal > 0 THEN 5 ELSE 4 END AS n_fields
FROM customer""",
        "flatten_charts": CHART_POINTS,
        "flatten_bars_rest": f"""WITH {PAGES}
SELECT fsym, tsym, page_no, time, open, high, low, close, volumefrom, volumeto,
       CASE WHEN page_no % 2 = 0 THEN '{{"conversionType":"direct","extra":{{"page":' || CAST(page_no AS VARCHAR) || '}}}}' END AS rest
FROM pb WHERE NOT failed""",
        "flatten_charts_rest": """SELECT 'n-' || lower(event_type) AS chart, CAST(floor(epoch(ts)) AS BIGINT) AS x, value AS y,
       CASE WHEN (event_id // 1024) % 2 = 1 THEN '{"unit":"USD"}' END AS rest FROM events""",
        "scan_coins": f"SELECT *, {request_ts} AS request_timestamp FROM ({COINS})",
        "scan_bars": scanned_day,
        "scan_bars_prefix": scanned_day + " WHERE fsym_char1 = 'C'",
        # sinks and layouts
        "sink_landing": landing,
        "sink_landing_rerun": landing,
        "sink_landing_whole": landing.replace("JOIN kept USING (fsym, tsym, page_no)\nWHERE", "WHERE NOT failed AND"),
        "sink_flat": bars_sql("day", "fsym, tsym, time, open, high, low, close, volumefrom, volumeto"),
        "sink_derived_counts": derived_sql("hour"),
        "sink_derived": derived_sql("hour"),
        "sort_derived": derived_sql("day"),
        "cluster_output": derived_sql("hour"),
        "sink_charts": CHART_POINTS,
        "sink_json_packed": CHART_POINTS + " WHERE event_type <> 'view'",
        "sink_json": CHART_POINTS,
        # symbols and pairs
        "symbol_bucket": f"WITH {PART_SYMBOLS} SELECT p_partkey, fsym, {bucket} AS fsym_char1 FROM ps",
        "distinct_buckets": f"WITH {PART_SYMBOLS} SELECT DISTINCT {bucket} AS fsym_char1 FROM ps",
        "bucket_pairs": f"""WITH {PART_SYMBOLS},
pr AS (SELECT fsym, tsym FROM (SELECT DISTINCT fsym FROM ps), {QUOTES_SQL})
SELECT {bucket} AS fsym_char1, count(*) AS n_pairs, count(DISTINCT fsym) AS n_symbols
FROM pr GROUP BY 1""",
        "pair_product": f"SELECT fsym, tsym FROM (SELECT DISTINCT p_brand AS fsym FROM part), {QUOTES_SQL}",
        "work_units": f"""WITH {PART_SYMBOLS},
d AS (SELECT DISTINCT fsym FROM ps),
p AS (SELECT {bucket} AS fsym_char1, fsym, tsym FROM d, {QUOTES_SQL}),
n AS (SELECT *, row_number() OVER (PARTITION BY fsym_char1 ORDER BY fsym, tsym) AS row FROM p)
SELECT fsym_char1, CAST((row - 1) // 100 + 1 AS BIGINT) AS unit, fsym, tsym FROM n""",
        "chart_requests": """SELECT DISTINCT 'n-' || lower(event_type) AS chart,
       'https://api.example.org/charts/n-' || lower(event_type) || '?timespan=all&format=json' AS request_url FROM events""",
        "page_links": f"""WITH {CHAIN},
m AS (
  SELECT h.fsym, h.tsym, h.page_no, h.last_time, b.time_from AS expected_to, h.last_time - b.time_from AS ahead,
         CASE WHEN h.failed THEN 'failed' WHEN h.page_no = 0 THEN 'first' WHEN b.page_no IS NULL THEN 'missing_page'
              WHEN b.failed THEN 'failed' WHEN h.last_time > b.time_from THEN 'overlap'
              WHEN h.last_time < b.time_from - 60 THEN 'gap' ELSE 'joined' END AS link
  FROM hd h LEFT JOIN hd b ON h.fsym = b.fsym AND h.tsym = b.tsym AND h.page_no = b.page_no + 1)
SELECT fsym, tsym, page_no, link, expected_to, last_time,
       CAST(CASE WHEN link IN ('joined', 'overlap', 'gap') THEN CASE WHEN ahead >= 0 THEN ahead // 60 + 1 ELSE 0 END END AS BIGINT) AS shared_bars,
       CAST(CASE WHEN link IN ('joined', 'overlap', 'gap') THEN CASE WHEN ahead < -60 THEN (-ahead) // 60 - 1 ELSE 0 END END AS BIGINT) AS missing_bars
FROM m""",
        "next_requests": f"""WITH {CHAIN},
r AS (SELECT *, row_number() OVER (PARTITION BY fsym, tsym ORDER BY page_no) - 1 AS place FROM hd),
c AS (
  SELECT fsym, tsym, count(*) FILTER (place = page_no) AS missing, min(page_no) FILTER (failed OR zero) AS stop_page FROM r GROUP BY 1, 2),
f AS (SELECT fsym, tsym, CAST(least(missing, coalesce(stop_page, missing)) AS INTEGER) AS next_page, stop_page FROM c),
s AS (
  SELECT f.fsym, f.tsym, f.next_page, l.time_from AS to_ts,
         CASE WHEN f.stop_page IS NULL OR f.stop_page <> f.next_page THEN 'open' WHEN n.failed THEN 'failed' ELSE 'done' END AS state
  FROM f LEFT JOIN hd l ON f.fsym = l.fsym AND f.tsym = l.tsym AND l.page_no = f.next_page - 1
         LEFT JOIN hd n ON f.fsym = n.fsym AND f.tsym = n.tsym AND n.page_no = f.next_page),
a AS (
  SELECT fsym, tsym, state, next_page, coalesce(to_ts, {fixture_cutoff}) AS to_ts FROM s WHERE state <> 'done'
  UNION ALL
  SELECT fsym, tsym, 'new', 0, {fixture_cutoff} FROM (SELECT DISTINCT p_brand AS fsym FROM part), {QUOTES_SQL})
SELECT fsym, tsym, state, CAST(next_page AS INTEGER) AS next_page, CAST(to_ts AS BIGINT) AS to_ts,
       '{base}/histominute?fsym=' || fsym || '&tsym=' || tsym || '&limit=2000&toTs=' || CAST(to_ts AS VARCHAR) || {tail} AS url
FROM a""",
        "request_manifest": manifest,
        "chart_name": f"""SELECT chart, chart AS name
FROM (SELECT DISTINCT {EVENT_CHART} AS chart, event_id // 1024 AS block FROM events)""",
        "kebab_key": f"WITH {CHART_KEYS} SELECT event_id, key, replace(lower(key), '_', '-') AS kebab FROM ck",
        # date and time
        "quarter_start": f"""WITH {ORDER_INSTANTS}
SELECT o_orderkey, order_date, CAST(date_trunc('quarter', order_date) AS DATE) AS quarter_start FROM oi""",
        "day_name": f"WITH {ORDER_INSTANTS} SELECT o_orderkey, order_date, dayname(order_date) AS day_name FROM oi",
        "month_name": f"WITH {ORDER_INSTANTS} SELECT o_orderkey, order_date, monthname(order_date) AS month_name FROM oi",
        "date_parts": f"""WITH {ORDER_INSTANTS}
SELECT o_orderkey, order_date, CAST(year(order_date) AS INTEGER) AS year,
       CAST(month(order_date) AS INTEGER) AS month, CAST(day(order_date) AS INTEGER) AS day FROM oi""",
        "is_holiday_usa": f"""WITH {ORDER_INSTANTS}, h AS (SELECT d FROM {_holiday_values()})
SELECT o_orderkey, order_date, order_date IN (SELECT d FROM h) AS is_holiday_usa FROM oi""",
        "run_id": f"""WITH {ORDER_INSTANTS}
SELECT o_orderkey, strftime(instant, '%Y-%m-%d_%H_%M_%S')
       || CASE WHEN o_orderkey % 4 = 0 THEN ''
               ELSE '_' || lpad(CAST((o_orderkey % 4) * 250000 AS VARCHAR), 6, '0') END AS run_id
FROM oi""",
        "unix_to_ts": f"""WITH {ORDER_INSTANTS}
SELECT o_orderkey,
       CASE WHEN garbage THEN 'garbage'
            WHEN o_orderkey % 2 = 0 THEN CAST(epoch_us(whole) // 1000000 AS VARCHAR) || '.0'
            ELSE CAST(epoch_us(whole) // 1000000 AS VARCHAR) END AS text_unix,
       CASE WHEN garbage THEN NULL ELSE whole END AS ts
FROM oi""",
        "parse_timestamp": parse_ts,
        "parse_date": parse_ts.replace(
            "CASE WHEN garbage THEN NULL\n            WHEN o_orderkey % 3 = 2 THEN CAST(CAST(whole AS DATE) AS TIMESTAMP)\n            ELSE whole END AS ts",
            "CASE WHEN garbage THEN NULL ELSE CAST(whole AS DATE) END AS d",
        ),
        "hour_of": "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events",
        "minute_of": "SELECT event_id, CAST(minute(ts) AS INTEGER) AS minute FROM events",
        "date_of": "SELECT event_id, CAST(ts AS DATE) AS date FROM events",
        # quality
        "check_request": f"""WITH {PART_SYMBOLS}
SELECT p_partkey, CASE WHEN p_size = 50 THEN '  ' END AS fsym FROM ps WHERE p_size IN (49, 50)""",
        "check_one_bucket": f"""WITH {PART_SYMBOLS}
SELECT p_brand, count(DISTINCT {bucket}) AS n_buckets FROM ps GROUP BY 1 HAVING count(DISTINCT {bucket}) > 1""",
        "check_chart_keys": f"""WITH {CHART_KEYS},
c AS (SELECT event_id, replace(lower(key), '_', '-') AS key_name,
             regexp_replace(url, '.*charts/', '') AS url_name FROM ck)
SELECT * FROM c WHERE key_name IS DISTINCT FROM url_name""",
        "check_status": f"WITH {PAGES} SELECT fsym, tsym, page_no, status FROM pp WHERE status <> 200",
    }
