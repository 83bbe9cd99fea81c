"""Independent SQL for each registered query, for another engine on the same files."""

from __future__ import annotations

from marketlake.plans.queries import (
    BASE,
    CELL_KEY_DAY,
    COUNT_DAY,
    COVERAGE_DAY,
    FALLBACK_DAY,
    PAIRS,
    QUOTE,
    SCAN_ROWS,
    TOPK_MONTH,
    TOPK_ROWS,
    TOPK_YEAR,
)

# --- shared common table expressions -------------------------------------------

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTE[name] = (needs, body)


def _with(*names: str) -> str:
    """``WITH`` clause of the named expressions and all they need, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in CTE[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in ordered) + "\n"


_cte(
    "ticks", (),
    """SELECT event_type AS symbol, value AS price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
       event_id AS trade_id, ts AS event_ts FROM events""",
)


def _bars(source: str, unit: str, bucket: str) -> str:
    return f"""SELECT symbol, date_trunc('{unit}', event_ts) AS {bucket},
       min(event_ts) AS ts_min, max(event_ts) AS ts_max,
       first(price ORDER BY event_ts, trade_id) AS price_open,
       last(price ORDER BY event_ts, trade_id) AS price_close,
       max(price) AS price_high, min(price) AS price_low,
       round(avg(price), 9) + 0.0 AS price_avg,
       quantile_disc(price, 0.95) AS price_p95,
       round(sum(quantity), 6) + 0.0 AS volume_base,
       round(sum(quantity * price), 4) + 0.0 AS volume_quote,
       CAST(count(*) AS BIGINT) AS trade_count
       FROM {source} GROUP BY 1, 2"""


_cte(
    "bars", ("ticks",),
    f"""SELECT *, CAST(hour_start_ts AS DATE) AS date,
       CAST(hour(hour_start_ts) AS INTEGER) AS hour
       FROM ({_bars('ticks', 'hour', 'hour_start_ts')})""",
)
_cte(
    "closes", ("ticks",),
    """SELECT symbol, CAST(event_ts AS DATE) AS date,
       last(price ORDER BY event_ts, trade_id) AS close, max(event_ts) AS ts_max
       FROM ticks GROUP BY 1, 2""",
)
_cte(
    "daily", ("closes",),
    """SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1
       AS ret_1d FROM closes""",
)
_cte(
    "volume", ("ticks",),
    """SELECT symbol, CAST(event_ts AS DATE) AS date, sum(quantity) AS volume_sum,
       sum(quantity * price) AS volume_quote_sum,
       CAST(count(*) AS BIGINT) AS trade_count_sum FROM ticks GROUP BY 1, 2""",
)
_cte(
    "loads", (),
    """SELECT CAST(o_orderdate AS DATE) AS fx_date, o_orderpriority AS code,
       o_orderstatus AS currency, o_totalprice AS mid, o_orderkey AS load_no FROM orders""",
)
_cte(
    "rates", ("loads",),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
       (PARTITION BY fx_date, code ORDER BY load_no DESC) AS rn FROM loads) WHERE rn = 1""",
)
_cte(
    "rate_returns", ("rates",),
    """SELECT fx_date, code, mid,
       mid / nullif(lag(mid) OVER (PARTITION BY code ORDER BY fx_date), 0) - 1 AS ret_1d,
       CAST(year(fx_date) AS INTEGER) AS year, CAST(month(fx_date) AS INTEGER) AS month
       FROM rates""",
)
_cte(
    "shipped", (),
    """SELECT symbol, date, close,
       close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS ret_1d
       FROM (SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS date,
             round(sum(l_extendedprice), 2) AS close FROM lineitem GROUP BY 1, 2)""",
)
_cte("pairs", (), "VALUES " + ", ".join(f"('{b}', '{q}')" for b, q in PAIRS))
_cte(
    "joined", ("shipped", "rate_returns", "pairs"),
    """SELECT p.col0 AS base, p.col1 AS quote, s.date, s.ret_1d AS x, r.ret_1d AS y
       FROM pairs p JOIN shipped s ON s.symbol = p.col0
       JOIN rate_returns r ON r.code = p.col1 AND r.fx_date = s.date""",
)

_FRAME = "(PARTITION BY base, quote ORDER BY date ROWS BETWEEN 62 PRECEDING AND CURRENT ROW)"
_cte(
    "sums", ("joined",),
    f"""SELECT base, quote, date, count(*) OVER w AS n, sum(x) OVER w AS sum_x,
       sum(y) OVER w AS sum_y, sum(x * x) OVER w AS sum_x2, sum(y * y) OVER w AS sum_y2,
       sum(x * y) OVER w AS sum_xy FROM joined WINDOW w AS {_FRAME}""",
)


def _pair_corr(source: str, window: str, keep: str, out: str) -> str:
    both = "CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN {0} END"
    px, py = both.format("x"), both.format("y")
    return f"""SELECT {keep}, CASE WHEN count({px}) OVER w >= 2 THEN
       covar_pop({py}, {px}) OVER w
       / nullif(stddev_pop({px}) OVER w * stddev_pop({py}) OVER w, 0) END AS {out}
       FROM {source} WINDOW w AS {window}"""


_cte(
    "own_pair", ("daily",),
    f"""SELECT a.date, a.ret_1d AS x, b.ret_1d AS y FROM daily a JOIN daily b USING (date)
       WHERE a.symbol = '{BASE}' AND b.symbol = '{QUOTE}'""",
)
_cte(
    "corr", ("own_pair",),
    _pair_corr(
        "own_pair", "(ORDER BY date ROWS BETWEEN 62 PRECEDING AND CURRENT ROW)",
        "date", "corr_btc_usdpln_63d",
    ),
)
_cte(
    "monthly", ("daily",),
    """SELECT symbol, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       avg(ret_1d) AS avg_ret_1d, stddev_pop(ret_1d) AS vol_ret,
       CAST(count(ret_1d) AS BIGINT) AS days_ret, arg_max(close, date) AS last_close
       FROM daily GROUP BY 1, 2, 3""",
)
_cte(
    "facts", ("daily", "volume", "corr"),
    """SELECT symbol, date, close, ret_1d, volume_sum, volume_quote_sum, trade_count_sum,
       corr_btc_usdpln_63d FROM daily LEFT JOIN volume USING (symbol, date)
       LEFT JOIN corr USING (date)""",
)


# --- the row key's hash, 32-bit Murmur3 in plain integer arithmetic --------------

_M = "4294967295::HUGEINT"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) * {1 << r}::HUGEINT & {_M}) | (({x}) // {1 << (32 - r)}::HUGEINT))"


def _mix_k(k: str) -> str:
    return f"({_rotl(f'(({k}) * 3432918353::HUGEINT & {_M})', 15)} * 461845907::HUGEINT & {_M})"


def _mix_h(h: str, k: str) -> str:
    return f"({_rotl(f'xor({h}, {k})', 13)} * 5::HUGEINT + 3864292196::HUGEINT & {_M})"


def _murmur(text: str, seed: str) -> str:
    """Hash of ASCII ``text``: whole 4-byte little-endian words, then single bytes."""

    def byte(i: str) -> str:
        return f"ascii(substr({text}, CAST({i} AS INTEGER), 1))::HUGEINT"

    whole = f"(length({text}) // 4)"
    words = (
        f"list_transform(range({whole}), lambda i: {byte('i * 4 + 1')} + {byte('i * 4 + 2')} * 256"
        f" + {byte('i * 4 + 3')} * 65536 + {byte('i * 4 + 4')} * 16777216)"
    )
    rest = f"list_transform(range({whole} * 4, length({text})), lambda i: {byte('i + 1')})"
    body = (
        f"list_reduce(list_concat({words}, {rest}), "
        f"lambda h, k: {_mix_h('h', _mix_k('k'))}, {seed})"
    )
    return f"xor({body}, length({text})::HUGEINT)"


# The final mix is done in steps, so that no expression is repeated.
def _final(source: str, column: str, steps: str) -> str:
    return (
        f"SELECT *, xor(c2, c2 // 65536::HUGEINT) AS {column} FROM ("
        f"SELECT *, xor(c1, c1 // 8192::HUGEINT) * 3266489909::HUGEINT & {_M} AS c2 FROM ("
        f"SELECT *, xor(c0, c0 // 65536::HUGEINT) * 2246822507::HUGEINT & {_M} AS c1 FROM ("
        f"SELECT *, {steps} AS c0 FROM {source})))"
    )


_cte(
    "stamped", ("closes",),
    "SELECT symbol, date, strftime(date, '%Y%m%d') AS stamp FROM closes",
)
_cte("hashed1", ("stamped",), _final("stamped", "h1", _murmur("symbol", "42::HUGEINT")))
_cte(
    "hashed2", ("hashed1",),
    _final("(SELECT symbol, date, stamp, h1 FROM hashed1)", "h2", _murmur("stamp", "h1")),
)
_cte(
    "keys", ("hashed2",),
    """SELECT symbol, date, CAST(abs((CASE WHEN h2 >= 2147483648::HUGEINT
       THEN h2 - 4294967296::HUGEINT ELSE h2 END) % 10) AS VARCHAR) || '|' || symbol || '|'
       || stamp AS rowkey FROM hashed2""",
)
_cte(
    "cells", ("facts", "keys"),
    f"""SELECT rowkey, date, family, qualifier, value FROM (
       SELECT k.rowkey, f.date, f.symbol,
       unnest(['metrics', 'price', 'volume', 'volume', 'correlation']) AS family,
       unnest(['ret_1d', 'avg', 'sum', 'count', 'btc_usdpln_63d']) AS qualifier,
       unnest([ret_1d, close, volume_sum, CAST(trade_count_sum AS DOUBLE),
               CASE WHEN f.symbol = '{BASE}' THEN corr_btc_usdpln_63d END]) AS value
       FROM facts f JOIN keys k ON k.symbol = f.symbol AND k.date = f.date)
       WHERE value IS NOT NULL""",
)
_CELL = "rowkey, date, family, qualifier, round(value, 4) + 0.0 AS value"

# --- raw text with the same faults as in the inputs --------------------------------

_K = "json_extract_string(props, '$.k')"
_cte(
    "raw_valid", (),
    f"""SELECT event_id AS trade_id, event_type AS symbol, value AS price,
       CAST({_K} AS DOUBLE) AS quantity, date_trunc('millisecond', ts) AS event_ts, ts
       FROM events
       WHERE value >= 1 AND {_K} <> '0' AND NOT (event_type = 'error' AND value > 100)""",
)
_TICK_REASON = f"""concat_ws(',', CASE WHEN value < 1 THEN 'price' END,
       CASE WHEN {_K} = '0' THEN 'quantity' END,
       CASE WHEN event_type = 'error' AND value > 100 THEN 'event_time' END)"""
_cte(
    "tick_reasons", (),
    f"""SELECT trade_id, reject_reason FROM (SELECT event_id AS trade_id,
       {_TICK_REASON} AS reject_reason FROM events) WHERE reject_reason <> ''""",
)
_cte(
    "trade_reasons", (),
    f"""SELECT event_id, reject_reason FROM (SELECT event_id, CASE WHEN {_K} = '0' THEN 'malformed'
       ELSE concat_ws(',',
         CASE WHEN event_type = 'error' AND value > 100 THEN 'missing_s' END,
         CASE WHEN value < 1 THEN 'type_p' END) END AS reject_reason FROM events)
       WHERE reject_reason <> ''""",
)
_cte("raw_bars", ("raw_valid",), _bars("raw_valid", "hour", "hour_start_ts"))
_RAW_BARS = (
    _with("raw_bars")
    + """SELECT *, CAST(hour_start_ts AS DATE) AS date,
    CAST(hour(hour_start_ts) AS INTEGER) AS hour FROM raw_bars"""
)
_DOCUMENT_RATES = (
    _with("rates")
    + f"""SELECT 'A' AS table_name, strftime(fx_date, '%j/%Y') AS table_no,
    CASE WHEN dayofweek(fx_date) = 0 THEN DATE '{FALLBACK_DAY}' ELSE fx_date END AS fx_date,
    currency, code, mid FROM rates"""
)
_REPORT = _with("rate_returns", "daily", "corr", "monthly") + "\nUNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{check}' AS check_name,
    CAST(count(*) AS BIGINT) AS rows, CAST({violations} AS BIGINT) AS violations,
    {violations} = 0 AS passed FROM {source}"""
    for table, source, listed in (
        ("fx_daily_returns", "{fx}", {"abs_ret_1d_within_limit": "abs(ret_1d) > 10.0"}),
        (
            "crypto_daily", "daily",
            {"close_positive": "close <= 0", "abs_ret_1d_within_limit": "abs(ret_1d) > 10.0"},
        ),
        (
            "corr_btc_usdpln_63d", "corr",
            {"corr_in_range": "abs(corr_btc_usdpln_63d) > 1.0000001"},
        ),
        (
            "crypto_monthly_facts", "monthly",
            {
                "last_close_positive": "last_close <= 0",
                "abs_avg_ret_1d_within_limit": "abs(avg_ret_1d) > 10.0",
                "vol_ret_not_negative": "vol_ret < 0",
            },
        ),
    )
    for check, violations in (
        ("not_empty", "(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END)"),
        *((c, f"count(*) FILTER (WHERE {v})") for c, v in listed.items()),
    )
)
_FROM_BARS = _with("bars") + "SELECT * FROM bars"
_CELLS_ALL = _with("cells") + f"SELECT {_CELL} FROM cells"
_LATEST_RATES = _with("rates") + "SELECT fx_date, code, currency, mid"

ORACLES: dict[str, str] = {
    "tick_normalize": _with("raw_valid")
    + """SELECT trade_id, symbol, price, quantity, event_ts, CAST(event_ts AS DATE) AS date,
    CAST(hour(event_ts) AS INTEGER) AS hour, strftime(event_ts, '%d-%H-%M') AS minute_name
    FROM raw_valid""",
    "tick_rejects": _with("tick_reasons") + "SELECT trade_id, reject_reason FROM tick_reasons",
    "trade_parse": f"""SELECT event_id AS trade_id, event_type AS symbol, value AS price,
    CAST({_K} AS DOUBLE) AS quantity, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS event_time,
    date_trunc('millisecond', ts) AS event_ts FROM events
    WHERE event_id NOT IN (SELECT event_id FROM ({_with("trade_reasons")}
    SELECT event_id FROM trade_reasons))""",
    "trade_rejects": _with("trade_reasons") + "SELECT event_id, reject_reason FROM trade_reasons",
    "trade_dedup": _with("ticks")
    + "SELECT symbol, trade_id, price, quantity, event_ts FROM ticks",
    "json_props_extract": f"SELECT event_id, CAST({_K} AS BIGINT) AS k FROM events",
    "rates_document_explode": _DOCUMENT_RATES,
    "topic_publish_records": _with("ticks")
    + "SELECT symbol AS key, trade_id, price, quantity FROM ticks",
    "bars_hourly": _FROM_BARS,
    "bars_daily": _with("ticks") + _bars("ticks", "day", "bucket_start_ts"),
    "bars_minute": _with("ticks") + _bars("ticks", "minute", "bucket_start_ts"),
    "bars_daily_close": _with("closes") + "SELECT symbol, date, close, ts_max FROM closes",
    "volume_daily": _with("volume")
    + """SELECT symbol, date, round(volume_sum, 4) AS volume_sum,
    round(volume_quote_sum, 4) AS volume_quote_sum, trade_count_sum FROM volume""",
    "returns_simple_events": _with("daily")
    + "SELECT symbol, date, close, ts_max, round(ret_1d, 6) + 0.0 AS ret_1d FROM daily",
    "returns_simple_rates": _with("rate_returns")
    + "SELECT fx_date, code, mid, round(ret_1d, 6) + 0.0 AS ret_1d, year, month FROM rate_returns",
    "returns_ticks": _with("ticks")
    + """SELECT symbol, event_ts, trade_id, price, round(price / nullif(lag(price) OVER
    (PARTITION BY symbol ORDER BY event_ts, trade_id), 0) - 1, 6) + 0.0 AS ret FROM ticks""",
    "rolling_vol_21": _with("rate_returns")
    + """SELECT code, fx_date, round(stddev_pop(ret_1d) OVER (PARTITION BY code ORDER BY fx_date
    ROWS BETWEEN 20 PRECEDING AND CURRENT ROW), 6) + 0.0 AS vol_21d FROM rate_returns""",
    "rates_latest_wins": _with("rates") + "SELECT fx_date, code, currency, mid, load_no FROM rates",
    "rates_upsert_month": _with("rates")
    + """SELECT fx_date, code, CASE WHEN currency <> 'F' THEN currency END AS currency, mid,
    load_no FROM rates""",
    "series_join_inner": _with("own_pair")
    + """SELECT date, round(x, 6) + 0.0 AS ret_base, round(y, 6) + 0.0 AS ret_quote
    FROM own_pair""",
    "rolling_moment_sums": _with("sums")
    + """SELECT base, quote, date, n, round(sum_x, 3) + 0.0 AS sum_x,
    round(sum_y, 3) + 0.0 AS sum_y, round(sum_x2, 3) + 0.0 AS sum_x2,
    round(sum_y2, 3) + 0.0 AS sum_y2, round(sum_xy, 3) + 0.0 AS sum_xy FROM sums""",
    "rolling_corr_pairs": _with("joined")
    + "SELECT base, quote, date, round(corr, 6) + 0.0 AS corr FROM ("
    + _pair_corr("joined", _FRAME, "base, quote, date", "corr")
    + ")",
    "rolling_corr_compat": _with("sums")
    + """SELECT base, quote, date, round(CASE WHEN n >= 2 AND spread > 0
    THEN (n * sum_xy - sum_x * sum_y) / sqrt(spread) END, 6) + 0.0 AS corr FROM (SELECT *,
    (n * sum_x2 - sum_x * sum_x) * (n * sum_y2 - sum_y * sum_y) AS spread FROM sums)""",
    "facts_monthly": _with("monthly")
    + """SELECT symbol, year, month, round(avg_ret_1d, 6) + 0.0 AS avg_ret_1d,
    round(vol_ret, 6) + 0.0 AS vol_ret, days_ret, last_close FROM monthly""",
    "facts_monthly_rates": _with("rate_returns")
    + """SELECT code AS symbol, year, month, round(avg(ret_1d), 6) + 0.0 AS avg_ret_1d,
    round(stddev_pop(ret_1d), 6) + 0.0 AS vol_ret, CAST(count(ret_1d) AS BIGINT) AS days_ret,
    arg_max(mid, fx_date) AS last_close FROM rate_returns GROUP BY 1, 2, 3""",
    "facts_assembled": _with("facts")
    + """SELECT symbol, date, close, round(ret_1d, 6) + 0.0 AS ret_1d,
    round(volume_sum, 4) AS volume_sum, round(volume_quote_sum, 4) AS volume_quote_sum,
    trade_count_sum, round(corr_btc_usdpln_63d, 6) + 0.0 AS corr_btc_usdpln_63d FROM facts""",
    "rowkeys": _with("keys") + "SELECT symbol, date, rowkey FROM keys",
    "cells_unpivot": _CELLS_ALL,
    "cells_point_get": _CELLS_ALL + f" WHERE rowkey LIKE '%|{BASE}|{CELL_KEY_DAY}'",
    "cells_family_get": _CELLS_ALL
    + f" WHERE rowkey LIKE '%|{BASE}|{CELL_KEY_DAY}' AND family = 'volume'",
    "cells_scan_limit": _CELLS_ALL
    + f" WHERE rowkey IN (SELECT DISTINCT rowkey FROM cells ORDER BY rowkey LIMIT {SCAN_ROWS})",
    "cells_upsert": _with("cells")
    + """SELECT rowkey, date, family, qualifier,
    round(CASE WHEN family = 'volume' THEN value * 2 ELSE value END, 4) + 0.0 AS value,
    CASE WHEN family = 'volume' THEN 2 ELSE 1 END AS version FROM cells""",
    "cells_delete": _CELLS_ALL + " WHERE family <> 'metrics' AND rowkey NOT LIKE '%|signup|%'",
    "cells_store_changes": _with("cells")
    + f"""SELECT rowkey, date, family, qualifier,
    round(CASE WHEN rowkey LIKE '%|signup|%' THEN value * 2 ELSE value END, 4) + 0.0 AS value,
    CASE WHEN rowkey LIKE '%|signup|%' THEN 3 ELSE 1 END AS version FROM cells
    WHERE CASE WHEN rowkey LIKE '%|signup|%' THEN family = 'price' AND day(date) % 2 = 1
    ELSE family <> 'metrics' AND rowkey NOT LIKE '%|{CELL_KEY_DAY}' END""",
    "cells_pivot_back": _with("facts", "keys")
    + f"""SELECT rowkey, round(ret_1d, 4) + 0.0 AS metrics_ret_1d,
    round(close, 4) + 0.0 AS price_avg, round(volume_sum, 4) + 0.0 AS volume_sum,
    CAST(trade_count_sum AS DOUBLE) AS volume_count,
    CASE WHEN symbol = '{BASE}' THEN round(corr_btc_usdpln_63d, 4) + 0.0 END
    AS correlation_btc_usdpln_63d FROM facts JOIN keys USING (symbol, date)""",
    "cells_upload_count": _with("cells") + "SELECT CAST(count(*) AS BIGINT) AS puts FROM cells",
    "topk_partition_sql": _with("rates")
    + f"""SELECT fx_date, code, mid FROM rates WHERE year(fx_date) = {TOPK_YEAR}
    AND month(fx_date) = {TOPK_MONTH} ORDER BY fx_date DESC, code LIMIT {TOPK_ROWS}""",
    "date_count_sql": _with("rates")
    + f"SELECT CAST(count(*) AS BIGINT) AS rows FROM rates WHERE fx_date = DATE '{COUNT_DAY}'",
    "coverage_latest_common_date": """SELECT max(date) AS date FROM (
    SELECT CAST(o_orderdate AS DATE) AS date FROM orders
    INTERSECT SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
    "coverage_latest_hour": f"""SELECT CAST(max(hour(ts)) AS INTEGER) AS hour FROM events
    WHERE CAST(ts AS DATE) = DATE '{COVERAGE_DAY}'""",
    "quality_report_all": _REPORT.replace("{fx}", "rate_returns"),
    "lake_bars_from_csv": _RAW_BARS,
    "lake_rejects_from_csv": _with("tick_reasons")
    + "SELECT trade_id, reject_reason FROM tick_reasons",
    "lake_rejects_rerun": """SELECT event_id AS trade_id, 'event_time' AS reject_reason
    FROM events WHERE event_type = 'error' AND value > 100""",
    "lake_day_equals_full": _RAW_BARS,
    "lake_day_mixed_landing": _RAW_BARS
    + f" WHERE CAST(hour_start_ts AS DATE) = DATE '{COVERAGE_DAY}'",
    "lake_incremental": _RAW_BARS,
    "stream_late_hours": _with("raw_valid")
    + """, days AS (SELECT min(CAST(ts AS DATE)) AS d0, date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS n
      FROM events),
    parted AS (SELECT event_ts, least(date_diff('day', d0, CAST(ts AS DATE)) * 3 // n
        + CASE WHEN trade_id % 20 = 3 THEN 1 ELSE 0 END, 2) AS part FROM raw_valid, days),
    borders AS (SELECT p, (SELECT max(event_ts) FROM parted WHERE part < p) - INTERVAL 10 MINUTE AS border
      FROM (VALUES (1), (2)) AS t(p))
    SELECT CAST(event_ts AS DATE) AS date, CAST(hour(event_ts) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS ticks
    FROM parted JOIN borders ON part = p AND event_ts < border GROUP BY 1, 2""",
    "document_rejects": """SELECT strftime(d, '%j/%Y') AS no,
    CASE WHEN dayofyear(d) <= 31 THEN 'no_tables' ELSE 'malformed' END AS reject_reason
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
    WHERE dayofyear(d) <= 31 OR dayofyear(d) BETWEEN 60 AND 90""",
    "lake_day_rebuild": _RAW_BARS
    + f" WHERE CAST(hour_start_ts AS DATE) = DATE '{COVERAGE_DAY}'",
    "lake_rates_upsert": _LATEST_RATES + " FROM rates",
    "lake_rates_month": _with("rates")
    + f"""SELECT fx_date, code, mid FROM rates
    WHERE year(fx_date) = {TOPK_YEAR} AND month(fx_date) = {TOPK_MONTH}""",
    "lake_rates_json": _with("closes")
    + """SELECT upper(symbol) AS currency, symbol AS code, close AS mid, date AS fx_date
    FROM closes""",
    "lake_rate_documents": _DOCUMENT_RATES,
    "lake_analytics_checks": _REPORT.replace("{fx}", "daily"),
    "lake_serving_cells": _CELLS_ALL,
    "lake_external_tables": _with("closes", "volume")
    + """SELECT symbol, date, trade_count_sum AS trades, close
    FROM closes JOIN volume USING (symbol, date)""",
    "lake_partition_coverage": """SELECT DISTINCT CAST(ts AS DATE) AS date,
    CAST(hour(ts) AS INTEGER) AS hour FROM events""",
    "lake_daily_returns": _with("daily")
    + "SELECT symbol, date, close, ts_max, round(ret_1d, 6) + 0.0 AS ret_1d FROM daily",
    "lake_rate_returns": _with("daily")
    + """SELECT date AS fx_date, symbol AS code, close AS mid, round(ret_1d, 6) + 0.0 AS ret_1d,
    CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM daily""",
    "lake_monthly_facts": _with("monthly")
    + """SELECT symbol, year, month, round(avg_ret_1d, 6) + 0.0 AS avg_ret_1d,
    round(vol_ret, 6) + 0.0 AS vol_ret, days_ret, last_close FROM monthly""",
    "lake_correlation": _with("corr")
    + "SELECT date, round(corr_btc_usdpln_63d, 6) + 0.0 AS corr_btc_usdpln_63d FROM corr",
    "lake_table_samples": _with("daily", "monthly", "corr")
    + """SELECT table_name, CAST(least(n, 5) AS BIGINT) AS rows, n IS NULL AS missing FROM (
    SELECT 'fx_daily_returns' AS table_name, (SELECT count(*) FROM daily) AS n
    UNION ALL SELECT 'crypto_daily', (SELECT count(*) FROM daily)
    UNION ALL SELECT 'corr_btc_usdpln_63d', (SELECT count(*) FROM corr)
    UNION ALL SELECT 'crypto_monthly_facts', (SELECT count(*) FROM monthly))""",
    "lake_file_dates": """SELECT DISTINCT CAST(ts AS DATE) AS date,
    CAST(hour(ts) AS INTEGER) AS hour FROM events""",
    "lake_put_commands": _with("cells")
    + """SELECT 'finance:facts_daily' AS table_name, rowkey, family, qualifier,
    round(value, 4) + 0.0 AS value FROM cells""",
    "lake_file_rows": """SELECT CAST(ts AS DATE) AS date, CAST(count(*) AS BIGINT) AS rows
    FROM events GROUP BY 1""",
    "stream_bars_hourly": _with("ticks") + _bars("ticks", "hour", "bucket_start_ts"),
    "stream_bars_closed": _with("ticks")
    + "SELECT * FROM ("
    + _bars("ticks", "hour", "bucket_start_ts")
    + """) WHERE bucket_start_ts + INTERVAL 1 HOUR <=
    (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 10 MINUTE FROM ticks)""",
    "stream_dedup": _with("ticks") + "SELECT symbol, trade_id, price, quantity FROM ticks",
    "stream_route_valid": f"""SELECT event_id AS trade_id, event_type AS symbol, value AS price,
    CAST({_K} AS DOUBLE) AS quantity, date_trunc('millisecond', ts) AS event_ts,
    CAST(ts AS DATE) AS date FROM events WHERE event_id NOT IN (SELECT event_id FROM (
    {_with("trade_reasons")} SELECT event_id FROM trade_reasons))""",
    "stream_route_rejects": _with("trade_reasons")
    + """SELECT reject_reason, CAST(count(*) AS BIGINT) AS rows FROM trade_reasons
    GROUP BY reject_reason""",
    "stream_landing": """SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(count(*) AS BIGINT) AS rows, round(sum(value), 2) AS price_sum
    FROM events GROUP BY 1, 2""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
