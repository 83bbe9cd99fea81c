"""Column layouts of the lake, as DDL strings usable by readers and tables."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

RATE_JSON = "currency STRING, code STRING, mid DOUBLE"

RATES_DOCUMENT = (
    "ARRAY<STRUCT<`table`: STRING, `no`: STRING, effectiveDate: STRING, "
    "rates: ARRAY<STRUCT<currency: STRING, code: STRING, mid: DOUBLE>>>>"
)

FX_DAILY = (
    "fx_date DATE, code STRING, currency STRING, mid DOUBLE, load_ts TIMESTAMP, "
    "year INT, month INT"
)

HOURLY_BARS = (
    "symbol STRING, hour_start_ts TIMESTAMP_NTZ, ts_min TIMESTAMP_NTZ, "
    "ts_max TIMESTAMP_NTZ, price_open DOUBLE, price_close DOUBLE, "
    "price_high DOUBLE, price_low DOUBLE, price_avg DOUBLE, price_p95 DOUBLE, "
    "volume_base DOUBLE, volume_quote DOUBLE, trade_count BIGINT, "
    "load_ts TIMESTAMP, date DATE, hour INT"
)

FX_DAILY_RETURNS = (
    "fx_date DATE, code STRING, mid DOUBLE, ret_1d DOUBLE, year INT, month INT"
)

CRYPTO_DAILY = (
    "date DATE, ts_max TIMESTAMP_NTZ, close DOUBLE, ret_1d DOUBLE, symbol STRING"
)

CORRELATION = "date DATE, corr_btc_usdpln_63d DOUBLE"

MONTHLY_FACTS = (
    "year INT, month INT, avg_ret_1d DOUBLE, vol_ret DOUBLE, days_ret BIGINT, "
    "last_close DOUBLE, symbol STRING"
)

CELLS = (
    "rowkey STRING, family STRING, qualifier STRING, value STRING, "
    "version TIMESTAMP, date DATE"
)

# table name -> (columns, partition columns, folder under the lake root)
LAKE_TABLES = {
    "fx_daily": (FX_DAILY, ("year", "month"), "curated/fx_daily"),
    "trades_agg_hourly": (HOURLY_BARS, ("date", "hour"), "curated/trades_agg_hourly"),
    "fx_daily_returns": (FX_DAILY_RETURNS, ("year", "month"), "aggregated/fx_daily_returns"),
    "crypto_daily": (CRYPTO_DAILY, ("symbol",), "aggregated/crypto_daily"),
    "corr_btc_usdpln_63d": (CORRELATION, (), "aggregated/corr_btc_usdpln_63d"),
    "crypto_monthly_facts": (MONTHLY_FACTS, ("symbol",), "aggregated/crypto_monthly_facts"),
}
