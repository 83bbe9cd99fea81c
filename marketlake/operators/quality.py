"""Declarative range checks: one aggregate pass per table, one report for all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import CORRELATION_COLUMN, MAX_ABS_CORRELATION, MAX_ABS_RETURN


@dataclass(frozen=True)
class Check:
    """``violated`` is true on a bad row; null (unknown) does not count."""

    name: str
    violated: Column


def _return_check(column: str) -> Check:
    return Check(f"abs_{column}_within_limit", F.abs(F.col(column)) > MAX_ABS_RETURN)


def _positive_check(column: str) -> Check:
    return Check(f"{column}_positive", F.col(column) <= 0)


def standard_checks() -> dict[str, list[Check]]:
    corr = F.col(CORRELATION_COLUMN)
    return {
        "fx_daily_returns": [_return_check("ret_1d")],
        "crypto_daily": [_positive_check("close"), _return_check("ret_1d")],
        "corr_btc_usdpln_63d": [
            Check("corr_in_range", (corr < -MAX_ABS_CORRELATION) | (corr > MAX_ABS_CORRELATION))
        ],
        "crypto_monthly_facts": [
            _positive_check("last_close"),
            _return_check("avg_ret_1d"),
            Check("vol_ret_not_negative", F.col("vol_ret") < 0),
        ],
    }


def run_checks(name: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Report rows ``(table_name, check_name, rows, violations, passed)`` of one table.

    Count and all violation counts come from one scan; the report is the unpivoted
    single result row. ``not_empty`` is always checked.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(c.violated).alias(f"_v{i}") for i, c in enumerate(checks)],
    )
    entries = [("not_empty", F.when(F.col("rows") == 0, 1).otherwise(0).cast("bigint"))]
    entries += [(c.name, F.col(f"_v{i}")) for i, c in enumerate(checks)]
    listed = F.array(
        *[F.struct(F.lit(n).alias("check_name"), v.alias("violations")) for n, v in entries]
    )
    return counted.select(F.lit(name).alias("table_name"), "rows", F.inline(listed)).select(
        "table_name", "check_name", "rows", "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def quality_report(
    tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]] | None = None
) -> DataFrame:
    checks = standard_checks() if checks is None else checks
    parts = [run_checks(name, df, checks.get(name, ())) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


class QualityError(ValueError):
    """A check failed; the message lists every failed check."""


def enforce(report: DataFrame) -> None:
    """Raise when a check failed. The report has one row per check, so it is tiny."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        listed = "; ".join(
            f"{r.table_name}.{r.check_name}: {r.violations} violations" for r in failed
        )
        raise QualityError(listed)
