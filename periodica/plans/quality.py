"""Plausibility of the yearly financials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions.money import ratio
from periodica.operators.aggregates import latest_period

CHECKS = ("negative_revenue", "unbalanced", "absurd_margin", "future_date", "zero_revenue")


def _rules(as_of) -> dict[str, tuple[str, str, Column, Column]]:
    """Per check: field, severity, condition, reported value."""
    c = F.col
    liabilities = F.coalesce(c("total_liabilities"), c("total_assets") - c("stockholders_equity"))
    gap = ratio(F.abs(c("total_assets") - (liabilities + c("stockholders_equity"))), c("total_assets"))
    revenue = c("revenue").cast("double")
    return {
        "negative_revenue": ("revenue", "error", revenue < 0, revenue),
        "unbalanced": ("balance", "error", gap > constants.BALANCE_TOLERANCE, gap),
        "absurd_margin": (
            "gross_margin", "error",
            (revenue > 0) & (c("gross_profit") > c("revenue") * F.lit(constants.MARGIN_FACTOR).cast("decimal(3,2)")),
            c("gross_profit").cast("double"),
        ),
        "future_date": (
            "period_end", "warning",
            c("period_end") > F.add_months(F.lit(as_of).cast("date"), 24),
            F.year("period_end").cast("double"),
        ),
        "zero_revenue": ("revenue", "warning", revenue == 0, F.lit(0.0)),
    }


def quality_issues(core: DataFrame, min_year: int, as_of, checks: Sequence[str] = CHECKS) -> DataFrame:
    """Issues of the latest period of each company-year, all checks in one pass."""
    latest = latest_period(core.where(F.col("fiscal_year") >= min_year), ["company_id", "fiscal_year"], "period_end")
    rules = _rules(as_of)
    found = F.array(
        *[
            F.when(
                rules[name][2],
                F.struct(
                    F.lit(rules[name][0]).alias("field"), F.lit(name).alias("issue_type"),
                    F.lit(rules[name][1]).alias("severity"), rules[name][3].alias("value"),
                ),
            )
            for name in checks
        ]
    )
    return latest.select("company_id", "fiscal_year", F.explode(F.array_compact(found)).alias("i")).select(
        "company_id", "fiscal_year", "i.*"
    )


def issues(core: DataFrame, check: str, min_year: int, as_of="9999-12-31") -> DataFrame:
    return quality_issues(core, min_year, as_of, [check])


def cross_check(
    ours: DataFrame,
    theirs: DataFrame,
    keys: Sequence[str],
    tolerance: float = 0.05,
    comparators: Mapping[str, str] | None = None,
    default: str = "value",
) -> DataFrame:
    """Difference in percent of a metric against a second source.

    ``ours`` has ``value`` and ``concept``; ``comparators`` names, per concept,
    the column of ``theirs`` with the same definition, others use ``default``.
    """
    columns = sorted({default, *(comparators or {}).values()})
    other = theirs.select(*keys, *[F.col(c).cast("double").alias(f"other_{c}") for c in columns])
    chosen = F.coalesce(
        *[F.when(F.col("concept") == tag, F.col(f"other_{column}")) for tag, column in (comparators or {}).items()],
        F.col(f"other_{default}"),
    )
    diff = ratio(F.abs(F.col("value").cast("double") - F.col("other_value")), F.abs("other_value")) * 100
    return (
        ours.join(other, list(keys))
        .withColumn("_chosen", chosen)
        .select(*keys, "concept", "value", F.col("_chosen").alias("other_value"))
        .withColumn("diff_pct", diff)
        .withColumn("within", F.col("diff_pct") <= tolerance * 100)
    )


def field_coverage(core: DataFrame) -> DataFrame:
    """Companies with all metrics in their latest period, and missing ones per metric."""
    latest = latest_period(core, ["company_id"], "period_end")
    missing = {m: F.col(m).isNull() for m in constants.CORE_METRICS}
    complete = F.lit(True)
    for gap in missing.values():
        complete = complete & ~gap
    return latest.agg(
        F.count("*").alias("companies"),
        F.count_if(complete).alias("complete"),
        *[F.count_if(gap).alias(f"missing_{m}") for m, gap in missing.items()],
    )
