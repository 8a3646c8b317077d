"""Grouped reductions; all of them combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from periodica.functions.money import is_currency, packed, unit_is_currency, unpacked


def alias_pivot(
    facts: DataFrame, keys: Sequence[str], aliases: Mapping[str, Sequence[str]], default: Mapping[str, float] | None = None
) -> DataFrame:
    """Greatest value per metric over its tags, one pass over the facts.

    A metric in ``default`` gets that value where no tag was reported.
    """
    default = default or {}
    metrics = []
    for metric, tags in aliases.items():
        best = F.max(F.when(F.col("concept").isin(*tags), F.col("value")))
        if metric in default:
            best = F.coalesce(best, F.lit(default[metric]).cast("decimal(30,10)"))
        metrics.append(best.alias(metric))
    return facts.groupBy(*keys).agg(*metrics)


def filtered_agg(df: DataFrame, keys: Sequence[str], specs: Mapping[str, tuple[str, str, Column]]) -> DataFrame:
    """Aggregates with their own row filter: name -> (function, column, condition)."""
    apply = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    return df.groupBy(*keys).agg(
        *[apply[how](F.when(keep, F.col(column))).alias(name) for name, (how, column, keep) in specs.items()]
    )


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*keys).agg(*[count(c).alias(f"n_{c}") for c in columns])


def provenance_counters(facts: DataFrame) -> DataFrame:
    columns = ("provider_id", "filing_id", "source_id")
    return facts.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def distinct_list(df: DataFrame, keys: Sequence[str], column: str, sep: str = ", ") -> DataFrame:
    """Distinct values per key in order, joined to one string."""
    pairs = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(column)), sep).alias(column))


def duplicates(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def coverage(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(
        F.min("fiscal_year").alias("earliest_fiscal_year"),
        F.max("fiscal_year").alias("latest_fiscal_year"),
        F.count_distinct("fiscal_year").alias("distinct_fiscal_years"),
        F.count("*").alias("total_facts"),
    )


def offending_min(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(column).alias("value"))


def latest_period(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows of the latest date of their key.

    The rows must be unique per key and date, as the yearly financials are.
    """
    from periodica.operators.windows import latest_by

    return latest_by(df, keys, [date])


def row_currency(revenue_unit: Column, assets_unit: Column) -> Column:
    """Currency of a yearly row: greatest money unit of revenue, else of total assets."""
    best = [F.max(F.when(is_currency(unit), packed(unit))) for unit in (revenue_unit, assets_unit)]
    return unpacked(F.coalesce(*best))


def unit_distribution(facts: DataFrame) -> DataFrame:
    """Facts and companies per money unit."""
    return (
        facts.where(unit_is_currency(F.col("unit")))
        .groupBy("unit", "company_id").agg(F.count("*").alias("n"))
        .groupBy("unit").agg(F.sum("n").alias("facts"), F.count("company_id").alias("companies"))
    )


def top_non_usd(facts: DataFrame, listings: DataFrame, n: int) -> DataFrame:
    """Tickers with the most facts in another currency than the dollar."""
    per_company = (
        facts.where("currency <> 'USD'").groupBy("company_id", "currency").agg(F.count("*").alias("n"))
    )
    return (
        per_company.join(listings.select("company_id", F.upper("ticker").alias("ticker")), "company_id")
        .groupBy("ticker", "currency").agg(F.sum("n").alias("facts"))
        .orderBy(F.desc("facts"), "ticker", "currency")
        .limit(n)
    )


def observe_counts(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """The frame with counters that are filled once an action has run over it."""
    observation = Observation(name)
    metrics = {"rows": F.count(F.lit(1)), **counters}
    return df.observe(observation, *[metric.alias(key) for key, metric in metrics.items()]), observation
