"""Ordered per-key operators.

First-row picks use ``row_number() = 1``: Spark keeps one row per key and input
partition before the shuffle, so a key with very many rows reaches its task
already reduced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica.functions.money import growth


def preferred(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per natural key, the earliest in the order; NULL keys are equal."""
    return preferred(df, keys, order)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key: names are taken in descending order."""
    return preferred(df, keys, [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order])


def latest_year(df: DataFrame, by: Sequence[str], year: str = "fiscal_year") -> DataFrame:
    return preferred(df, by, [F.col(year).desc()])


def growth_lag(df: DataFrame, by: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Growth in percent against the previous available year (gaps are bridged)."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumns({f"{c}_growth_pct": growth(F.col(c), F.lag(c).over(w)) for c in columns})


def growth_exact(df: DataFrame, by: Sequence[str], year: str, columns: Sequence[str]) -> DataFrame:
    """Growth in percent against exactly the year before, NULL after a gap."""
    w = Window.partitionBy(*by).orderBy(year)
    adjacent = F.col(year) - F.lag(year).over(w) == 1
    return df.withColumns(
        {f"{c}_growth_pct": F.when(adjacent, growth(F.col(c), F.lag(c).over(w))) for c in columns}
    )


# Later filings win; the other parts only settle ties, so the pick is repeatable.
VERSION_ORDER = ("filing_date", "period_end", "period_start", "source_id", "value")


def latest_known(facts: DataFrame, as_of, key: Sequence[str] = ("company_id", "fiscal_year", "concept")) -> DataFrame:
    """The version of each fact that was public on a day; later restatements are unseen."""
    day = F.lit(as_of).cast("date")
    known = facts.where((F.col("filing_date") <= day) & (F.col("period_end") <= day))
    return latest_by(known, list(key), VERSION_ORDER)


def widest_interval(
    df: DataFrame, by: Sequence[str], start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """One interval per key and start: an open end beats any date, else the later end."""
    # max() skips NULL ends, so an open end is looked for separately.
    others = [c for c in df.columns if c not in (*by, start, end)]
    widest = df.groupBy(*by, start).agg(
        F.when(F.count_if(F.col(end).isNull()) == 0, F.max(end)).alias(end),
        *[F.max(c).alias(c) for c in others],
    )
    return widest.select(*df.columns)
