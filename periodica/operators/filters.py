"""Predicates and key restrictions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_in(df: DataFrame, column: str, values: Iterable, negate: bool = False) -> DataFrame:
    """Rows whose column is (not) one of the listed values."""
    hit = F.col(column).isin(*values)
    return df.where(~hit if negate else hit)


def in_subquery(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose column occurs in the first column of ``keys``."""
    return tuple_in(df, [column], keys)


def tuple_in(df: DataFrame, columns: Sequence[str], keys: DataFrame) -> DataFrame:
    """Rows whose column tuple occurs in the leading columns of ``keys``."""
    wanted = keys.select(*[F.col(source).alias(target) for source, target in zip(keys.columns, columns)])
    return df.join(wanted, list(columns), "left_semi")


def scalar_of(df: DataFrame, column: str) -> Column:
    """The single value of a one-row relation as a scalar subquery."""
    return df.select(column).scalar()


def at_group_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows that hold their group's greatest value (ties kept)."""
    return df.join(df.groupBy(*keys).agg(F.max(column).alias(column)), [*keys, column], "left_semi")


def exists(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on), list(on), "left_semi")


def not_exists(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on), list(on), "left_anti")


def null_safe_eq(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def between_dates(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(F.col(column).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def contains_date(start: Column, end: Column, day: Column) -> Column:
    """Half-open validity: start inclusive, end exclusive, open when NULL."""
    return (start <= day) & (end.isNull() | (end > day))


def is_stale(seen: Column, now: Column, max_age_hours: float) -> Column:
    """Never seen, or seen longer ago than the allowed age."""
    age = F.make_dt_interval(hours=F.lit(0), secs=F.lit(max_age_hours * 3600.0))
    return seen.isNull() | (seen < now - age)


def active_listings(listings: DataFrame) -> DataFrame:
    return listings.where("is_active")


def undelisted(listings: DataFrame) -> DataFrame:
    return listings.where("delisting_date IS NULL")


def instant_facts(facts: DataFrame, concept: str | None = None) -> DataFrame:
    found = facts.where("period_start IS NULL")
    return found.where(F.col("concept") == concept) if concept else found
