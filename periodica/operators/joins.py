"""Join helpers, including the as-of and interval joins Spark has no operator for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.operators.filters import contains_date


def lookup_join(df: DataFrame, dimension: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(dimension, on, "inner")


def left_join(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(other, on, "left")


def full_outer_coalesce(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join whose key columns come from whichever side has the row."""
    return a.join(b, list(keys), "full")


def wildcard_join(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Facts with their canonical field; namespace ``*`` in the mapping matches all.

    The concept equality stays a plain equi-key, the namespace test a residual.
    """
    m = mapping.select(
        F.col("namespace").alias("_mapped_namespace"),
        F.col("concept").alias("_mapped_concept"),
        "field", "normalized_concept", "combine",
    )
    hit = (facts["concept"] == F.col("_mapped_concept")) & (
        (F.col("_mapped_namespace") == "*") | (F.col("_mapped_namespace") == facts["namespace"])
    )
    return facts.join(m, hit, "inner").drop("_mapped_namespace", "_mapped_concept")


def anti(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(other, on, "left_anti")


def semi(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(other, on, "left_semi")


def null_safe_key(keys: Sequence[str]) -> Column:
    """The key columns as one value in which NULL equals NULL.

    Fields of a struct compare that way under plain equality. Grouping and joining
    on the same struct therefore share one shuffle, which ``<=>`` on the single
    columns would not.
    """
    return F.struct(*keys)


def absent_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target; NULL key parts equal each other."""
    known = target.select(null_safe_key(keys).alias("_key"))
    return batch.withColumn("_key", null_safe_key(keys)).join(known, "_key", "left_anti").drop("_key")


def prev_year_join(df: DataFrame, by: Sequence[str], year: str) -> DataFrame:
    """Each row with the values of exactly the year before, as ``prev_*`` columns."""
    values = [c for c in df.columns if c not in (*by, year)]
    previous = df.select(*by, (F.col(year) + 1).alias(year), *[F.col(c).alias(f"prev_{c}") for c in values])
    return df.join(previous, [*by, year], "left")


def asof_series(right: DataFrame, by: Sequence[str], time: str, value: str) -> DataFrame:
    """A daily series as one row per key: its ``years`` from the ``first`` to the last with an observation.

    A year has the value carried into it and its months with observations, each with
    its first day (``since``) and its observations in order, so that a day is found by
    looking at 12 and at 31 entries at most. Of several values of a day the greatest
    counts. A row is bounded by the calendar; a year without observations takes one
    entry, and there is none after the last.
    """
    day, ends = F.col("day"), F.struct("day", "value")
    daily = (
        right.where(F.col(value).isNotNull() & F.col(time).isNotNull())
        .groupBy(*by, F.col(time).cast("date").alias("day")).agg(F.max(value).alias("value"))
        .repartition(*by)  # what follows is grouped by the key and more, and stays where it is
    )
    months = daily.groupBy(*by, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.min(day).alias("since"), F.array_sort(F.collect_list(ends)).alias("obs"))
    years = months.groupBy(*by, "year").agg(
        F.array_sort(F.collect_list(F.struct("since", "obs"))).alias("months"), F.max_by(F.element_at("obs", -1)["value"], "since").alias("last"))
    whole = years.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("year", "months", "last"))).alias("_found"))
    first, last = F.get("_found", F.lit(0))["year"], F.element_at("_found", -1)["year"]

    def entry(year: Column) -> Column:
        earlier = F.filter("_found", lambda y: y["year"] < year)
        own = F.filter("_found", lambda y: y["year"] == year)
        return F.struct(F.get(own, F.lit(0))["months"].alias("months"), F.try_element_at(earlier, F.lit(-1))["last"].alias("carried"))

    return whole.select(*by, F.struct(first.alias("first"), F.transform(F.sequence(first, last), entry).alias("years")).alias("_series"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    value: str,
    bounded: bool = False,
) -> DataFrame:
    """Each left row with the right value of the latest day on or before its own day.

    The right side is a daily series and is folded to one row per key (``asof_series``).
    The left side is read once and joined by plain equality on the key, in which
    adaptive execution splits a hot one, and is neither sorted nor expanded; its day
    picks an entry of the series. With ``bounded``, the caller vouches that the keys are
    a fixed few, and the series are broadcast: the left side then is not shuffled.
    """
    series = asof_series(right, list(by), right_time, value)
    at, found = F.col(left_time).cast("date"), F.col("_series")
    place = F.least(F.year(at), found["first"] + F.size(found["years"]) - 1) - found["first"]
    year = F.get(found["years"], place)
    month = F.try_element_at(F.filter(year["months"], lambda m: m["since"] <= at), F.lit(-1))
    observed = F.try_element_at(F.filter(month["obs"], lambda o: o["day"] <= at), F.lit(-1))
    return (
        left.join(F.broadcast(series) if bounded else series, list(by), "left")
        .withColumn(value, F.coalesce(observed["value"], year["carried"]))
        .select(*left.columns, value)
    )


#: Days of the narrowest bin of an interval join; every next width is four times as many.
BIN_DAYS = 32


def _bin_level(days: Column) -> Column:
    """The narrowest width that holds as many days: 0 for ``BIN_DAYS``, 1 for four times that."""
    return F.greatest(F.lit(0), F.ceil(F.log(4.0, days / F.lit(float(BIN_DAYS))))).cast("int")


def _bin(day: Column, level: Column) -> Column:
    return F.floor(F.unix_date(day) / (BIN_DAYS * F.pow(F.lit(4.0), level)))


def interval_bins(intervals: DataFrame, start: str, end: str, first: Column, last: Column) -> DataFrame:
    """Intervals with the width (``_level``) and the bins (``_bin``) that they lie in between two days; two rows each at most."""
    since, until = F.col(start).cast("date"), F.col(end).cast("date")
    return (
        intervals
        # Least and greatest skip NULL: an open end reaches up to the last day.
        .withColumns({"_from": F.greatest(since, first), "_to": F.least(until, last)})
        .where(since.isNotNull() & (F.col("_from") <= F.col("_to")))
        .withColumn("_level", _bin_level(F.date_diff("_to", "_from") + 1))
        .withColumn("_bin", F.explode(F.sequence(_bin(F.col("_from"), F.col("_level")), _bin(F.col("_to"), F.col("_level")))))
        .drop("_from", "_to")
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    day: str,
    start: str = "start_date",
    end: str = "end_date",
    by: Sequence[str] = (),
) -> DataFrame:
    """Points with every half-open interval that contains their day.

    The equi-key, next to ``by``, is a bin of days whose width follows from the length
    of the interval, cut to the days that points lie on: the narrowest of 32, 128,
    512 ... days that holds it. So an interval, long or open, takes two rows at most
    and a point one row per width, 7 over four centuries. The exact test follows in the
    bin. Beyond the narrowest width an interval fills an eighth of its bins or more, so
    what is compared grows with the result and many points of a year are spread by bin.
    """
    at = F.col(day).cast("date")
    bounds = points.agg(F.struct(F.min(at).alias("first"), F.max(at).alias("last")).alias("b")).scalar()
    first, last = F.col("_b")["first"], F.col("_b")["last"]
    cut = interval_bins(intervals.withColumn("_b", bounds), start, end, first, last).drop("_b")
    widest = _bin_level(F.date_diff(last, first) + 1)
    marked = (
        points.withColumn("_b", bounds).where(F.col(day).isNotNull())
        .withColumn("_level", F.explode(F.sequence(F.lit(0), widest)))
        .withColumn("_bin", _bin(at, F.col("_level"))).drop("_b")
    )
    hit = contains_date(F.col(start), F.col(end), F.col(day))
    return marked.join(cut, [*by, "_level", "_bin"], "inner").where(hit).drop("_level", "_bin")


def count_branches(base: DataFrame, branches: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Number of rows of every branch per base row.

    Each branch is counted before joining, so the branches never multiply.
    """
    for name, branch in branches.items():
        base = base.join(branch.groupBy(key).agg(F.count("*").alias(name)), key, "left").fillna(0, [name])
    return base


def resolve_tickers(tickers: DataFrame, listings: DataFrame) -> DataFrame:
    """Tickers with the company of their preferred listing, NULL where unknown."""
    from periodica.operators.windows import preferred

    ranked = preferred(
        listings.select(
            F.upper("ticker").alias("ticker"), "company_id", "is_active", "is_primary", "listing_date"
        ),
        ["ticker"],
        [
            F.col("is_active").desc(),
            F.col("is_primary").desc(),
            F.col("listing_date").desc_nulls_last(),
            F.col("company_id").asc(),
        ],
    ).select("ticker", "company_id")
    return tickers.join(ranked, "ticker", "left")
