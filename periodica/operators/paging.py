"""Order, limits and deterministic samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_nulls_last(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), *ties)


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[Column | str], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def stratified_pick(
    df: DataFrame, key: str, strata: Mapping[str, tuple[Column, int | None]], target: int
) -> DataFrame:
    """The first keys of every stratum, then further keys in order up to a total.

    ``strata`` maps a name to its condition and size (None: all). Strata may
    overlap; a key counts once. The result has the key and the picking stratum.
    """
    names = {name: i for i, name in enumerate(strata)}
    hits = F.array(*[F.when(hit, F.lit(i)) for i, (hit, _) in enumerate(strata.values())])
    tagged = df.select(key, F.explode(F.array_compact(hits)).alias("_stratum")).distinct()
    unlimited = [i for i, (_, size) in enumerate(strata.values()) if size is None]
    picked = tagged.where(F.col("_stratum").isin(*unlimited)) if unlimited else tagged.where("false")
    for i, (_, size) in enumerate(strata.values()):
        if size is not None:
            picked = picked.unionByName(tagged.where(F.col("_stratum") == i).orderBy(key).limit(size))
    labels = F.create_map(*[F.lit(x) for name, i in names.items() for x in (i, name)])
    chosen = picked.groupBy(key).agg(F.min("_stratum").alias("_stratum"))
    # The ordered limit over all keys that are not chosen yet fills up to the target.
    room = F.greatest(F.lit(target) - chosen.agg(F.count("*").alias("n")).scalar(), F.lit(0))
    rest = df.select(key).distinct().join(chosen.select(key), key, "left_anti").orderBy(key).limit(target)
    numbered = rest.withColumn("_n", F.row_number().over(Window.orderBy(key)))
    fill = numbered.where(F.col("_n") <= room).select(key, F.lit("fill").alias("stratum"))
    return chosen.select(key, labels[F.col("_stratum")].alias("stratum")).unionByName(fill)
