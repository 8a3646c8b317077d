"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.workload.views import Views, duck


@dataclass(frozen=True)
class Query:
    """A query over the views; listed columns are compared as rounded doubles or as longs."""

    build: Callable[[Views], DataFrame]
    sql: str | None
    doubles: Sequence[str]
    longs: Sequence[str]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.over(Views(spark, folder))

    def over(self, views: Views) -> DataFrame:
        """The result over given views."""
        df = self.build(views)
        casts = {c: F.round(F.col(c).cast("double"), 6) for c in self.doubles}
        return df.withColumns(casts | {c: F.col(c).cast("bigint") for c in self.longs})

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in self.doubles]
        casts += [f"CAST({c} AS BIGINT) AS {c}" for c in self.longs]
        text = duck(self.sql)
        return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{text}\n) result" if casts else text


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, doubles: str = "", longs: str = "") -> Callable:
    """Register the decorated function under its name."""

    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(build, sql, doubles.split(), longs.split())
        return build

    return register


def load() -> dict[str, Query]:
    """Import every query module and return the registry."""
    from periodica.workload import analysis, audits, basics, landing, layers, stored  # noqa: F401

    return QUERIES
