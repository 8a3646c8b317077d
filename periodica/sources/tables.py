"""Scans of stored tables and literal relations."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from periodica.operators.writes import ParquetTable
from periodica.schemas import TABLES, schema

# Facts are stored by fiscal year and prices by calendar year, so year filters skip whole folders
# and an insert reads the years of its batch only.
PARTITIONS = {"financial_facts": ["fiscal_year"], "prices": ["price_year"]}
SORTED = {"financial_facts": ["company_id", "concept"], "prices": ["listing_id", "price_date"]}


class Catalog:
    """The tables below one folder, by name."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def store(self, name: str) -> ParquetTable:
        return ParquetTable(self.spark, f"{self.root}/{name}", schema(name), PARTITIONS.get(name, ()), SORTED.get(name, ()))

    def table(self, name: str, *columns: str) -> DataFrame:
        """Current rows of a table, optionally only some columns."""
        df = self.store(name).read()
        return df.select(*columns) if columns else df

    def register(self) -> None:
        """Make every table that has been written a temporary view for SQL."""
        for name in TABLES:
            if self.store(name).version():
                self.table(name).createOrReplaceTempView(name)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A relation of constants.

    It is handed over as Arrow, so that Spark knows its exact size when it picks
    a join strategy.
    """
    declared = StructType.fromDDL(schema)
    columns = to_arrow_schema(declared)
    cells = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(columns)]
    return spark.createDataFrame(pa.Table.from_arrays(cells, schema=columns), declared)
