"""Currency, price, membership and key files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions import facts as rules
from periodica.functions import keys
from periodica.operators.windows import preferred, widest_interval


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every cell as text; nothing is inferred."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def parse_fx(rows: DataFrame, currency: Column) -> DataFrame:
    """Euro reference series (units of a currency per euro); unusable rows dropped."""
    return (
        rows.select(
            currency.alias("currency"),
            rules.date(F.trim("TIME_PERIOD")).alias("rate_date"),
            F.trim("OBS_VALUE").try_cast("double").alias("per_eur"),
        )
        .where("rate_date IS NOT NULL AND per_eur IS NOT NULL")
    )


def read_fx_csv(spark: SparkSession, path: str, currency: str | None = None) -> DataFrame:
    """Reference-rate CSV; the currency comes from the argument or the CURRENCY column."""
    return parse_fx(_csv(spark, path), F.lit(currency) if currency else F.col("CURRENCY"))


def fx_from_pairs(closes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Dollar rates from pair closes (columns pair, rate_date, close).

    Per currency the direct pair ``CCYUSD`` is used, and only when it has no
    usable close at all the inverted ``USDCCY``. ``wanted`` lists the currencies;
    renamed ones are looked up under their newer code.
    """
    renamed = F.create_map(*[F.lit(x) for pair in constants.PAIR_ALIASES.items() for x in pair])
    quoted = F.coalesce(F.try_element_at(renamed, F.col("currency")), F.col("currency"))
    pairs = wanted.select("currency").distinct().select(
        "currency",
        F.explode(F.array(
            F.struct(F.concat(quoted, F.lit("USD")).alias("pair"), F.lit(0).alias("inverted")),
            F.struct(F.concat(F.lit("USD"), quoted).alias("pair"), F.lit(1).alias("inverted")),
        )).alias("p"),
    ).select("currency", "p.*")
    usable = closes.where("close > 0 AND rate_date IS NOT NULL").join(pairs, "pair")
    best = usable.groupBy("currency").agg(F.min("inverted").alias("inverted"))
    rates = usable.join(best, ["currency", "inverted"]).groupBy("currency", "rate_date", "inverted").agg(
        F.max("close").alias("close")
    )
    return rates.select(
        "currency", "rate_date",
        F.when(F.col("inverted") == 1, 1.0 / F.col("close")).otherwise(F.col("close")).alias("usd_per_unit"),
    )


def parse_ohlcv(rows: DataFrame, symbol: Column) -> DataFrame:
    """Daily bars: blanks become NULL, rows with a bad date or number are skipped."""
    numbers = {"open": "Open", "high": "High", "low": "Low", "close": "Close"}
    texts = {name: F.nullif(F.trim(F.col(source)), F.lit("")) for name, source in numbers.items()}
    volume = F.nullif(F.trim("Volume"), F.lit(""))
    typed = rows.select(
        symbol.alias("symbol"),
        rules.date(F.trim("Date")).alias("price_date"),
        *[text.try_cast("double").cast("decimal(20,6)").alias(name) for name, text in texts.items()],
        volume.try_cast("bigint").alias("volume"),
        F.array(*texts.values(), volume).alias("_texts"),
    )
    parsed = F.array(*[F.col(c).cast("string") for c in (*numbers, "volume")])
    broken = F.exists(F.arrays_zip(F.col("_texts").alias("t"), parsed.alias("p")),
                      lambda x: x["t"].isNotNull() & x["p"].isNull())
    return typed.where(F.col("price_date").isNotNull() & ~broken).drop("_texts")


def read_ohlcv_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily bars from a folder of CSV files named after their symbol."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return parse_ohlcv(_csv(spark, path), F.regexp_replace(name, r"\.csv$", ""))


def parse_membership(rows: DataFrame) -> DataFrame:
    """Index membership as half-open intervals, the widest per ticker and start."""
    start, end = F.trim("start_date"), F.nullif(F.trim("end_date"), F.lit(""))
    typed = rows.select(
        keys.ticker(F.coalesce("ticker", F.lit(""))).alias("ticker"),
        F.nullif(start, F.lit("")).cast("date").alias("start_date"),
        end.cast("date").alias("end_date"),
    ).where("ticker <> '' AND start_date IS NOT NULL AND (end_date IS NULL OR end_date > start_date)")
    return widest_interval(typed, ["ticker"])


def read_membership_csv(spark: SparkSession, path: str) -> DataFrame:
    rows = _csv(spark, path)
    rows = rows.toDF(*[c.strip() for c in rows.columns])
    missing = {"ticker", "start_date", "end_date"} - set(rows.columns)
    if missing:
        raise ValueError(f"unexpected CSV header {rows.columns}, missing {sorted(missing)}")
    return parse_membership(rows)


def parse_key_list(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim("value") != "").select(keys.cik(F.col("value")).alias("cik")).distinct()


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    """Company numbers, one per line."""
    return parse_key_list(spark.read.text(path))


def restrict_universe(universe: DataFrame, wanted: DataFrame) -> DataFrame:
    return universe.join(wanted.select("cik"), "cik", "left_semi")


def parse_sector_feed(rows: DataFrame) -> DataFrame:
    """Sector and industry per ticker; empty strings count as missing."""
    blank = F.lit("")
    typed = rows.select(
        F.upper(F.trim("ticker")).alias("ticker"),
        F.nullif(F.trim("sector"), blank).alias("sector"),
        F.nullif(F.trim("industry"), blank).alias("industry"),
    ).where("ticker <> '' AND (sector IS NOT NULL OR industry IS NOT NULL)")
    return preferred(typed, ["ticker"], [F.col("sector").asc_nulls_last(), F.col("industry").asc_nulls_last()])


def read_sector_feed(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path) if path.rstrip("/").endswith("parquet") else _csv(spark, path)
    return parse_sector_feed(rows)
