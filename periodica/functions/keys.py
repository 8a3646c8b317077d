"""Normalization of identifiers, tickers and exchange labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodica import constants


def _padded(text: Column) -> Column:
    # lpad cuts longer strings, so only short ones are padded.
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def cik(value: Column) -> Column:
    """Company number as ten digits; blanks and zeros become all zeros."""
    return _padded(F.regexp_replace(F.trim(value.cast("string")), "^0+", ""))


def accession(value: Column) -> Column:
    """Accession number without dashes or outer blanks."""
    return F.trim(F.replace(value, F.lit("-"), F.lit("")))


def ticker(value: Column) -> Column:
    """Ticker of an index feed: unquoted, upper case, dashes for class shares."""
    bare = F.btrim(F.trim(value), F.lit('"'))
    return F.replace(F.upper(bare), F.lit("."), F.lit("-"))


def country(exchange: Column) -> Column:
    """Country guess from an exchange label."""
    label = F.upper(F.trim(exchange))
    return (
        F.when(exchange.isNull() | (label == ""), "UNKNOWN")
        .when(label.isin(*constants.US_EXCHANGE_LABELS), "USA")
        .otherwise("FOREIGN")
    )


def exchange_key(label: Column) -> Column:
    """Key under which exchange labels are matched."""
    return F.lower(F.trim(label))


def quote_symbol(tick: Column, exchange_code: Column, feed: str = "quotes") -> Column:
    """Symbol of a listing in a price feed, NULL where the feed has no such exchange.

    ``quotes`` uses the plain ticker on US exchanges, ``csv`` a lower-case ticker
    with a market suffix.
    """
    code = F.upper(exchange_code)
    if feed == "quotes":
        return F.when(code.isin(*constants.US_QUOTE_EXCHANGES), F.upper(tick))
    if feed == "csv":
        suffixes = F.create_map(*[F.lit(x) for pair in constants.FEED_SUFFIXES.items() for x in pair])
        suffix = F.try_element_at(suffixes, code)
        return F.when(suffix.isNotNull(), F.concat_ws(".", F.lower(tick), suffix))
    raise ValueError(f"unknown price feed {feed!r}")


def row_id(*parts: str | Column, digits: int = 32) -> Column:
    """Identifier derived from the natural key, equal on every retry.

    Each part is prefixed by its length, so neighbours never run together and
    NULL differs from an empty string. As a hash it cannot be compressed, so it has the
    128 bits of the UUIDs of the source system: two of 10^12 rows share one with a
    probability below 10^-14.
    """
    marked = []
    for part in parts:
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        marked.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.left(F.sha2(F.concat_ws("|", *marked), 256), F.lit(digits))
