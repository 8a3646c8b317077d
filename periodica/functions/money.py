"""Currencies, ratios and growth rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodica import constants


def is_currency(code: Column) -> Column:
    """True for a plain code that counts as money."""
    return code.isin(*constants.currency_codes())


def currency_from_unit(unit: Column) -> Column:
    """Currency of a fact unit: ``EUR`` and ``eur/shares`` give EUR, ``shares`` NULL."""
    code = F.split_part(F.upper(F.trim(unit)), F.lit("/"), F.lit(1))
    return F.when(is_currency(code), code)


def packed(code: Column) -> Column:
    """A three-letter code as a number of the same order.

    Spark aggregates numbers in hash tables, but sorts for the maximum of a text.
    """
    return F.conv(F.hex(code), 16, 10).cast("int")


def unpacked(number: Column) -> Column:
    return F.decode(F.unhex(F.hex(number.cast("bigint"))), "UTF-8")


def unit_is_currency(unit: Column) -> Column:
    """Three capitals, optionally per share."""
    return unit.rlike("^[A-Z]{3}(/shares)?$")


def to_usd(value: Column, currency: Column, usd_per_unit: Column) -> Column:
    """Dollar amount; NULL when no rate is known, never a rate of one."""
    return (
        F.when(currency == "USD", value)
        .when(usd_per_unit.isNotNull(), F.try_multiply(value, usd_per_unit))
        .cast("decimal(38,6)")
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def growth(current: Column, previous: Column) -> Column:
    """Change against a previous value in percent."""
    return percent(current.cast("double") - previous.cast("double"), previous)
