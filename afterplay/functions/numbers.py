"""Guards and numeric idioms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def variant_number(value: Column, path: str = "$") -> Column:
    """A JSON number at ``path`` as double; numeric text, booleans and others give null."""
    found = F.try_variant_get(value, path, "variant")
    kind = F.schema_of_variant(found)
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(is_number, F.try_variant_get(value, path, "double"))


def not_nan(value: Column) -> Column:
    """NaN becomes null, so that aggregates skip it."""
    return F.when(~F.isnan(value), value)


def is_infinite(value: Column) -> Column:
    return F.abs(value) == float("inf")


def finite_or_zero(value: Column) -> Column:
    number = value.cast("double")
    return F.when(number.isNull() | F.isnan(number) | is_infinite(number), F.lit(0.0)).otherwise(number)


def round_half_up(value: Column, digits: int = 6) -> Column:
    """Rounding by floor, which gives the same double in every SQL engine."""
    scale = float(10**digits)
    return (F.floor(value * scale + 0.5) / scale).cast("double")


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double")).otherwise(0.0)
