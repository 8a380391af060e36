"""Amounts: conversion through euro rates to US cents, and English capital objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usd_cents(amount: Column, currency: Column, source_rate: Column, usd_rate: Column, strict: bool = True) -> Column:
    """Cents of an amount; null where it cannot be converted (strict: also for negative amounts and rates of 0 or less).

    Rates are units per euro; halves are rounded away from zero."""
    converted = F.when(currency == "USD", F.round(amount * 100)).otherwise(F.round(amount / source_rate * usd_rate * 100))
    if not strict:
        return converted.cast("long")
    usable = (amount >= 0) & ((currency == "USD") | ((source_rate > 0) & (usd_rate > 0)))
    return F.when(usable, converted).cast("long")


def json_number(payload: Column, path: str) -> Column:
    """A number at a JSON path as double; null where it is missing, null or no number."""
    return F.get_json_object(payload, path).try_cast("double")


def capital(payload: Column, source_rate: Column, usd_rate: Column, rate_source: Column, rate_date: Column, kind: Column) -> Column:
    """struct<value, error>: the English capital of a registry payload, or why there is none."""
    amount, currency = json_number(payload, "$.kapital.belop"), F.get_json_object(payload, "$.kapital.valuta")
    cents = usd_cents(amount, currency, source_rate, usd_rate)
    some, whole = amount.isNotNull() | currency.isNotNull(), amount.isNotNull() & currency.isNotNull() & (currency != "")
    rate = F.struct(
        rate_source.alias("source"), rate_date.alias("rate_date"), currency.alias("source_currency"), F.lit("USD").alias("target_currency"),
        source_rate.alias("source_rate_per_eur"), usd_rate.alias("target_rate_per_eur"),
    )
    value = F.struct(
        F.when(some, cents / 100).alias("amount"), F.when(some, F.lit("USD")).alias("currency"), F.when(some, cents).alias("amount_usd_cents"),
        F.when(some, amount).alias("original_amount"), F.when(some, currency).alias("original_currency"), F.when(some, rate).alias("exchange_rate"),
        json_number(payload, "$.kapital.antallAksjer").alias("shares"), kind.alias("type"),
    )
    error = (
        F.when(some & ~whole, F.lit("incomplete capital currency data"))
        .when(some & (amount < 0), F.lit("negative amount not supported"))
        .when(some & cents.isNull(), F.lit("currency not found"))
    )
    present = F.get_json_object(payload, "$.kapital").isNotNull()
    return F.struct(F.when(present & error.isNull(), value).alias("value"), F.when(present, error).alias("error"))
