"""Euro reference rates from the central bank's XML feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED = "Cube struct<Cube:array<struct<_time:string,Cube:array<struct<_currency:string,_rate:double>>>>>"


def parse_feed(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """(place, rate_date, currency, rate) of every dated day; EUR is added with rate 1."""
    days = feeds.select(F.posexplode(F.from_xml(xml, FEED)["Cube"]["Cube"]).alias("place", "day")).filter(F.coalesce(F.col("day._time"), F.lit("")) != "")
    rates = days.select("place", F.to_date("day._time").alias("rate_date"), F.explode(F.coalesce(F.col("day.Cube"), F.array())).alias("r"))
    listed = rates.select("place", "rate_date", F.col("r._currency").alias("currency"), F.col("r._rate").alias("rate"))
    euro = days.select("place", F.to_date("day._time").alias("rate_date"), F.lit("EUR").alias("currency"), F.lit(1.0).alias("rate"))
    return listed.unionByName(euro)


def latest(rates: DataFrame) -> DataFrame:
    """Rates of the first dated day in the feed."""
    first = rates.agg(F.min("place").alias("place"))
    return rates.join(F.broadcast(first), "place").drop("place")


def on_or_before(rates: DataFrame, day: str) -> DataFrame:
    """Rates of the latest day that is not after `day`; raises if there is none."""
    best = rates.filter(F.col("rate_date") <= F.to_date(F.lit(day))).agg(F.max("rate_date").alias("rate_date"))
    if best.first()["rate_date"] is None:
        raise ValueError(f"no rate on or before {day}")
    return rates.join(F.broadcast(best), "rate_date").drop("place")
