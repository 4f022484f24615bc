"""Explicit table schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)

BRONZE_BARS = T.StructType([
    T.StructField("code", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("open", PRICE, True),
    T.StructField("high", PRICE, True),
    T.StructField("low", PRICE, True),
    T.StructField("close", PRICE, True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("raw_json", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

COMPONENTS = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("ingested_at", T.TimestampType(), True),
])

LANDING = T.StructType([
    T.StructField("time", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
])

LISTING = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("type", T.StringType(), True),
    T.StructField("exchange", T.StringType(), True),
])

HOLIDAYS = T.StructType([
    T.StructField("date", T.DateType(), False),
])
