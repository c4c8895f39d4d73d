"""Cost and time estimates per processor tier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Latency band of each tier.
TIER_LATENCY = {
    "lite-fast": "10-20s",
    "base-fast": "15-50s",
    "core-fast": "15s-100s",
    "core2x-fast": "15s-3min",
    "pro-fast": "30s-5min",
    "ultra-fast": "1-10min",
    "ultra2x-fast": "1-20min",
    "ultra4x-fast": "1-40min",
    "ultra8x-fast": "1min-1hr",
    "lite": "10-60s",
    "base": "15-100s",
    "core": "1-5min",
    "core2x": "1-10min",
    "pro": "2-10min",
    "ultra": "5-25min",
    "ultra2x": "5-50min",
    "ultra4x": "5-90min",
    "ultra8x": "5min-2hr",
}
# Price per row; other tiers have no published price.
TIER_PRICE = {"lite": 0.005, "base": 0.01, "core": 0.025, "pro": 0.10}


def tiers(spark: SparkSession) -> DataFrame:
    """``(processor, price_per_row, min_seconds, max_seconds)`` for the tiers."""
    rows = [(name, TIER_PRICE.get(name.removesuffix("-fast")), band) for name, band in TIER_LATENCY.items()]
    raw = spark.createDataFrame(rows, "processor string, price_per_row double, band string")
    pattern = r"^(\d+)(s|min|hr)?-(\d+)(s|min|hr)$"
    part = lambda i: F.regexp_extract("band", pattern, i)
    low_unit = F.when(part(2) != "", part(2)).otherwise(part(4))
    seconds = lambda unit: F.when(unit == "s", 1).when(unit == "min", 60).otherwise(3600)
    return raw.select(
        "processor",
        "price_per_row",
        (part(1).cast("bigint") * seconds(low_unit)).alias("min_seconds"),
        (part(3).cast("bigint") * seconds(part(4))).alias("max_seconds"),
    )


def estimate(requests: DataFrame, processor: str = "processor") -> DataFrame:
    """Rows, cost and latency band per requested tier."""
    counted = requests.groupBy(F.col(processor).alias("processor")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(tiers(requests.sparkSession), "processor", "left").select(
        "processor",
        "rows",
        F.round(F.col("rows") * F.col("price_per_row"), 3).alias("cost"),
        "min_seconds",
        "max_seconds",
    )
