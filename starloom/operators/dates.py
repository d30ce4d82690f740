"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.values import date_key

FIRST, LAST = "1990-01-01", "2035-12-31"
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]  # December belongs to the winter of its own calendar year (fixed values)


def dim_date(spark: SparkSession, first: str = FIRST, last: str = LAST) -> DataFrame:
    """A row for each day from first to last."""
    d = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date"))
    day, month, quarter = F.dayofweek("full_date"), F.month("full_date"), F.quarter("full_date")
    season = F.floor(F.pmod(month, F.lit(12)) / 3).cast("int") + 1
    return d.select(
        date_key(F.col("full_date")).alias("date_key"), "full_date", day.alias("day_of_week"), F.date_format("full_date", "EEEE").alias("day_name"),
        F.dayofmonth("full_date").alias("day_of_month"), F.dayofyear("full_date").alias("day_of_year"), month.alias("month_number"), F.date_format("full_date", "MMMM").alias("month_name"),
        quarter.alias("quarter"), season.alias("season_number"), F.element_at(F.array(*map(F.lit, SEASONS)), season).alias("season"), F.year("full_date").alias("calendar_year"),
    )
