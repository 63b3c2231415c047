"""Calendar dimension (P20): one row per day of the configured years."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S


def build_dim_date(spark: SparkSession, first_year: int = S.CALENDAR_FIRST_YEAR,
                   last_year: int = S.CALENDAR_LAST_YEAR) -> DataFrame:
    """Generated on the executors from ``spark.range`` (13 years = 4,748 rows).

    ``weekday`` is 0 = Monday .. 6 = Sunday, so the weekend is 5 and 6
    (``dayofweek`` would be 1 = Sunday).
    """
    start = dt.date(first_year, 1, 1)
    n_days = (dt.date(last_year, 12, 31) - start).days + 1
    d = F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int"))
    days = spark.range(n_days).select(d.alias("date_key"))
    k = F.col("date_key")
    return days.select(
        k,
        F.dayofmonth(k).alias("day"),
        F.month(k).alias("month"),
        F.date_format(k, "MMMM").alias("month_name"),
        F.quarter(k).alias("quarter"),
        F.year(k).alias("year"),
        F.date_format(k, "yyyy-MM").alias("year_month"),
        F.date_format(k, "EEEE").alias("day_of_week"),
        F.weekday(k).isin(5, 6).cast("int").alias("is_weekend"),
    )
