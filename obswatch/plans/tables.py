"""The driver's tables, read as the series that the operators watch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a day: obs_date, total and n."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("obs_date")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").cast("double").alias("n"))


def daily_ships(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem")
    return items.groupBy(F.to_date("l_shipdate").alias("obs_date")).agg(F.round(F.avg("l_quantity"), 4).alias("quantity"), F.count("*").cast("double").alias("n_items"))


#: The same in SQL.
DAILY = "daily AS (SELECT o_orderdate::DATE AS obs_date, round(sum(o_totalprice), 2) AS total, count(*)::DOUBLE AS n FROM orders GROUP BY 1)"
SHIPS = "ships AS (SELECT l_shipdate::DATE AS obs_date, round(avg(l_quantity), 4) AS quantity, count(*)::DOUBLE AS n_items FROM lineitem GROUP BY 1)"


def fold(d: str) -> str:
    return f"dayofyear(make_date(2001::BIGINT, month({d}), CASE WHEN month({d}) = 2 AND day({d}) = 29 THEN 28 ELSE day({d}) END))"


def near(a: str, b: str, half: int = 7) -> str:
    return f"least(abs({a} - {b}), 365 - abs({a} - {b})) <= {half}"
