"""Towns and ZIP codes that name the same place, learned from the records that give both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def majority(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the value most records give with a key; of equally frequent ones the smallest."""
    counts = df.where(f"{key} <> '' AND {value} <> ''").groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("a"), F.col(value).alias("b"))).getField("b").alias(value))


def place_keys(df: DataFrame, zip_col: str = "zip", town_col: str = "town") -> DataFrame:
    """``df`` plus ``place``: the ZIP code, else the ZIP code usual with the town, else the town, else ``""``.

    The maps hold a row for each distinct ZIP code or town; Spark broadcasts them only if they are small when it runs.
    """
    towns = majority(df.select(F.col(town_col).alias("town_"), F.col(zip_col).alias("zip_")), "town_", "zip_")
    out = df.join(towns, df[town_col] == F.col("town_"), "left").drop("town_")
    place = F.when(F.col(zip_col) != "", F.col(zip_col)).otherwise(F.coalesce("zip_", F.col(town_col), F.lit("")))
    return out.withColumn("place", place).drop("zip_")
