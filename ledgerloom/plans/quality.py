"""Data-quality rules as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(name) for name, c in columns.items()])


def stage_status(stage: str, before: DataFrame, after: DataFrame, most_lost: float = 0.5) -> DataFrame:
    """One row: counts on both sides; error if nothing is left, warning if more than ``most_lost`` is gone."""
    sides = before.select(F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(after.select(F.lit(0).alias("i"), F.lit(1).alias("o")))
    n = sides.agg(F.coalesce(F.sum("i"), F.lit(0)).alias("n_in"), F.coalesce(F.sum("o"), F.lit(0)).alias("n_out"))
    lost = 1 - F.col("n_out") / F.when(F.col("n_in") > 0, F.col("n_in"))
    status = F.when((F.col("n_out") == 0) & (F.col("n_in") > 0), "error").when(lost > most_lost, "warning").otherwise("success")
    return n.select(F.lit(stage).alias("stage"), "n_in", "n_out", status.alias("status"))


def link_status(unresolved: DataFrame, most: float = 0.1, together: bool = False) -> DataFrame:
    """Status of (n, no_contributor, no_committee) rows: no rows or more than ``most`` unresolved is an error, any a warning.

    Federal facts are judged by the worse of the two rates, state facts (``together``) by their sum.
    """
    c, m = F.col("no_contributor"), F.col("no_committee")
    rate = ((c + m) if together else F.greatest(c, m)) / F.when(F.col("n") > 0, F.col("n"))
    return unresolved.withColumn("status", F.when(rate.isNull() | (rate > most), "error").when(rate > 0, "warning").otherwise("success"))


def dedup_status(rates: DataFrame, most: float = 0.5) -> DataFrame:
    """Status of (n, n_once) rows: a warning if more than ``most`` of the rows were repeats."""
    lost = 1 - F.col("n_once") / F.when(F.col("n") > 0, F.col("n"))
    return rates.withColumn("status", F.when(lost > most, "warning").otherwise("success"))


def range_failures(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Rows whose value is there and outside [low, high]."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).between(low, high))


def hash_status(df: DataFrame, column: str) -> DataFrame:
    """One row: hashes that are missing, that are not 64 hexadecimal digits, and that repeat."""
    per = df.groupBy(F.col(column).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    shaped = F.col("h").rlike("^[0-9a-f]{64}$")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return per.agg(n(F.col("h").isNull()).alias("missing"), n(~shaped).alias("malformed"), F.count_if(F.col("h").isNotNull() & (F.col("n") > 1)).alias("repeated"))


def run_summary(parts: dict[str, DataFrame]) -> DataFrame:
    """(part, n) and a row ``total`` over all parts of a run, counted in one pass each."""
    rows = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("part"))
        rows = one if rows is None else rows.unionAll(one)
    return rows.rollup("part").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("part", F.lit("total")).alias("part"), "n")
