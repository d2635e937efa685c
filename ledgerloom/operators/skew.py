"""Per-key results that a few huge keys cannot unbalance.

Rows are first compressed to (key, value, frequency): a grouping on key *and* value, which Spark combines map-side
and spreads over all tasks however large a key is. Everything per key is then exact arithmetic on weighted values:

* counts, sums, distinct counts and modes are ordinary aggregates, combined map-side again;
* percentiles go in two steps. Values fall into order-preserving buckets of their first three significant digits; a
  key has a few thousand of them at most, so the bucket that holds the wanted rank is found from bucket weights
  alone. Only that bucket's distinct values are then ranked.

Defined results: null keys form a group of their own; null values count as rows, not as values; percentiles are the
smallest value whose cumulative share reaches p; of equally frequent values the smallest is the mode; a key with only
null values has null mode and percentiles; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compress(df: DataFrame, key: str, value: str) -> DataFrame:
    """(k, v, n): how often each value occurs under each key."""
    return df.select(F.col(key).alias("k"), F.col(value).alias("v")).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))


def value_bucket(v: Column) -> Column:
    """The value cut down to three significant digits towards minus infinity: monotone in ``v``."""
    d = v.cast("double")
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(d))) - 2)
    return F.when(d == 0, F.lit(0.0)).otherwise(F.floor(d / scale) * scale)


def frequency_summary(weighted: DataFrame, numeric: bool = True) -> DataFrame:
    """Per key: rows, non-null values, distinct values, mode and (``numeric``) total."""
    has = F.col("v").isNotNull()
    aggs = [
        F.sum("n").alias("n_rows"),
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("n_values"),
        F.count(F.when(has, 1)).alias("n_distinct"),
        F.min(F.when(has, F.struct((-F.col("n")).alias("a"), F.col("v").alias("b")))).getField("b").alias("mode"),
    ]
    if numeric:
        aggs.append(F.sum(F.col("v").cast("decimal(20,2)") * F.col("n")).cast("decimal(28,2)").alias("total"))
    return weighted.groupBy("k").agg(*aggs)


def weighted_percentiles(weighted: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(k, p50, ...): exact discrete percentiles of the weighted values of each key."""
    values = weighted.where("v IS NOT NULL").withColumn("b", value_bucket(F.col("v")))
    buckets = values.groupBy("k", "b").agg(F.sum("n").alias("w"))
    up_to = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("k")
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    rank = F.greatest(F.ceil(F.col("total") * F.col("p") - F.lit(1e-9)), F.lit(1)).cast("long")
    targets = (
        buckets.select("k", "b", "w", F.sum("w").over(up_to).alias("upto"), F.sum("w").over(whole).alias("total"))
        .select("*", wanted)
        .withColumn("rank", rank)
        .where("upto - w < rank AND rank <= upto")
        .select("k", "b", "p", (F.col("rank") - F.col("upto") + F.col("w")).alias("rest"))
    )
    inside = values.alias("x").join(
        targets.alias("t"), F.col("x.k").eqNullSafe(F.col("t.k")) & (F.col("x.b") == F.col("t.b"))
    )
    run = Window.partitionBy("k", "b", "p").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = (
        inside.select("x.k", "x.b", "x.v", "x.n", "t.p", "t.rest")
        .withColumn("run", F.sum("n").over(run))
        .where("run >= rest")
        .groupBy("k", "p")
        .agg(F.min("v").alias("v"))
    )
    return picked.groupBy("k").agg(
        *[F.max(F.when(F.col("p") == float(p), F.col("v"))).alias(f"p{round(p * 100)}") for p in probabilities]
    )


def key_profile(df: DataFrame, key: str, value: str, members: str, probabilities: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Per ``key``: rows, total, mode and percentiles of ``value``, distinct ``members`` and the most frequent of them."""
    amounts = compress(df, key, value)
    people = frequency_summary(compress(df, key, members), numeric=False)
    base, ranked = frequency_summary(amounts), weighted_percentiles(amounts, probabilities)
    out = base.alias("a").join(ranked.alias("r"), F.col("a.k").eqNullSafe(F.col("r.k")), "left")
    out = out.join(people.alias("m"), F.col("a.k").eqNullSafe(F.col("m.k")), "left")
    return out.select(
        F.col("a.k").alias(key),
        "a.n_rows",
        F.col("a.total").alias("total_amount"),
        F.col("a.n_distinct").alias("distinct_amounts"),
        F.col("a.mode").alias("mode_amount"),
        *[F.col(f"r.p{round(p * 100)}").alias(f"p{round(p * 100)}_amount") for p in probabilities],
        F.col("m.n_distinct").alias("distinct_members"),
        F.col("m.mode").alias("top_member"),
    )
