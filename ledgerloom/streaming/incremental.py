"""Incremental processing: high-water marks, look-back, and streaming runs that only see new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def extraction_state(fact: DataFrame, key: tuple[str, ...] = ("recipient_committee_id", "election_cycle")) -> DataFrame:
    """Latest (date, sub id) and row count per key, in one aggregation."""
    last = F.max(F.struct("contribution_date", "source_sub_id"))
    g = fact.groupBy(*key).agg(last.alias("m"), F.count(F.lit(1)).alias("n"))
    return g.select(*key, F.col("m.contribution_date").alias("last_date"), F.col("m.source_sub_id").alias("last_sub_id"), "n")


def merge_state(old: DataFrame, read: DataFrame, key: tuple[str, ...] = ("recipient_committee_id", "election_cycle")) -> DataFrame:
    """The state after rows ``read`` once more from a look-back on: only rows beyond a key's high-water mark are new and count."""
    mark = old.select(*key, F.struct("last_date", "last_sub_id").alias("mark"))
    beyond = read.join(mark, list(key), "left").where(F.col("mark").isNull() | (F.struct("contribution_date", "source_sub_id") > F.col("mark")))
    both = old.unionByName(extraction_state(beyond, key)).groupBy(*key)
    merged = both.agg(F.max(F.struct("last_date", "last_sub_id")).alias("m"), F.sum("n").alias("n"))
    return merged.select(*key, "m.last_date", "m.last_sub_id", "n")


def rebuild_state(fact: DataFrame, key: tuple[str, ...] = ("recipient_committee_id", "election_cycle")) -> DataFrame:
    """The state of a whole table, as if it had been read from the start."""
    return extraction_state(fact, key)


def reconcile(target: DataFrame, source: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """A full comparison: (the source rows that ``target`` lacks, once a key; counts of both sides, missing and surplus keys)."""
    from ledgerloom.operators.tables import new_rows, once_per_key

    missing = once_per_key(new_rows(source, target, key), key)
    sides = source.select(*key, F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(target.select(*key, F.lit(0).alias("s"), F.lit(1).alias("t")))
    per_key = sides.groupBy(*key).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    counts = per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("n_source"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_target"),
        F.count_if(F.col("t") == 0).alias("missing_keys"), F.count_if(F.col("s") == 0).alias("surplus_keys"),
    )
    return missing, counts


def start_dates(state: DataFrame, lookback_days: int | None = 1, key: tuple[str, ...] = ("recipient_committee_id", "election_cycle")) -> DataFrame:
    """Where to start reading again; 0 days is a valid look-back, None means the default of one."""
    days = 1 if lookback_days is None else lookback_days
    return state.select(*key, F.date_sub("last_date", days).alias("start_date"))


def window_rows(source: DataFrame, state: DataFrame, lookback_days: int, key: tuple[str, ...] = ("recipient_committee_id", "election_cycle")) -> DataFrame:
    """Rows at or after their key's start date; all rows of keys without a state."""
    starts = start_dates(state, lookback_days, key)
    return source.join(starts, list(key), "left").where("start_date IS NULL OR contribution_date >= start_date").drop("start_date")


def run_new_files(spark: SparkSession, schema: str, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Every Parquet file below ``folder`` handled once, then the run ends; a second run sees only files that came since."""
    stream = spark.readStream.schema(schema).parquet(folder)
    run = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return run


def deduplicated(stream: DataFrame, key: list[str], event_time: str, late: str) -> DataFrame:
    """Each key once; a repeat that comes within ``late`` of the first is dropped, and the state of older keys is given up."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(key)


def hourly_counts(events: DataFrame, late: str | None = None) -> DataFrame:
    """Events per hour and type; with ``late`` a watermark, for streams."""
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour"), "event_type", "n")
