"""Orphan references, kept as signed counts per key.

A *delta* says that something about a key changed: a row that refers to it came (``refs = +1``) or went (``-1``), the
key itself came into being (``exists = +1``) or went (``-1``). Deltas of any number of batches sum up to one state row
a key; the orphans are the keys with positive references and no existence. Applying a batch is one partial
aggregation, so a key that holds a third of all rows is summed up map-side before anything is shuffled.

Defined results: null references are no references; blanks around a key do not matter; an all-blank key is a key that
nothing can have; repeated rows count as often as they come; a key that exists twice lives until both are gone; empty
inputs give an empty state. Columns besides those named are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ["domain", "ref_key", "refs", "existing", "first_seen", "first_ref"]


@dataclass(frozen=True)
class Reference:
    """One foreign key: ``table.column`` refers to ``target.target_key``."""

    table: str
    column: str
    target: str
    target_key: str

    @property
    def domain(self) -> str:
        return f"{self.table}.{self.column}"


def clean_key(key: str) -> Column:
    """A key as text without white space around it."""
    return F.regexp_replace(F.col(key).cast("string"), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def reference_rows(df: DataFrame, refs: Sequence[Reference], row_id: str, created: str, period: Column) -> DataFrame:
    """(domain, table_name, column_name, row_id, ref_key, created_at, period), one row for each non-null reference.

    All references out of one table come from a single scan of it.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(r.domain).alias("domain"),
                F.lit(r.table).alias("table_name"),
                F.lit(r.column).alias("column_name"),
                clean_key(r.column).alias("ref_key"),
            )
            for r in refs
        ]
    )
    rows = df.select(
        F.col(row_id).alias("row_id"), F.col(created).alias("created_at"), period.alias("period"), F.explode(entries).alias("e")
    )
    return rows.select("e.*", "row_id", "created_at", "period").where("ref_key IS NOT NULL")


def reference_deltas(rows: DataFrame, sign: int = 1) -> DataFrame:
    """The change that ``rows`` of :func:`reference_rows` make; ``sign`` -1 takes them back."""
    return rows.groupBy("domain", "ref_key").agg(
        (F.count(F.lit(1)) * sign).alias("refs"),
        F.lit(0).cast("long").alias("existing"),
        F.lit(None).cast("timestamp_ntz").alias("first_seen"),
        F.min(F.col("created_at").cast("timestamp_ntz")).alias("first_ref"),
    )


def existence_deltas(target: DataFrame, ref: Reference, created: str, sign: int = 1) -> DataFrame:
    """The change that rows of the referenced table make."""
    return (
        target.select(clean_key(ref.target_key).alias("ref_key"), F.col(created).cast("timestamp_ntz").alias("at"))
        .where("ref_key IS NOT NULL")
        .groupBy("ref_key")
        .agg((F.count(F.lit(1)) * sign).alias("n"), F.min("at").alias("at"))
        .select(
            F.lit(ref.domain).alias("domain"),
            "ref_key",
            F.lit(0).cast("long").alias("refs"),
            F.col("n").alias("existing"),
            F.col("at").alias("first_seen"),
            F.lit(None).cast("timestamp_ntz").alias("first_ref"),
        )
    )


def apply_deltas(state: DataFrame | None, *deltas: DataFrame) -> DataFrame:
    """The state after ``deltas``; keys whose counts return to nothing leave it."""
    parts = ([state] if state is not None else []) + list(deltas)
    merged = parts[0].select(STATE)
    for part in parts[1:]:
        merged = merged.unionByName(part.select(STATE))
    return (
        merged.groupBy("domain", "ref_key")
        .agg(
            F.sum("refs").alias("refs"),
            F.sum("existing").alias("existing"),
            F.min("first_seen").alias("first_seen"),
            F.min("first_ref").alias("first_ref"),
        )
        .where("refs <> 0 OR existing <> 0")
    )


def orphan_keys(state: DataFrame) -> DataFrame:
    """The current orphan report: keys that are referred to and do not exist."""
    return state.where("refs > 0 AND existing <= 0").select("domain", "ref_key", "refs", "first_ref")


def suspect_keys(state: DataFrame) -> DataFrame:
    """Keys with at least one orphan row: missing ones, and those that came after a row that refers to them."""
    return state.where("refs > 0 AND (existing <= 0 OR first_seen > first_ref)").select(
        "domain", "ref_key", F.when(F.col("existing") > 0, F.col("first_seen")).alias("first_seen")
    )


def orphan_rows(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows behind the orphans, with kind ``missing`` or ``late``.

    Only suspect keys take part in the join: usually few, broadcast if their run-time size allows it and otherwise
    joined by key, where adaptive execution splits a hot one.
    """
    hit = rows.join(suspect_keys(state), ["domain", "ref_key"])
    kind = F.when(F.col("first_seen").isNull(), "missing").when(
        F.col("first_seen") > F.col("created_at").cast("timestamp_ntz"), "late"
    )
    return hit.withColumn("kind", kind).where("kind IS NOT NULL")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan rows and distinct keys per table, column, period and kind; keys are made distinct before they are counted."""
    per_key = orphans.groupBy("table_name", "column_name", "period", "kind", "ref_key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("table_name", "column_name", "period", "kind").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )
