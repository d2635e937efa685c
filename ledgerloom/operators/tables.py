"""Keyed tables on Parquet: first-by-key, merge, insert-if-absent, deletes, surrogate ids, versioned writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row a key: the first in ``order``, which should be total."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def new_rows(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    return source.join(target.select(*key).distinct(), list(key), "left_anti")


def once_per_key(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The source's first row of each key, in the order of all its columns (nulls last), so repeats change nothing."""
    order = [F.col(c).asc_nulls_last() for c in sorted(source.columns) if c not in key]
    return first_by_key(source, key, order or [F.lit(1)])


def insert_if_absent(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` and the source rows of keys it lacks, each key once."""
    return target.unionByName(once_per_key(new_rows(source, target, key), key), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], update: Sequence[str], keep_old_on_null: bool = True) -> DataFrame:
    """``target`` with ``update`` columns taken from matching source rows, and with the source rows that match nothing.

    A null in the source leaves the old value unless ``keep_old_on_null`` is off. Of source rows that repeat a key the first
    counts (:func:`once_per_key`).
    """
    source = once_per_key(source, key)
    s = source.select(*key, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit"))
    joined = target.join(s, list(key), "left")

    def value(c: str) -> Column:
        if c not in update:
            return F.col(c)
        new = F.coalesce(F.col(f"_new_{c}"), F.col(c)) if keep_old_on_null else F.col(f"_new_{c}")
        return F.when(F.col("_hit"), new).otherwise(F.col(c)).alias(c)

    changed = joined.select(*[value(c) for c in target.columns])
    return changed.unionByName(new_rows(source, target, key), allowMissingColumns=True)


def delete_where_in(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).distinct(), key, "left_anti")


def with_new_ids(new: DataFrame, taken: DataFrame, natural: Sequence[str], id_col: str = "id") -> DataFrame:
    """Ids above every taken one, in order of the natural key.

    Rows are numbered within range partitions of the key, and each partition starts after the sizes of those before it,
    so no task sees all rows. The partition sizes (one number a partition) are the only thing that is gathered.
    """
    from ledgerloom.session import cut

    parts = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(new.repartitionByRange(parts, *natural).withColumn("_p", F.spark_partition_id()))
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    top = taken.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]
    number = F.row_number().over(Window.partitionBy("_p").orderBy(*natural))
    return placed.withColumn("_n", number).join(F.broadcast(offsets), "_p").withColumn(id_col, F.lit(top) + F.col("_off") + F.col("_n")).drop("_p", "_n", "_off")


def keyset_page(df: DataFrame, key: str, after: object, n: int) -> DataFrame:
    return df.where(F.col(key) > F.lit(after)).orderBy(key).limit(n)


def with_lineage(df: DataFrame, source_system: str) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({"created_at": now, "updated_at": now, "source_system": F.lit(source_system), "ingestion_timestamp": now})


def project_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


class VersionedTable:
    """A table as versions in one folder with numbered pointers to them; the highest number is the current one.

    A write never touches what is being read: it adds a version and then, in one rename, a pointer to it. Whoever reads or
    crashes in between sees the version before. A pointer number that another writer took meanwhile makes the write fail.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _pointers(self) -> list[int]:
        at = self._path(f"{self.root}/pointers")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n) for n in names if n.isdigit())

    def current(self) -> str | None:
        numbers = self._pointers()
        return self.spark.read.text(f"{self.root}/pointers/{numbers[-1]}").first()[0] if numbers else None

    def read(self) -> DataFrame:
        version = self.current()
        if version is None:
            raise FileNotFoundError(self.root)
        return self.spark.read.parquet(f"{self.root}/{version}")

    def write(self, df: DataFrame) -> str:
        numbers, version = self._pointers(), f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{version}")
        fresh = self._path(f"{self.root}/fresh-{version}")
        self.spark.createDataFrame([(version,)], "value string").coalesce(1).write.text(fresh.toString())
        self._fs.mkdirs(self._path(f"{self.root}/pointers"))
        target = self._path(f"{self.root}/pointers/{numbers[-1] + 1 if numbers else 1}")
        if self._fs.exists(target) or not self._fs.rename(fresh, target):
            raise RuntimeError(f"{self.root} was written meanwhile")
        return version

    def rollback(self) -> str | None:
        """Back to the version before the current one, which stays on disk; returns what is current then."""
        numbers = self._pointers()
        if numbers:
            self._fs.delete(self._path(f"{self.root}/pointers/{numbers[-1]}"), True)
        return self.current()
