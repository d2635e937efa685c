"""Sessions, table access and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "ledgerloom", **conf: object) -> SparkSession:
    """A session with the settings the engine relies on: UTC, adaptive execution, Arrow transfer."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k: str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local master may do without the setting."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    global _own_folder
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"file://{_own_folder}"


_own_folder: str | None = None
_tables: dict[str, None] = {}


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back, so its lineage ends there.

    A lost executor costs nothing that was written, and the plans that follow start from true sizes and from no
    inherited constraints (those of a checkpoint grow with every round of a loop). :func:`discard` and
    :func:`release` delete what is no longer read.
    """
    path = f"{shared_folder(df.sparkSession)}/ledgerloom-{uuid.uuid4().hex}"
    _tables[path] = None
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _tables.pop(path, None)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`cut` made and that no frame in use reads any more; other frames are left alone."""
    for df in tables:
        path = getattr(df, "_cut_path", None)
        if path in _tables:
            _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete all tables :func:`cut` made in this process, once the results that read them are written or fetched."""
    for path in list(_tables):
        _delete(spark, path)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as the session's shuffles have: for little data that is much work a row."""
    return df.repartition(shuffle_tasks(df.sparkSession))
