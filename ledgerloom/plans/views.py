"""Serving aggregates over the contribution fact, earmark reconciliation and top lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def earmark_filter() -> Column:
    """Rows that count once: all but federal receipts, their pass-through halves and memos that say so."""
    memo = F.upper(F.coalesce("memo_text", F.lit("")))
    tid = F.coalesce("source_transaction_id", F.lit(""))
    direct = ~F.coalesce("is_earmark_receipt", F.lit(False)) & ~tid.endswith("E")
    said = memo.contains("EARMARK") | memo.contains("CONDUIT") | memo.contains("ATTRIBUTION BELOW")
    return (F.col("source_system") != "FEC") | (direct & ~said)


def counted(fact: DataFrame) -> DataFrame:
    return fact.where(earmark_filter())


def _money() -> list[Column]:
    return [F.count(F.lit(1)).alias("n_contributions"), F.sum("amount").cast(MONEY).alias("total_amount")]


def _average(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_amount", F.col("total_amount").cast("double") / F.col("n_contributions"))


def contributor_stats(fact: DataFrame) -> DataFrame:
    days = [F.min("contribution_date").alias("first_date"), F.max("contribution_date").alias("last_date")]
    g = counted(fact).groupBy("contributor_id")
    return _average(g.agg(*_money(), F.countDistinct("recipient_committee_id").alias("n_committees"), *days))


def committee_stats(fact: DataFrame) -> DataFrame:
    g = counted(fact).groupBy("recipient_committee_id")
    return _average(g.agg(*_money(), F.countDistinct("contributor_id").alias("n_contributors")))


def contributor_committee_stats(fact: DataFrame) -> DataFrame:
    days = [F.min("contribution_date").alias("first_date"), F.max("contribution_date").alias("last_date")]
    return counted(fact).groupBy("contributor_id", "recipient_committee_id").agg(*_money(), *days)


def with_candidate(fact: DataFrame, committees: DataFrame) -> DataFrame:
    """The fact with candidate_id: its own, else its committee's."""
    c = committees.select(F.col("id").alias("recipient_committee_id"), F.col("candidate_id").alias("linked"))
    return fact.join(c, "recipient_committee_id", "left").withColumn("candidate_id", F.coalesce("recipient_candidate_id", "linked"))


def candidate_stats(fact: DataFrame, committees: DataFrame) -> DataFrame:
    g = with_candidate(counted(fact), committees).where("candidate_id IS NOT NULL").groupBy("candidate_id")
    return _average(g.agg(*_money(), F.countDistinct("contributor_id").alias("n_contributors")))


def contributor_candidate_stats(fact: DataFrame, committees: DataFrame) -> DataFrame:
    days = [F.min("contribution_date").alias("first_date"), F.max("contribution_date").alias("last_date")]
    return with_candidate(counted(fact), committees).where("candidate_id IS NOT NULL").groupBy("contributor_id", "candidate_id").agg(*_money(), *days)


def mark_receipts(fact: DataFrame) -> DataFrame:
    """is_earmark_receipt where another row of the source has this transaction id with an E behind it.

    Rows without an id cannot pair and stay out of the join, as they would all fall into one task.
    """
    has = F.col("source_transaction_id").isNotNull()
    pair = fact.where(F.col("source_transaction_id").endswith("E")).select("source_system", F.col("source_transaction_id").alias("paired")).distinct()
    keyed = fact.where(has).withColumn("paired", F.concat("source_transaction_id", F.lit("E")))
    marked = keyed.join(pair.withColumn("hit", F.lit(True)), ["source_system", "paired"], "left")
    marked = marked.withColumn("is_earmark_receipt", F.coalesce("hit", F.lit(False))).drop("paired", "hit")
    return marked.unionByName(fact.where(~has).withColumn("is_earmark_receipt", F.lit(False)))


def assign_conduits(fact: DataFrame) -> DataFrame:
    """conduit_committee_id of pass-through rows: the committee of the receipt, the smallest if there are several."""
    has = F.col("source_transaction_id").isNotNull()
    receipts = (
        mark_receipts(fact.where(has)).where("is_earmark_receipt")
        .groupBy("source_system", F.concat("source_transaction_id", F.lit("E")).alias("source_transaction_id"))
        .agg(F.min("recipient_committee_id").alias("conduit"))
    )
    out = fact.where(has).join(receipts, ["source_system", "source_transaction_id"], "left")
    out = out.withColumn("conduit_committee_id", F.coalesce("conduit_committee_id", "conduit")).drop("conduit")
    return out.unionByName(fact.where(~has))


def federal_direct(fact: DataFrame) -> DataFrame:
    """The older rule: federal rows whose transaction id is given and does not end in E."""
    return fact.where("source_system = 'FEC'").where(~F.col("source_transaction_id").endswith("E"))


def legacy_stats(fact: DataFrame, keys: list[str]) -> DataFrame:
    """The older serving views: counts and totals of :func:`federal_direct` rows by ``keys``, null keys left out."""
    rows = federal_direct(fact)
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(*_money())


def write_ranked(view: DataFrame, path: str, by: str, measure: str = "total_amount") -> None:
    """A serving view laid out for ranked pages: range-partitioned by ``by``, sorted within by ``measure``, largest first, so
    a page of one key reads a few row groups in order."""
    order = [F.col(by).asc_nulls_last(), F.col(measure).desc_nulls_last()]
    view.repartitionByRange(F.col(by).asc_nulls_last()).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def ranked_page(view: DataFrame, by: str, value: object, n: int, measure: str = "total_amount", tie: str | None = None) -> DataFrame:
    """The ``n`` largest rows of one key; the filter reaches the scan."""
    order = [F.col(measure).desc_nulls_last(), *([F.col(tie)] if tie else [])]
    return view.where(F.col(by) == F.lit(value)).orderBy(*order).limit(n)


def top_recipients(fact: DataFrame, committees: DataFrame, k: int = 10) -> DataFrame:
    totals = fact.groupBy("recipient_committee_id").agg(*_money())
    named = totals.join(committees.select(F.col("id").alias("recipient_committee_id"), "name"), "recipient_committee_id")
    return named.orderBy(F.col("total_amount").desc(), "recipient_committee_id").limit(k)


def totals_by_type(fact: DataFrame, k: int = 10) -> DataFrame:
    return fact.groupBy("contribution_type").agg(*_money()).orderBy(F.col("total_amount").desc(), F.col("contribution_type").asc_nulls_last()).limit(k)


def refresh(views: dict[str, Callable[[], DataFrame]], root: str) -> dict[str, str]:
    """Each view written as a new version; one that fails does not stop the others. Returns a status per view, with the
    error's text; if all fail the last error is raised."""
    from ledgerloom.operators.tables import VersionedTable

    status, failed = {}, None
    for name, build in views.items():
        try:
            df = build()
            VersionedTable(df.sparkSession, f"{root}/{name}").write(df)
            status[name] = "refreshed"
        except Exception as error:  # noqa: BLE001
            status[name], failed = f"failed: {type(error).__name__}" + (f": {error}" if str(error) else ""), error
    if failed is not None and all(v != "refreshed" for v in status.values()):
        raise failed
    return status
