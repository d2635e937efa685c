"""Queries of the general data problems: orphan references, skewed keys, rows that fail to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import quarantine as Q
from ledgerloom.operators import references as R
from ledgerloom.operators import skew as S
from ledgerloom.session import table
from ledgerloom.sources.state_csv import CONTRIBUTION

SILVER_REFS = [R.Reference("silver_md_contribution", "committee_ccf_id", "bronze_md_committee", "ccf_id")]
GOLD_REFS = [
    R.Reference("gold_contribution", "recipient_committee_id", "gold_committee", "id"),
    R.Reference("gold_contribution", "recipient_candidate_id", "gold_candidate", "id"),
]


def _reference_rows(spark: SparkSession, d: str) -> DataFrame:
    month = F.date_format("contribution_date", "yyyy-MM")
    silver = R.reference_rows(table(spark, d, "silver_md_contribution"), SILVER_REFS, "id", "created_at", month)
    gold = R.reference_rows(table(spark, d, "gold_contribution"), GOLD_REFS, "id", "created_at", month)
    return silver.unionByName(gold)


def reference_state(spark: SparkSession, d: str) -> DataFrame:
    existence = [R.existence_deltas(table(spark, d, r.target), r, "created_at") for r in SILVER_REFS + GOLD_REFS]
    return R.apply_deltas(None, R.reference_deltas(_reference_rows(spark, d)), *existence)


def p5_orphans(spark: SparkSession, d: str) -> DataFrame:
    return R.orphan_rows(_reference_rows(spark, d), reference_state(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_orphans(spark, d).select("table_name", "column_name", "row_id", "kind")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return R.orphan_report(p5_orphans(spark, d))


def p5_orphan_keys(spark: SparkSession, d: str) -> DataFrame:
    return R.orphan_keys(reference_state(spark, d)).select("domain", "ref_key", "refs")


def p6_committee_profile(spark: SparkSession, d: str) -> DataFrame:
    return S.key_profile(table(spark, d, "gold_contribution"), "recipient_committee_id", "amount", "contributor_id")


def p6_contributor_profile(spark: SparkSession, d: str) -> DataFrame:
    return S.key_profile(table(spark, d, "gold_contribution"), "contributor_id", "amount", "recipient_committee_id")


def _p7_lines(spark: SparkSession, d: str) -> DataFrame:
    return Q.parse_lines(table(spark, d, "md_contribution_raw").where("line_no <> 1"), "raw_id", "line")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    bronze = table(spark, d, "bronze_md_contribution").select(
        F.col("id").alias("row_id"), F.col("contribution_date").alias("date_text"), F.col("contribution_amount").alias("amount_text")
    )
    lines = _p7_lines(spark, d)
    cells = Q.cells(bronze, "bronze_md_contribution", "date_text", "amount_text").unionByName(
        Q.cells(lines, "md_contribution_raw", "date_text", "amount_text")
    )
    broken = lines.where("structure IS NOT NULL").select(
        F.lit("md_contribution_raw").alias("table_name"), "row_id", F.col("structure").alias("reason")
    )
    return Q.failures(cells, broken)


def p7_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The valid lines with typed date and amount; ``p7_loaded_rows`` has all their fields."""
    lines = _p7_lines(spark, d)
    failed = Q.failures(
        Q.cells(lines, "md_contribution_raw", "date_text", "amount_text"),
        lines.where("structure IS NOT NULL").select(
            F.lit("md_contribution_raw").alias("table_name"), "row_id", F.col("structure").alias("reason")
        ),
    )
    date, amount = Q.strip(F.col("date_text")), F.nullif(Q.strip(F.col("amount_text")), F.lit(""))
    return Q.valid_rows(lines, failed, "row_id").select(
        F.col("row_id").alias("raw_id"),
        F.try_to_timestamp(date, F.lit("M/d/yyyy")).cast("date").alias("contribution_date"),
        amount.try_cast("decimal(12,2)").alias("contribution_amount"),
    )


def p7_loaded_rows(spark: SparkSession, d: str) -> DataFrame:
    """The valid rows of both tables, whole: all twelve fields, texts as they came, date and amount typed."""
    columns = list(CONTRIBUTION.values())
    lines = _p7_lines(spark, d)
    read = lines.where("structure IS NULL").select(
        F.lit("md_contribution_raw").alias("table_name"), "row_id", *[F.col("fields")[k].alias(c) for k, c in enumerate(columns)]
    )
    bronze = table(spark, d, "bronze_md_contribution").select(F.lit("bronze_md_contribution").alias("table_name"), F.col("id").alias("row_id"), *columns)
    loaded = []
    for name, rows in (("md_contribution_raw", read), ("bronze_md_contribution", bronze)):
        cells = Q.cells(rows, name, "contribution_date", "contribution_amount")
        failed = cells.join(Q.bad_values(cells), ["kind", "value"])
        loaded.append(Q.valid_rows(rows, failed, "row_id"))
    date = F.nullif(Q.strip(F.col("contribution_date")), F.lit(""))
    amount = F.nullif(Q.strip(F.col("contribution_amount")), F.lit(""))
    return loaded[0].unionByName(loaded[1]).select("table_name", "row_id", *columns).withColumns(
        {"contribution_date": F.try_to_timestamp(date, F.lit("M/d/yyyy")).cast("date"), "contribution_amount": amount.try_cast("decimal(12,2)")}
    )


QUERIES = {
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p5_orphan_keys": p5_orphan_keys,
    "p6_committee_profile": p6_committee_profile,
    "p6_contributor_profile": p6_contributor_profile,
    "p7_found": p7_found,
    "p7_loaded": p7_loaded,
    "p7_loaded_rows": p7_loaded_rows,
}

_REF_ROWS = """
    SELECT 'silver_md_contribution' AS table_name, 'committee_ccf_id' AS column_name, id AS row_id,
           trim(committee_ccf_id) AS ref_key, created_at, strftime(contribution_date, '%Y-%m') AS period
    FROM silver_md_contribution WHERE committee_ccf_id IS NOT NULL
    UNION ALL
    SELECT 'gold_contribution', 'recipient_committee_id', id, CAST(recipient_committee_id AS VARCHAR), created_at,
           strftime(contribution_date, '%Y-%m') FROM gold_contribution WHERE recipient_committee_id IS NOT NULL
    UNION ALL
    SELECT 'gold_contribution', 'recipient_candidate_id', id, CAST(recipient_candidate_id AS VARCHAR), created_at,
           strftime(contribution_date, '%Y-%m') FROM gold_contribution WHERE recipient_candidate_id IS NOT NULL
"""
_TARGETS = """
    SELECT 'committee_ccf_id' AS column_name, trim(ccf_id) AS ref_key, min(created_at) AS at FROM bronze_md_committee
    WHERE ccf_id IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT 'recipient_committee_id', CAST(id AS VARCHAR), min(created_at) FROM gold_committee WHERE id IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT 'recipient_candidate_id', CAST(id AS VARCHAR), min(created_at) FROM gold_candidate WHERE id IS NOT NULL GROUP BY ALL
"""
_ORPHANS = f"""
    WITH r AS ({_REF_ROWS}), t AS ({_TARGETS}),
    o AS (SELECT r.*, CASE WHEN t.at IS NULL THEN 'missing' WHEN t.at > r.created_at THEN 'late' END AS kind
          FROM r LEFT JOIN t USING (column_name, ref_key))
"""


def _profile_sql(key: str, member: str) -> str:
    return f"""
    WITH f AS (SELECT {key} AS k, amount AS v, {member} AS m FROM gold_contribution),
    a AS (SELECT k, count(*) AS n_rows, CAST(sum(v) AS DECIMAL(28,2)) AS total_amount, count(DISTINCT v) AS distinct_amounts,
                 quantile_disc(v, 0.5) AS p50_amount, quantile_disc(v, 0.9) AS p90_amount, count(DISTINCT m) AS distinct_members
          FROM f GROUP BY k),
    va AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, v) AS rn FROM f WHERE v IS NOT NULL GROUP BY k, v),
    ma AS (SELECT k, m, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, m) AS rn FROM f WHERE m IS NOT NULL GROUP BY k, m)
    SELECT a.k AS {key}, n_rows, total_amount, distinct_amounts, va.v AS mode_amount, p50_amount, p90_amount,
           distinct_members, ma.m AS top_member
    FROM a LEFT JOIN va ON va.k IS NOT DISTINCT FROM a.k AND va.rn = 1
           LEFT JOIN ma ON ma.k IS NOT DISTINCT FROM a.k AND ma.rn = 1
    """


_BAD_AMOUNT = r"NOT regexp_full_match(trim({0}), '-?[0-9]{{1,10}}(\.[0-9]{{1,2}})?')"
_BAD_DATE = r"(NOT regexp_full_match(trim({0}), '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') OR try_strptime(trim({0}), '%m/%d/%Y') IS NULL)"
_CELL = r"""'(?:"(?:[^"]|"")*"|[^",][^,]*|)(?:,|$)'"""
_LINES = rf"""
    WITH l AS (SELECT raw_id, line, NOT regexp_full_match(line, '(?:(?:"(?:[^"]|"")*"|[^",][^,]*|),)*(?:"(?:[^"]|"")*"|[^",][^,]*|)') AS bad
               FROM md_contribution_raw WHERE line_no <> 1 AND line IS NOT NULL),
    c AS (SELECT raw_id, bad, regexp_extract_all(line || ',', '((?:"(?:[^"]|"")*"|[^",][^,]*|)),', 1) AS f FROM l),
    s AS (SELECT raw_id, CASE WHEN bad THEN 'quoting'
                 WHEN NOT (len(f) = 12 OR (len(f) = 13 AND f[13] IN ('', '""'))) THEN 'columns' END AS structure, f FROM c),
    u AS (SELECT raw_id, CASE WHEN f[3] LIKE '"%' THEN replace(substr(f[3], 2, len(f[3]) - 2), '""', '"') ELSE f[3] END AS dt,
                 CASE WHEN f[8] LIKE '"%' THEN replace(substr(f[8], 2, len(f[8]) - 2), '""', '"') ELSE f[8] END AS am
          FROM s WHERE structure IS NULL)
"""

SQL = {
    "p5_found": _ORPHANS + "SELECT table_name, column_name, row_id, kind FROM o WHERE kind IS NOT NULL",
    "p5_report": _ORPHANS
    + """SELECT table_name, column_name, period, kind, count(*) AS n_rows, count(DISTINCT ref_key) AS n_keys
         FROM o WHERE kind IS NOT NULL GROUP BY ALL""",
    "p5_orphan_keys": _ORPHANS
    + "SELECT table_name || '.' || column_name AS domain, ref_key, count(*) AS refs FROM o WHERE kind = 'missing' GROUP BY ALL",
    "p6_committee_profile": _profile_sql("recipient_committee_id", "contributor_id"),
    "p6_contributor_profile": _profile_sql("contributor_id", "recipient_committee_id"),
    "p7_found": _LINES
    + f"""
    SELECT 'md_contribution_raw' AS table_name, raw_id AS row_id, structure AS reason FROM s WHERE structure IS NOT NULL
    UNION ALL SELECT 'md_contribution_raw', raw_id, 'date' FROM u WHERE trim(dt) <> '' AND {_BAD_DATE.format("dt")}
    UNION ALL SELECT 'md_contribution_raw', raw_id, 'amount' FROM u WHERE trim(am) <> '' AND {_BAD_AMOUNT.format("am")}
    UNION ALL SELECT 'bronze_md_contribution', id, 'date' FROM bronze_md_contribution
      WHERE trim(contribution_date) <> '' AND {_BAD_DATE.format("contribution_date")}
    UNION ALL SELECT 'bronze_md_contribution', id, 'amount' FROM bronze_md_contribution
      WHERE trim(contribution_amount) <> '' AND {_BAD_AMOUNT.format("contribution_amount")}
    """,
    "p7_loaded": _LINES
    + f"""
    SELECT raw_id, CAST(try_strptime(trim(dt), '%m/%d/%Y') AS DATE) AS contribution_date,
           TRY_CAST(nullif(trim(am), '') AS DECIMAL(12,2)) AS contribution_amount
    FROM u WHERE NOT coalesce(trim(dt) <> '' AND {_BAD_DATE.format("dt")}, false)
      AND NOT coalesce(trim(am) <> '' AND {_BAD_AMOUNT.format("am")}, false)
    """,
}
