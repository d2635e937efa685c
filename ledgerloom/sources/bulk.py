"""Federal bulk files: bars between fields, no header line, names in a separate header file. Everything is read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import parse, text

#: Column names of the bulk files and of the tables they load.
CONTRIBUTION = {
    "CMTE_ID": "committee_id", "AMNDT_IND": "amendment_indicator", "RPT_TP": "report_type", "TRANSACTION_PGI": "election_type",
    "IMAGE_NUM": "image_number", "TRANSACTION_TP": "receipt_type", "ENTITY_TP": "entity_type", "NAME": "contributor_name",
    "CITY": "contributor_city", "STATE": "contributor_state", "ZIP_CODE": "contributor_zip", "EMPLOYER": "contributor_employer",
    "OCCUPATION": "contributor_occupation", "TRANSACTION_DT": "contribution_receipt_date", "TRANSACTION_AMT": "contribution_receipt_amount",
    "OTHER_ID": "other_id", "CAND_ID": "candidate_id", "TRAN_ID": "transaction_id", "FILE_NUM": "file_number", "MEMO_CD": "memo_code",
    "MEMO_TEXT": "memo_text", "SUB_ID": "sub_id",
}
COMMITTEE = {
    "CMTE_ID": "committee_id", "CMTE_NM": "name", "TRES_NM": "treasurer_name", "CMTE_ST1": "street_1", "CMTE_ST2": "street_2", "CMTE_CITY": "city",
    "CMTE_ST": "state", "CMTE_ZIP": "zip", "CMTE_DSGN": "designation", "CMTE_TP": "committee_type", "CMTE_PTY_AFFILIATION": "party",
    "CMTE_FILING_FREQ": "filing_frequency", "ORG_TP": "organization_type",
}
CANDIDATE = {
    "CAND_ID": "candidate_id", "CAND_NAME": "name", "CAND_PTY_AFFILIATION": "party", "CAND_OFFICE_ST": "state", "CAND_OFFICE": "office",
    "CAND_OFFICE_DISTRICT": "district", "CAND_ICI": "incumbent_challenge", "CAND_STATUS": "candidate_status", "CAND_ST1": "address_street_1",
    "CAND_ST2": "address_street_2", "CAND_CITY": "address_city", "CAND_ST": "address_state", "CAND_ZIP": "address_zip",
}


def header_names(spark: SparkSession, header_file: str) -> list[str]:
    return [c.strip() for c in spark.read.text(header_file).first()[0].split(",")]


def scan(spark: SparkSession, path: str | list[str], header_file: str) -> DataFrame:
    """All columns as text; leading zeros stay, quotes inside quotes are doubled, words for "null" become null."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header_names(spark, header_file)])
    raw = spark.read.schema(schema).option("sep", "|").option("quote", '"').option("escape", '"').csv(path)
    return raw.select(*[text.csv_null(F.col(c)).alias(c) for c in raw.columns])


def _mapped(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(k).alias(v) for k, v in names.items() if k in df.columns])


def present(spark: SparkSession, files: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Those (path, header file) pairs that are both there; the others are passed over."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path

    def there(path: str) -> bool:
        at = hadoop(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    return [(p, h) for p, h in files if there(p) and there(h)]


def contributions(spark: SparkSession, files: list[tuple[str, str]], cycle: int) -> DataFrame:
    """Union of the contribution files (path, header file), cleaned and typed."""
    parts = [_mapped(scan(spark, p, h), CONTRIBUTION) for p, h in present(spark, files)]
    if not parts:
        raise FileNotFoundError(str(files))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    typed = {
        "contribution_receipt_date": parse.bulk_date(F.col("contribution_receipt_date")),
        "contribution_receipt_amount": parse.amount(F.col("contribution_receipt_amount")),
        "contributor_zip": parse.zip5_strict(F.col("contributor_zip")),
        "contributor_state": F.upper("contributor_state"),
        "contributor_name": text.bulk_text(F.col("contributor_name")),
        "is_individual": F.col("entity_type") == "IND",
        "two_year_transaction_period": F.lit(cycle),
    }
    return df.withColumns(typed)


def committees(spark: SparkSession, path: str, header_file: str, cycle: int) -> DataFrame:
    return _mapped(scan(spark, path, header_file), COMMITTEE).withColumn("zip", parse.zip5_strict(F.col("zip"))).withColumn("cycles", F.array(F.lit(cycle)))


def candidates(spark: SparkSession, path: str, header_file: str, cycle: int) -> DataFrame:
    number = F.col("district").try_cast("double").try_cast("int")
    return (
        _mapped(scan(spark, path, header_file), CANDIDATE)
        .withColumn("district", F.lpad(number.cast("string"), 2, "0"))
        .withColumn("cycles", F.array(F.lit(cycle)))
    )


def paths(root: str, cycle: int) -> dict[str, tuple[str, str]]:
    """(file, header file) of each kind below ``root`` for an election cycle."""
    yy = f"{cycle % 100:02d}"
    names = {"committees": ("cm.txt", "cm"), "candidates": ("cn.txt", "cn"), "individual": (f"indiv{yy}/itcont.txt", "indiv"), "to_candidates": ("itpas2.txt", "pas2"), "other": ("itoth.txt", "oth")}
    return {k: (f"{root}/{cycle}/{f}", f"{root}/{cycle}/{h}_header_file.csv") for k, (f, h) in names.items()}
