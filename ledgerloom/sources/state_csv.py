"""State CSV exports, read as text: contributions, committees and candidates in their three layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import parse, text
from ledgerloom.operators.tables import first_by_key

#: Header texts of the exports and column names of the tables they load.
CONTRIBUTION = {
    "Receiving Committee": "receiving_committee", "Filing Period": "filing_period", "Contribution Date": "contribution_date",
    "Contributor Name": "contributor_name", "Contributor Address": "contributor_address", "Contributor Type": "contributor_type",
    "Contribution Type": "contribution_type", "Contribution Amount": "contribution_amount", "Employer Name": "employer_name",
    "Employer Occupation": "employer_occupation", "Office": "office", "Fundtype": "fund_type",
}
COMMITTEE = {
    "Committee Type": "committee_type", "CCF ID": "ccf_id", "Committee Name": "committee_name", "Committee Status": "committee_status",
    "Citation Violations": "citation_violations", "Election Type": "election_type", "Registered Date": "registered_date",
    "Amended Date": "amended_date", "Chairperson Name": "chairperson_name", "Chairperson Address": "chairperson_address",
    "Treasurer Name": "treasurer_name", "Treasurer Address": "treasurer_address",
}
CANDIDATE = {
    "Office Name": "office_name", "Contest Run By District Name and Number": "district", "Candidate Ballot Last Name and Suffix": "candidate_last_name",
    "Candidate First Name and Middle Name": "candidate_first_name", "Additional Information": "additional_info", "Office Political Party": "party",
    "Candidate Residential Jurisdiction": "jurisdiction", "Candidate Gender": "gender", "Candidate Status": "status",
    "Filing Type and Date": "filing_type_and_date", "Campaign Mailing Address": "campaign_address",
    "Campaign Mailing City State and Zip": "campaign_city_state_zip", "Public Phone": "phone", "Email": "email", "Website": "website",
    "Facebook": "facebook", "X": "twitter", "Other": "other_social", "Committee Name": "committee_name",
}
LEGACY = {
    2018: ["office_name", "district", "candidate_last_name", "candidate_first_name", "party", "jurisdiction", "status", "filing_type_and_date", "email", "website", "facebook", "twitter", "other_social"],
    2020: ["office_name", "district", "candidate_full_name", "party", "jurisdiction", "status", "filing_type_and_date", "email", "website", "facebook", "twitter", "other_social"],
}
CANDIDATE_KEY = ["office_name", "district", "candidate_last_name", "candidate_first_name", "party", "election_year", "election_type"]


def _named(spark: SparkSession, path: str | list[str], names: dict[str, str], multi_line: bool = False) -> DataFrame:
    """The known columns; with ``multi_line`` quoted fields may hold line ends, but then a file is read by one task."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    return raw.select(*[text.csv_null(F.col(f"`{k}`")).alias(v) for k, v in names.items() if k in raw.columns])


def contributions(spark: SparkSession, path: str | list[str], years: list[int] | None = None, first: str | None = None, last: str | None = None, multi_line: bool = False) -> DataFrame:
    """Contributions once a content hash, of the filing ``years`` and of days between ``first`` and ``last`` (ISO), if given."""
    df = _named(spark, path, CONTRIBUTION, multi_line)
    if years is not None:
        df = df.where(F.regexp_extract(F.coalesce("filing_period", F.lit("")), r"(\d{4})", 1).isin([str(y) for y in years]))
    day = parse.state_date(F.col("contribution_date"))
    df = df.where(day >= F.lit(first).cast("date")) if first else df
    df = df.where(day <= F.lit(last).cast("date")) if last else df
    key = ["receiving_committee", "contribution_date", "contributor_name", "contributor_address", "contribution_amount", "contribution_type"]
    hashed = df.withColumn("content_hash", parse.content_hash(*[F.col(c) for c in key]))
    return first_by_key(hashed, ["content_hash"], sorted(hashed.columns))


def committees(spark: SparkSession, path: str | list[str], status: str | None = None, kind: str | None = None) -> DataFrame:
    """Committees once a register number, of one ``status`` and type (``kind``) if given."""
    df = _named(spark, path, COMMITTEE).where("ccf_id IS NOT NULL")
    df = df.where(F.lower("committee_status") == status.lower()) if status else df
    df = df.where(F.col("committee_type") == kind) if kind else df
    return first_by_key(df, ["ccf_id"], sorted(df.columns))


def election_type(name: F.Column) -> F.Column:
    """Said by a file's name; folders do not matter."""
    low = F.lower(F.substring_index(name, "/", -1))
    return F.when(low.contains("special"), "Special").when(low.contains("general"), "General").otherwise("Primary")


def candidates(spark: SparkSession, path: str, year: int) -> DataFrame:
    """A year's candidates in whichever layout the file has; the layouts without a header are known by year."""
    first = spark.read.text(path).first()
    if first is not None and "Office Name" in first[0]:
        df = _named(spark, path, CANDIDATE)
    elif year in LEGACY:
        cols = LEGACY[year]
        raw = spark.read.option("escape", '"').csv(path)
        df = raw.select(*[text.csv_null(F.col(raw.columns[i])).alias(c) for i, c in enumerate(cols) if i < len(raw.columns)])
        if "candidate_full_name" in df.columns:
            name = text.split_full_name(F.col("candidate_full_name"))
            df = df.withColumns({"candidate_first_name": name["first"], "candidate_last_name": name["last"]}).drop("candidate_full_name")
    else:
        raise ValueError(f"no layout without header for {year}")
    missing = [c for c in CANDIDATE.values() if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast(T.StringType()) for c in missing}) if missing else df
    df = df.withColumns({"election_year": F.lit(year), "election_type": election_type(F.lit(path))})
    hashed = df.withColumn("content_hash", parse.content_hash(*[F.col(c) for c in CANDIDATE_KEY]))
    return first_by_key(hashed.where("candidate_last_name IS NOT NULL AND office_name IS NOT NULL"), ["content_hash"], sorted(hashed.columns))


def candidate_years(spark: SparkSession, files: dict[int, str]) -> DataFrame:
    """Several years together, once per content hash; a year whose file cannot be read in any layout is passed over."""
    parts = []
    for year, path in sorted(files.items()):
        try:
            parts.append(candidates(spark, path, year))
        except ValueError:
            continue
    df = reduce(lambda a, b: a.unionByName(b), parts)
    return first_by_key(df, ["content_hash"], sorted(df.columns))
