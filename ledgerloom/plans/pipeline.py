"""Bronze to silver to gold as pure frame transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, parse, text
from ledgerloom.operators.tables import first_by_key, with_new_ids


def silver_state_contributions(bronze: DataFrame, committees: DataFrame) -> DataFrame:
    """Readable rows once per content hash, with parsed values and the committee of exactly their name (smallest key)."""
    day, amount = parse.state_date(F.col("contribution_date")), parse.amount(F.col("contribution_amount"))
    c = committees.groupBy(F.col("committee_name").alias("receiving_committee")).agg(F.min(F.struct("ccf_id", "committee_type")).alias("c"))
    once = first_by_key(bronze, ["content_hash"], ["id"])
    place = parse.address(F.col("contributor_address"))
    out = once.join(c, "receiving_committee", "left").select(
        F.col("content_hash").alias("source_content_hash"), day.alias("contribution_date"), amount.alias("contribution_amount"),
        *[text.null_words(F.col(x)).alias(x) for x in ("contribution_type", "fund_type", "contributor_name", "contributor_type", "contributor_address", "filing_period", "office")],
        place["city"].alias("contributor_city"), place["state"].alias("contributor_state"), place["zip"].alias("contributor_zip"),
        text.default_text(F.col("employer_name")).alias("employer_name"), text.default_text(F.col("employer_occupation")).alias("employer_occupation"),
        F.col("receiving_committee").alias("committee_name"), F.col("c.ccf_id").alias("committee_ccf_id"), F.col("c.committee_type").alias("committee_type"),
    )
    return out.dropna(subset=["contribution_date", "contribution_amount", "contributor_name"])


def silver_federal_contributions(bronze: DataFrame, committees: DataFrame, candidates: DataFrame) -> DataFrame:
    """Bulk or REST rows cleaned and enriched; the candidate is the row's own, else its committee's first."""
    c = committees.select("committee_id", F.col("name").alias("committee_name"), F.col("committee_type"), F.get(F.col("candidate_ids"), F.lit(0)).alias("linked"))
    k = candidates.select(F.col("candidate_id"), F.col("name").alias("candidate_name"), F.col("office").alias("candidate_office"))
    once = first_by_key(bronze, ["sub_id"], ["sub_id", "contribution_receipt_amount"])
    own = once.withColumnRenamed("candidate_id", "own_candidate") if "candidate_id" in once.columns else once.withColumn("own_candidate", F.lit(None).cast("string"))
    joined = own.join(c, "committee_id", "left").withColumn("candidate_id", F.coalesce("own_candidate", "linked")).drop("own_candidate", "linked")
    return joined.join(k, "candidate_id", "left").dropna(subset=["contribution_receipt_date", "contribution_receipt_amount", "contributor_name", "committee_id"])


def gold_contributors(silver: DataFrame, existing: DataFrame) -> DataFrame:
    """New contributors of a silver table, one per key, with confidence and ids above the existing ones."""
    c = F.col
    key = text.contributor_key(c("contributor_name"), c("contributor_city"), c("contributor_state"), c("employer_name"), c("contributor_type"), text.STATE_ORGS)
    keyed = silver.withColumn("match_key", key)
    order = ["contributor_name", F.col("contributor_zip").asc_nulls_last(), F.col("employer_occupation").asc_nulls_last(), "source_content_hash"]
    once = first_by_key(keyed, ["match_key"], order).join(existing.select("match_key"), "match_key", "left_anti")
    rows = once.select(
        "match_key", c("contributor_name").alias("name"), c("contributor_city").alias("city"), c("contributor_state").alias("state"), c("contributor_zip").alias("zip"),
        c("employer_name").alias("employer"), c("employer_occupation").alias("occupation"),
        F.coalesce(codes.lookup(codes.ENTITY, c("contributor_type")), F.lit("IND")).alias("entity_type"),
        codes.match_confidence(c("contributor_name"), c("contributor_city"), c("contributor_state"), c("employer_name"), c("employer_occupation")).alias("match_confidence"),
    )
    return with_new_ids(rows, existing, ["match_key"])


def gold_contributions(silver: DataFrame, contributors: DataFrame, committees: DataFrame, existing: DataFrame) -> DataFrame:
    """New facts of a state: contributor by key and committee by register number are required, rows already there stay."""
    c = F.col
    key = text.contributor_key(c("contributor_name"), c("contributor_city"), c("contributor_state"), c("employer_name"), c("contributor_type"), text.STATE_ORGS)
    people = contributors.select("match_key", F.col("id").alias("contributor_id"))
    groups = committees.where("state_committee_id IS NOT NULL").groupBy("state_committee_id").agg(F.min("id").alias("recipient_committee_id"))
    year = parse.filing_year(c("filing_period"))
    fresh = silver.join(existing.where("source_system = 'MARYLAND'").select(F.col("source_sub_id").alias("source_content_hash")), "source_content_hash", "left_anti")
    return (
        fresh.withColumn("match_key", key).join(people, "match_key")
        .join(groups, F.trim("committee_ccf_id") == F.col("state_committee_id"))
        .select(
            F.lit("MARYLAND").alias("source_system"), F.col("source_content_hash").alias("source_sub_id"), "contribution_date", F.col("contribution_amount").alias("amount"),
            "contributor_id", "recipient_committee_id", F.coalesce("contribution_type", F.lit("DIRECT")).alias("contribution_type"),
            year.alias("election_year"), parse.election_year(year).alias("election_cycle"),
        )
    )


# ---- committees and candidates ---------------------------------------------------------------------------------------


def _election_cycle(df: DataFrame, cycle: int | None) -> F.Column:
    """The run's cycle, else the latest of the row's own."""
    if cycle is not None:
        return F.lit(cycle)
    return F.array_max("cycles") if "cycles" in df.columns else F.lit(None).cast("int")


def silver_federal_committees(bronze: DataFrame, cycle: int | None = None) -> DataFrame:
    """Once per committee id (by name, then all other columns), texts cleaned, codes in capitals, the first linked candidate."""
    once = first_by_key(bronze, ["committee_id"], [F.col(c).asc_nulls_last() for c in sorted(bronze.columns, key=lambda c: (c != "name", c)) if c != "committee_id"])
    linked = F.get("candidate_ids", F.lit(0)) if "candidate_ids" in bronze.columns else F.lit(None).cast("string")
    return once.select(
        F.col("committee_id").alias("source_committee_id"), *[text.null_words(F.col(c)).alias(c) for c in ("name", "city", "treasurer_name")], "committee_type", "designation",
        F.upper("party").alias("party"), F.upper("state").alias("state"), parse.zip5(F.col("zip")).alias("zip"), linked.alias("candidate_id"), _election_cycle(bronze, cycle).alias("election_cycle"),
    )


def silver_federal_candidates(bronze: DataFrame, cycle: int | None = None) -> DataFrame:
    once = first_by_key(bronze, ["candidate_id"], [F.col(c).asc_nulls_last() for c in sorted(bronze.columns, key=lambda c: (c != "name", c)) if c != "candidate_id"])
    active = F.col("is_active") if "is_active" in bronze.columns else F.lit(True)
    return once.select(
        F.col("candidate_id").alias("source_candidate_id"), text.null_words(F.col("name")).alias("name"), F.upper("office").alias("office"), F.upper("state").alias("state"),
        "district", F.upper("party").alias("party"), active.alias("is_active"), _election_cycle(bronze, cycle).alias("election_cycle"),
    )


def silver_state_committees(bronze: DataFrame) -> DataFrame:
    status = F.coalesce(F.lower("committee_status") == "active", F.lit(False))
    return bronze.select(
        F.col("ccf_id").alias("source_ccf_id"), text.null_words(F.col("committee_name")).alias("name"), "committee_type", F.col("committee_status").alias("status"),
        status.alias("is_active"), "election_type", parse.state_date(F.col("registered_date")).alias("registered_date"), parse.state_date(F.col("amended_date")).alias("amended_date"),
        *[text.null_words(F.col(c)).alias(c) for c in ("chairperson_name", "treasurer_name")],
        (F.coalesce("citation_violations", F.lit("")) != "").alias("has_violations"), "citation_violations",
    )


def silver_state_candidates(bronze: DataFrame, committees: DataFrame) -> DataFrame:
    """Names joined and generations set apart, active filings marked, the committee's register number by exact name (the largest
    of a name held twice)."""
    register = committees.where("committee_name IS NOT NULL").groupBy("committee_name").agg(F.max("ccf_id").alias("committee_ccf_id"))
    active = F.coalesce(F.lower("status").isin("active", "seeking the nomination"), F.lit(False))
    joined = bronze.join(register, "committee_name", "left")
    clean = lambda c: text.null_words(F.col(c))
    return joined.select(
        F.col("content_hash").alias("source_content_hash"), text.null_words(text.full_name(F.col("candidate_first_name"), F.col("candidate_last_name"))).alias("name"),
        clean("candidate_first_name").alias("first_name"), clean("candidate_last_name").alias("last_name"), clean("party").alias("party"), "gender", clean("office_name").alias("office"),
        "district", "jurisdiction", "status", active.alias("is_active"), "election_year", "election_type", "committee_name",
        F.when(~F.col("committee_ccf_id").isin("nan", "NaN", ""), F.col("committee_ccf_id")).alias("committee_ccf_id"), "email", text.digits(F.col("phone")).alias("phone"), "website",
    )


def gold_federal_committees(silver: DataFrame, existing: DataFrame, candidates: DataFrame, state: str | None = None, cycle: int | None = None) -> DataFrame:
    """Committees not yet there, with their type's code and the id of the candidate they are linked with (the smallest)."""
    rows = silver.join(existing.select(F.col("fec_committee_id").alias("source_committee_id")).distinct(), "source_committee_id", "left_anti")
    rows = rows.where(F.col("state") == state) if state else rows
    rows = rows.where(F.col("election_cycle") == cycle) if cycle else rows
    linked = candidates.where("fec_candidate_id IS NOT NULL").groupBy(F.col("fec_candidate_id").alias("candidate_id")).agg(F.min("id").alias("gold_candidate"))
    return rows.join(linked, "candidate_id", "left").select(
        F.col("source_committee_id").alias("fec_committee_id"), "name", codes.committee_type(F.col("committee_type"), F.col("designation")).alias("committee_type"),
        "party", "state", "city", F.col("gold_candidate").alias("candidate_id"), F.lit(True).alias("is_active"),
    )


def gold_federal_candidates(silver: DataFrame, existing: DataFrame, min_cycle: int, state: str | None = None) -> DataFrame:
    """Candidates not yet there who run in ``min_cycle`` or later."""
    rows = silver.join(existing.select(F.col("fec_candidate_id").alias("source_candidate_id")).distinct(), "source_candidate_id", "left_anti").where(F.col("election_cycle") >= min_cycle)
    rows = rows.where(F.col("state") == state) if state else rows
    o = codes.federal_office_level(F.col("office"))
    return rows.select(
        F.col("source_candidate_id").alias("fec_candidate_id"), text.fec_name(F.col("name")).alias("name"), o["office"].alias("office"), o["level"].alias("jurisdiction_level"), "state", "district",
        "party", F.col("election_cycle").alias("first_election_year"), F.col("election_cycle").alias("last_election_year"), F.coalesce("is_active", F.lit(True)).alias("is_active"),
    )


def gold_state_committees(silver: DataFrame, existing: DataFrame, state: str = "MD") -> DataFrame:
    rows = silver.join(existing.select(F.col("state_committee_id").alias("source_ccf_id")).distinct(), "source_ccf_id", "left_anti")
    return rows.select(
        "name", codes.state_committee_type(F.col("committee_type")).alias("committee_type"), F.lit(state).alias("state"), F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("long").alias("candidate_id"), F.col("source_ccf_id").alias("state_committee_id"), F.coalesce("is_active", F.lit(True)).alias("is_active"),
    )


def gold_state_candidates(silver: DataFrame, existing: DataFrame, min_year: int, state: str = "MD") -> DataFrame:
    """Candidates not yet there who run in ``min_year`` or later, with codes, level and county or city of their office."""
    rows = silver.join(existing.select(F.col("state_candidate_id").alias("source_content_hash")).distinct(), "source_content_hash", "left_anti").where(F.col("election_year") >= min_year)
    place = codes.county_city(F.col("jurisdiction"))
    rows = rows.withColumns({"code": codes.office(F.col("office")), "county": place["county"], "town": place["city"]}).withColumn("own_level", codes.jurisdiction(F.col("code")))
    # county offices of the independent city are the city's
    level = F.when((F.col("town") == "Baltimore") & (F.col("own_level") == "COUNTY"), "CITY").otherwise(F.col("own_level"))
    return rows.withColumn("level", level).select(
        "name", F.substring("code", 1, 20).alias("office"), F.col("office").alias("office_raw"), F.lit(state).alias("state"),
        codes.district(F.col("district"), F.col("office"), state).alias("district"), F.col("level").alias("jurisdiction_level"),
        codes.only_at_level(F.col("county"), F.col("level"), "COUNTY").alias("office_county"), codes.only_at_level(F.col("town"), F.col("level"), "CITY").alias("office_city"),
        codes.party(F.col("party")).alias("party"), F.col("election_year").alias("first_election_year"), F.col("election_year").alias("last_election_year"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"), F.col("source_content_hash").alias("state_candidate_id"),
    )


def candidate_rows(bronze: DataFrame) -> DataFrame:
    """Candidates as they are merged: district numbers 0 where none is given, active unless said to be inactive."""
    active = ~F.coalesce(F.col("candidate_inactive"), F.lit(False))
    return bronze.withColumns({"district_number": F.coalesce("district_number", F.lit(0)), "is_active": active})


def election_span(candidates: DataFrame, key: str = "candidate_id", years: str = "election_years") -> DataFrame:
    """(key, first_year, last_year) out of a JSON array of years."""
    each = candidates.select(key, F.explode(F.from_json(F.col(years), "array<string>")).alias("y")).select(key, F.col("y").try_cast("int").alias("y"))
    return each.groupBy(key).agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"))


def in_cycle(cycle: int, cycles: str = "cycles", raw: str = "raw_json") -> F.Column:
    """Whether a row belongs to a cycle, by its own array or by the one in its raw JSON."""
    listed = F.coalesce(F.array_contains(cycles, cycle), F.lit(False))
    said = F.coalesce(F.array_contains(F.from_json(F.get_json_object(raw, "$.cycles"), "array<int>"), cycle), F.lit(False))
    return listed | said
