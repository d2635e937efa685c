"""Queries of the operators in this package, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import addresses, leaks, matching, places, reading, survivors, tokens, variants
from ledgerloom.session import table


def _address_records(spark: SparkSession, d: str) -> DataFrame:
    given = table(spark, d, "bronze_md_contribution").select("id", F.col("contributor_address").alias("text"))
    filed = table(spark, d, "bronze_md_candidate").select("id", F.concat_ws(" ", "campaign_address", "campaign_city_state_zip").alias("text"))
    return given.unionByName(filed)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return addresses.same_location_pairs(_address_records(spark, d))


def p3_locations(spark: SparkSession, d: str) -> DataFrame:
    """One row for each record with a location: its id, the location and how many records are there."""
    records = _address_records(spark, d)
    placed = records.join(addresses.locations(records), "text").select("id", "location")
    size = placed.groupBy("location").agg(F.count(F.lit(1)).alias("n_records"))
    return placed.join(size, "location")


def _town(c: F.Column) -> F.Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}]+", ""))


def _zip(c: F.Column) -> F.Column:
    """Five digits, leading zeros put back; empty if there are no digits."""
    digits = F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*([0-9]{3,5})", 1)
    return F.when(digits == "", "").otherwise(F.lpad(digits, 5, "0"))


def _name_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Records of the two name fields, and (field, id, text) of employers with the smallest id of each text."""
    gold = table(spark, d, "gold_contributor")
    kind = F.upper(F.col("entity_type"))
    own = gold.select(
        F.lit("gold_contributor.name").alias("field"), "id", "name", _zip(F.col("zip")).alias("zip"), _town(F.col("city")).alias("town"),
        "employer", "occupation", F.when(kind.isin("ORG", "COM", "PAC"), True).when(kind.isin("IND", "CAN"), False).alias("is_org"),
    )
    own = places.place_keys(own).select(*variants.RECORD)
    bronze = table(spark, d, "bronze_md_contribution")
    where = addresses.locations(_address_records(spark, d)).withColumnRenamed("text", "contributor_address")
    kind = F.lower(F.trim("contributor_type"))
    given = bronze.join(where, "contributor_address", "left").select(
        F.lit("bronze_md_contribution.contributor_name").alias("field"), "id", F.col("contributor_name").alias("name"),
        F.coalesce("location", F.lit("")).alias("place"), F.col("employer_name").alias("employer"), F.col("employer_occupation").alias("occupation"),
        F.when(kind == "business", True).when(kind == "individual", False).alias("is_org"),
    )
    employers = (
        gold.where("employer IS NOT NULL")
        .groupBy(F.col("employer").alias("text"))
        .agg(F.min("id").alias("id"))
        .select(F.lit("gold_contributor.employer").alias("field"), "id", "text")
    )
    return own.unionByName(given), employers


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    """One row for each record of the three fields: its entity and how many records share it."""
    members = variants.entity_members(*_name_records(spark, d)).select("field", "id", "cluster")
    return members.join(members.groupBy("field", "cluster").agg(F.count(F.lit(1)).alias("n_records")), ["field", "cluster"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of variant spellings; confirmed rows take part in the clustering, but are no pairs."""
    members = variants.entity_members(*_name_records(spark, d))
    confirmed = table(spark, d, "contributor_group").select(F.lit("gold_contributor.name").alias("field"), F.col("contributor_id").alias("id")).distinct()
    return variants.variant_pairs(members.join(confirmed, ["field", "id"], "left_anti"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The corpus out of its ids again."""
    return tokens.decode(p8_ids(spark, d))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    items = table(spark, d, "eval_item").select("item_id", F.col("item_text").alias("text"))
    return leaks.leaks(docs, items)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_leaks(spark, d).select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "reading_label")
    known = labels.select("doc_id", F.lit(True).alias("known")).distinct()
    english = docs.join(known, "doc_id", "left").where("lang = 'en' OR known").select("doc_id", "text", "known")
    levels = reading.reading_levels(english.select("doc_id", "text"), labels.select("doc_id", "reading_level"))
    return levels.join(known, "doc_id", "left_anti")


def _day(c: str) -> F.Column:
    shaped = F.when(F.trim(c).rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.trim(c))
    return F.try_to_timestamp(shaped, F.lit("M/d/yyyy")).cast("date")


def _register(spark: SparkSession, d: str) -> DataFrame:
    closed = F.when(F.lower("committee_status") == "closed", _day("amended_date"))
    return table(spark, d, "bronze_md_committee").select(
        F.col("ccf_id").alias("key_id"), F.col("committee_name").alias("text"), _day("registered_date").alias("registered"),
        closed.alias("closed"), F.lower("election_type").alias("cycle"),
    )


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, ccf_id, confidence) of all rows that mean a registered committee, whatever their text."""
    given = table(spark, d, "bronze_md_contribution").select(
        F.col("id").alias("row_id"), F.col("receiving_committee").alias("text"),
        F.coalesce(_day("contribution_date"), F.try_to_timestamp(F.concat(F.regexp_extract(F.coalesce("filing_period", F.lit("")), r"(\d{4})", 1), F.lit("-07-01"))).cast("date")).alias("day"),
        F.col("office").alias("office_text"), F.lit(None).cast("string").alias("cycle"),
    )
    kind = F.when(F.col("election_year") % 4 == 2, "gubernatorial").when(F.col("election_year") % 4 == 0, "presidential")
    filed = table(spark, d, "bronze_md_candidate").select(
        F.col("id").alias("row_id"), F.col("committee_name").alias("text"),
        _day_of_filing().alias("day"), F.col("office_name").alias("office_text"), kind.alias("cycle"),
    )
    return matching.match(given.unionByName(filed), _register(spark, d)).withColumnRenamed("key_id", "ccf_id")


def _day_of_filing() -> F.Column:
    text = F.regexp_extract(F.coalesce("filing_type_and_date", F.lit("")), r"(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("M/d/yyyy")).cast("date")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Matches of rows whose text is not identical to exactly one name of the register."""
    once = table(spark, d, "bronze_md_committee").groupBy(F.col("committee_name").alias("text")).count().where("count = 1").select("text")
    texts = table(spark, d, "bronze_md_contribution").select(F.col("id").alias("row_id"), F.col("receiving_committee").alias("text")).unionByName(
        table(spark, d, "bronze_md_candidate").select(F.col("id").alias("row_id"), F.col("committee_name").alias("text"))
    )
    identical = texts.join(once, "text").select("row_id")
    return p2_matches(spark, d).select("row_id", "ccf_id").join(identical, "row_id", "left_anti")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    gold = table(spark, d, "gold_contributor")
    groups = table(spark, d, "contributor_group")
    members = groups.join(gold, groups["contributor_id"] == gold["id"]).select("group_id", "id", *survivors.FIELDS, "created_at")
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in survivors.FIELDS])
    known = gold.select(F.inline(fields)).where("text IS NOT NULL").groupBy("field", "text").agg(F.count(F.lit(1)).alias("n"))
    return survivors.survivors(members, known)


QUERIES = {"p4_found": p4_found, "p2_found": p2_found, "p2_matches": p2_matches, "p10_found": p10_found, "p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_found": p9_found, "p9_leaks": p9_leaks, "p1_found": p1_found, "p1_entities": p1_entities, "p3_found": p3_found, "p3_locations": p3_locations}
SQL: dict[str, str] = {"p8_decoded": "SELECT doc_id, text FROM documents"}
