"""Committees linked to their candidates: four passes, each over what is still unlinked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import candidate_name, candidate_of_committee, name_variants


def link_by_exact_name(committees: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, candidate_id, link_method): the given link, else the candidate of exactly the committee's name."""
    named = candidates.where("name IS NOT NULL").groupBy(F.upper("name").alias("uname")).agg(F.min("id").alias("by_name"))
    c = committees.withColumn("uname", F.when(F.col("committee_type") == "CANDIDATE", F.upper("name")))
    out = c.join(named, "uname", "left")
    method = F.when(F.col("candidate_id").isNotNull(), "given").when(F.col("by_name").isNotNull(), "name")
    return out.select("id", F.coalesce("candidate_id", "by_name").alias("candidate_id"), method.alias("link_method"))


def link_committees(committees: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, candidate_id, link_method, ambiguous): state id, exact name, extracted name against name variants, and the
    whole variants in reverse; the first pass that links decides, ties go to the smallest candidate id."""
    by_id = candidates.where("state_candidate_id IS NOT NULL").groupBy(F.col("state_candidate_id").alias("k1")).agg(F.min("id").alias("c1"))
    by_name = candidates.where("name IS NOT NULL").groupBy(candidate_name(F.col("name")).alias("k2")).agg(F.min("id").alias("c2"))
    variants = candidates.where("name IS NOT NULL").select("id", F.explode(name_variants(F.col("name"))).alias("k3")).where("k3 LIKE '% %'")
    by_variant = variants.groupBy("k3").agg(F.min("id").alias("c3"), F.countDistinct("id").alias("several"))
    person = F.when(F.col("committee_type") == "CANDIDATE", candidate_of_committee(F.col("name")))
    c = committees.withColumns({"k1": F.col("state_committee_id"), "k2": F.when(F.col("committee_type") == "CANDIDATE", candidate_name(F.col("name"))), "k3": person})
    ends = F.split("k3", " ")
    c = c.withColumn("k4", F.when(F.size(ends) > 2, F.concat_ws(" ", ends[0], F.element_at(ends, -1))))
    reverse = by_variant.select(F.col("k3").alias("k4"), F.col("c3").alias("c4"))
    out = c.join(by_id, "k1", "left").join(by_name, "k2", "left").join(by_variant, "k3", "left").join(reverse, "k4", "left")
    passes = [("given", "candidate_id"), ("state_id", "c1"), ("name", "c2"), ("variant", "c3"), ("reverse", "c4")]
    method = reduce(lambda a, p: F.coalesce(a, F.when(F.col(p[1]).isNotNull(), p[0])), passes, F.lit(None).cast("string"))
    linked = F.coalesce(*[F.col(p[1]) for p in passes])
    return out.select("id", linked.alias("candidate_id"), method.alias("link_method"), (F.coalesce("several", F.lit(0)) > 1).alias("ambiguous"))


def repoint_organizations(fact: DataFrame, contributors: DataFrame) -> DataFrame:
    """The fact with contributors of one organization name replaced by the smallest id of that name."""
    from ledgerloom.functions.text import org_name

    orgs = contributors.where(F.col("entity_type").isin("ORG", "COM", "PAC")).select("id", org_name(F.col("name")).alias("org"))
    first = orgs.groupBy("org").agg(F.min("id").alias("canonical"))
    moved = orgs.join(first, "org").where("id <> canonical").select(F.col("id").alias("contributor_id"), "canonical")
    return fact.join(moved, "contributor_id", "left").withColumn("contributor_id", F.coalesce("canonical", "contributor_id")).drop("canonical")
