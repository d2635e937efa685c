"""Dates, amounts, ZIP codes, addresses and hashes out of text; what does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip, title_case


def bulk_date(c: Column) -> Column:
    t = F.trim(c)
    return F.when(F.length(t).isin(7, 8), F.try_to_timestamp(F.lpad(t, 8, "0"), F.lit("MMddyyyy"))).cast("date")


def state_date(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(t, F.lit("M/d/yyyy"))).cast("date")


def amount(c: Column) -> Column:
    """A plain decimal number of at most ten digits before and two after the point; anything else is null."""
    t = F.trim(c)
    return F.when(t.rlike(r"^-?[0-9]{1,10}(\.[0-9]{1,2})?$"), t.try_cast("decimal(12,2)"))


def zip5(c: Column) -> Column:
    return F.nullif(F.substring(F.regexp_replace(c, r"[^0-9]", ""), 1, 5), F.lit(""))


def zip5_strict(c: Column) -> Column:
    t = F.substring(F.regexp_replace(F.trim(c), "-", ""), 1, 5)
    return F.when(F.length(t) >= 5, t)


def filing_year(c: Column, default: int = 2024) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit("")).try_cast("int"), F.lit(default))


def election_year(cycle: Column) -> Column:
    return F.when(cycle % 2 == 0, cycle).otherwise(cycle + 1)


def valid_cycle(cycle: Column, latest: int) -> Column:
    return (cycle % 2 == 0) & cycle.between(1980, latest)


#: Street types that are not part of a town's name at its end.
STREET_ENDS = ["St", "Ave", "Rd", "Dr", "Ln", "Ct", "Blvd", "Way", "Pl", "Cir", "Ter", "Pkwy", "Hwy"]


def address(c: Column) -> Column:
    """struct(city, state, zip) of "... city ST zip", best effort: the city is the run of words before the state."""
    t = strip(c)
    found = lambda pattern: F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))
    town = strip(F.regexp_extract(t, r"\b([A-Za-z\s]+?)\s+[A-Z]{2}\s+\d{5}", 1))
    town = strip(F.regexp_replace(town, rf"(?i)\b(?:{'|'.join(STREET_ENDS)})\b\.?\s*$", ""))
    return F.struct(
        title_case(F.nullif(town, F.lit(""))).alias("city"), found(r"\b([A-Z]{2})\s+\d{5}").alias("state"), found(r"\b(\d{5})(?:-\d{4})?\s*$").alias("zip")
    )


def coerced_date(c: Column) -> Column:
    """A day out of any text that is one in ISO form, with or without time; null otherwise."""
    return F.try_to_timestamp(strip(c)).cast("date")


def content_hash(*columns: Column) -> Column:
    """SHA-256 of the fields joined by bars; null counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)
