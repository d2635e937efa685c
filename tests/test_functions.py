import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import codes, parse, text

C = F.lit  # used inside functions only, as it needs a session


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: parse.bulk_date(C("12312024")), dt.date(2024, 12, 31)),
        (lambda: parse.bulk_date(C("3312025")), dt.date(2025, 3, 31)),
        (lambda: parse.bulk_date(C("02302024")), None),
        (lambda: parse.bulk_date(C("331202")), None),
        (lambda: parse.zip5_strict(C("21201-4532")), "21201"),
        (lambda: parse.zip5_strict(C("212")), None),
        (lambda: parse.zip5(C("212")), "212"),
        (lambda: parse.zip5(C("abc")), None),
        (lambda: text.bulk_text(C("  Hello  ")), "Hello"),
        (lambda: text.bulk_text(C("NULL")), None),
        (lambda: parse.state_date(C("1/5/2025")), dt.date(2025, 1, 5)),
        (lambda: parse.state_date(C("2025-01-05")), None),
        (lambda: parse.amount(C("12.50")), Decimal("12.50")),
        (lambda: parse.amount(C("1,000")), None),
        (lambda: text.full_name(C("John"), C("Smith, Jr.")), "John Smith Jr."),
        (lambda: text.digits(C("(410) 555-0100")), "4105550100"),
        (lambda: text.digits(C("n/a")), None),
        (lambda: parse.filing_year(C("2025 Annual")), 2025),
        (lambda: parse.filing_year(C(None).cast("string")), 2024),
        (lambda: text.org_name(C("Foo-Bar, LLC.")), "FOOBAR LLC"),
        (lambda: text.contributor_key(C("Acme, Inc."), C("x"), C("y"), C("z"), C("ORG")), "ORG|ACME INC"),
        (lambda: text.contributor_key(C("Doe, Jane"), C("Bethesda"), C("md"), C(None).cast("string"), C("IND")), "DOE, JANE|BETHESDA|MD|"),
        (lambda: text.fec_name(C("CONWAY, MARK STEVEN MR. JR.")), "Mark Steven Conway Jr."),
        (lambda: text.fec_name(C("MCDONALD, PAT III")), "Pat McDonald III"),
        (lambda: text.fec_name(C("O'BRIEN, SAM")), "Sam O'Brien"),
        (lambda: text.fec_name(C("SMITH")), "Smith"),
        (lambda: text.fec_name(C("CARDIN, BENJAMIN L")), "Benjamin L. Cardin"),
        (lambda: codes.federal_office(C("h")), "US_HOUSE"),
        (lambda: codes.federal_office(C(None).cast("string")), "OTHER"),
        (lambda: codes.committee_type(C("K"), C("J")), "PAC"),
        (lambda: codes.committee_type(C(None).cast("string"), C("P")), "OTHER"),
        (lambda: codes.party(C("Forward")), "FOR"),
        (lambda: codes.office(C("Clerk of Court")), "CLERK"),
        (lambda: codes.office(C("  ")), "OTHER"),
        (lambda: codes.office(C("State Senator District 4")), "STATE_SENATE"),
        (lambda: codes.office(C("Alternate Delegate to the National Convention")), "NATL_DELEGATE"),
        (lambda: codes.district(C("6"), C("Representative in Congress")), "MD-06"),
        (lambda: codes.district(C("District 123"), C("U.S. Representative")), "MD-123"),
        (lambda: codes.district(C("Legislative District 31")), "31"),
        (lambda: codes.district(C("PRINCE GEORGE`S")), "Prince George's"),
        (lambda: codes.district(C("anne arundel")), "Anne Arundel"),
        (lambda: codes.readable_office(C("US_HOUSE")), "U.S. Representative"),
        (lambda: codes.readable_office(C("SHERIFF")), "SHERIFF"),
        (lambda: codes.only_at_level(C("Kent"), C("STATE"), "COUNTY"), None),
        (lambda: codes.district(C("Congressional District 6")), "MD-06"),
        (lambda: codes.district(C("Councilmanic District 4")), "District 4"),
        (lambda: parse.election_year(C(2023)), 2024),
        (lambda: text.title_case(C("o'brien-SMITH")), "O'Brien-Smith"),
    ],
)
def test_golden(spark, column, expected):
    assert value(spark, column()) == expected


@pytest.mark.parametrize(
    ("name", "person"),
    [
        ("Zubairi  Daniel - Personal Treasurer Account", "DANIEL ZUBAIRI"), ("Guthrie  Dion F. Citizens to Elect", "DION F GUTHRIE"),
        ("Arango Millan  Juan (Johnny) for Allegany", "JUAN ARANGO MILLAN"), ("Roe  (Nick) Friends of", "NICK ROE"), ("Smith (John) for Delegate", "JOHN SMITH"),
        ("Smith, John for Sheriff", "JOHN SMITH"), ("Re-Elect Ann Lee Campaign", "ANN LEE"), ("Lee  Ann for County Council Citizens for", "ANN FOR COUNTY COUNCIL LEE"), ("Ann Lee for Alaska", "ANN LEE FOR ALASKA"), ("", None),
    ],
)
def test_candidate_of_committee_rules(spark, name, person):
    assert value(spark, text.candidate_of_committee(C(name))) == person


@pytest.mark.parametrize("name", ["Friends of John Smith", "John Smith for Governor", "Committee to Elect John Smith", "Smith  John Friends of"])
def test_candidate_of_committee(spark, name):
    assert value(spark, text.candidate_of_committee(C(name))) == "JOHN SMITH"


def test_hash_counts_null_as_empty(spark):
    import hashlib

    assert value(spark, parse.content_hash(C("a"), C(None), C("b"))) == hashlib.sha256(b"a||b").hexdigest()


def test_confidence(spark):
    n = C(None).cast("string")
    assert value(spark, codes.match_confidence(C("a"), C("b"), C("c"), n, n)) == Decimal("0.80")


def test_county_city(spark):
    assert tuple(value(spark, codes.county_city(C("Baltimore City")))) == (None, "Baltimore")
    assert tuple(value(spark, codes.county_city(C("Prince George's County")))) == ("Prince George's", None)
    assert tuple(value(spark, codes.county_city(C("City of Baltimore")))) == (None, "Baltimore")
    assert tuple(value(spark, codes.county_city(C("Rockville City")))) == ("Rockville City", None)
