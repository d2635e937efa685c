"""Code normalisation as literal maps and ordered rules."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import let, strip, title_case

#: Federal office and committee codes.
FEDERAL_OFFICE = {"H": "US_HOUSE", "S": "US_SENATE", "P": "PRESIDENT"}
COMMITTEE_TYPE = {
    "H": "CANDIDATE", "S": "CANDIDATE", "P": "CANDIDATE", "N": "PAC", "Q": "PAC", "V": "PAC", "W": "PAC", "O": "SUPER_PAC",
    "X": "PARTY", "Y": "PARTY", "Z": "PARTY", "C": "OTHER", "D": "OTHER", "E": "OTHER", "I": "OTHER", "U": "OTHER",
}
NORMAL_TYPES = ["CANDIDATE", "PAC", "SUPER_PAC", "PARTY", "OTHER"]
DESIGNATION = {"P": "CANDIDATE", "A": "CANDIDATE", "U": "PAC", "B": "PAC", "D": "PAC", "J": "PAC"}
PARTY = {
    "DEMOCRATIC": "DEM", "DEMOCRAT": "DEM", "DEM": "DEM", "D": "DEM",
    "REPUBLICAN": "REP", "REP": "REP", "R": "REP",
    "GREEN": "GRN", "GRE": "GRN", "GRN": "GRN",
    "LIBERTARIAN": "LIB", "LIB": "LIB",
    "INDEPENDENT": "IND", "IND": "IND", "UNAFFILIATED": "IND", "UNA": "IND",
    "NON-PARTISAN": "NPP", "NONPARTISAN": "NPP", "NON PARTISAN": "NPP", "JUDICIAL": "NPP", "NPP": "NPP",
    "CONSTITUTION": "CON", "WORKING CLASS": "WCP", "BREAD AND ROSES": "BNR", "OTHER CANDIDATES": "OTH", "OTHER": "OTH",
    "AIP": "AIP", "PPY": "PPY", "W": "WRI", "PRO": "PRO",
}
ENTITY = {
    "Individual": "IND", "Business": "ORG", "Political Committee": "COM", "Labor Organization": "ORG", "Association": "ORG",
    "Candidate Loan": "IND", "Other": "ORG",
}
STATE_COMMITTEE = {
    "Candidate Committee": "CANDIDATE",
    "Political Action Committee": "PAC",
    "Party Central Committee": "PARTY",
    "Ballot Issue Committee": "PAC",
    "Independent Expenditure": "SUPER_PAC",
    "Super Political Action Committee": "SUPER_PAC",
    "Inaugural Committee": "OTHER",
    "Slate Committee": "PAC",
    "Out-of-State Committee": "PAC",
    "Participating Organization Committee": "PAC",
    "Public Financing Committee": "OTHER",
    "Gubernatorial Ticket Committee": "CANDIDATE",
    "Legislative Party Caucus Committee": "PARTY",
}
OFFICE = {
    "U.S. Senator": "US_SENATE",
    "United States Senator": "US_SENATE",
    "Representative in Congress": "US_HOUSE",
    "U.S. Representative": "US_HOUSE",
    "Governor / Lt. Governor": "GOVERNOR",
    "Governor": "GOVERNOR",
    "Lieutenant Governor": "LT_GOVERNOR",
    "Attorney General": "ATTORNEY_GENERAL",
    "Comptroller": "COMPTROLLER",
    "Treasurer": "TREASURER",
    "State Senator": "STATE_SENATE",
    "House of Delegates": "STATE_HOUSE",
    "Delegate": "STATE_HOUSE",
    "County Executive": "COUNTY_EXEC",
    "County Council": "COUNTY_COUNCIL",
    "County Council At Large": "COUNTY_COUNCIL",
    "President of the County Council": "COUNTY_COUNCIL",
    "County Commissioner": "COUNTY_COMM",
    "County Commissioner President": "COUNTY_COMM",
    "County Commissioner At Large": "COUNTY_COMM",
    "Member of the City Council": "CITY_COUNCIL",
    "President of the City Council": "CITY_COUNCIL",
    "Council - City of Cumberland": "CITY_COUNCIL",
    "Council - City of Hagerstown": "CITY_COUNCIL",
    "Sheriff": "SHERIFF",
    "State's Attorney": "STATES_ATTORNEY",
    "Register of Wills": "REGISTER_WILLS",
    "Clerk of the Circuit Court": "CIRCUIT_CLERK",
    "Judge of the Circuit Court": "CIRCUIT_JUDGE",
    "Judge of the Orphans' Court": "ORPHANS_JUDGE",
    "Board of Education": "SCHOOL_BOARD",
    "Board of Education At Large": "SCHOOL_BOARD",
    "Democratic Central Committee": "PARTY_COMM",
    "Republican Central Committee": "PARTY_COMM",
}
#: Words (any of the groups, all of a group) that decide where the text is not in the table, in order.
OFFICE_WORDS = [
    ([["congress"], ["representative"]], "US_HOUSE"),
    ([["senator", "state"]], "STATE_SENATE"),
    ([["senator"]], "US_SENATE"),
    ([["national convention"], ["alternate delegate"]], "NATL_DELEGATE"),
    ([["delegate", "house"]], "STATE_HOUSE"),
    ([["governor"]], "GOVERNOR"),
    ([["city council"], ["council - city"]], "CITY_COUNCIL"),
    ([["council"]], "COUNTY_COUNCIL"),
    ([["commissioner"]], "COUNTY_COMM"),
    ([["sheriff"]], "SHERIFF"),
    ([["judge"]], "JUDGE"),
    ([["board", "education"]], "SCHOOL_BOARD"),
    ([["clerk"]], "CLERK"),
    ([["register"]], "REGISTER_WILLS"),
    ([["attorney"]], "STATES_ATTORNEY"),
    ([["central committee"]], "PARTY_COMM"),
    ([["treasurer"]], "TREASURER"),
]
LEVELS = {
    "FEDERAL": ["US_HOUSE", "US_SENATE", "PRESIDENT"],
    "STATE": ["GOVERNOR", "LT_GOVERNOR", "ATTORNEY_GENERAL", "COMPTROLLER", "TREASURER", "STATE_SENATE", "STATE_HOUSE", "NATL_DELEGATE"],
    "CITY": ["CITY_COUNCIL", "MAYOR"],
}
#: Counties whose usual spelling title case does not give.
COUNTY = {
    "PRINCE GEORGE'S": "Prince George's", "PRINCE GEORGE`S": "Prince George's", "SAINT MARY'S": "St. Mary's", "ST. MARY'S": "St. Mary's",
    "QUEEN ANNE'S": "Queen Anne's",
}
CITY = ["baltimore city", "city of baltimore"]


def lookup(values: dict[str, str], c: Column) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def federal_office(c: Column) -> Column:
    up = F.upper(F.trim(c))
    return F.coalesce(lookup(FEDERAL_OFFICE, up), F.nullif(up, F.lit("")), F.lit("OTHER"))


def federal_office_level(c: Column) -> Column:
    """struct(office, level) of a federal office code; the level is always federal."""
    return F.struct(federal_office(c).alias("office"), F.lit("FEDERAL").alias("level"))


def committee_type(kind: Column, designation: Column) -> Column:
    up = F.upper(F.trim(kind))
    return F.when(kind.isNull(), "OTHER").otherwise(
        F.coalesce(F.when(up.isin(NORMAL_TYPES), up), lookup(COMMITTEE_TYPE, up), lookup(DESIGNATION, F.upper(F.trim(designation))), F.lit("OTHER"))
    )


def state_committee_type(c: Column) -> Column:
    return F.coalesce(lookup(STATE_COMMITTEE, c), F.lit("OTHER"))


def party(c: Column) -> Column:
    up = F.upper(F.trim(F.nullif(c, F.lit(""))))
    return F.coalesce(lookup(PARTY, up), F.substring(up, 1, 3))


def office(c: Column) -> Column:
    """The code of an office's text: the table, then the first rule whose words it holds, then its first word."""

    def ruled(low: Column) -> Column:
        cases = [(reduce(or_, [reduce(and_, [low.contains(w) for w in words]) for words in groups]), found) for groups, found in OFFICE_WORDS]
        return reduce(lambda w, case: w.when(*case), cases[1:], F.when(*cases[0]))

    def code(t: Column) -> Column:
        first = F.substring(F.split(F.nullif(F.upper(t), F.lit("")), r"\s+")[0], 1, 20)
        return F.coalesce(lookup(OFFICE, t), let(F.lower(t), ruled), first, F.lit("OTHER"))

    return let(strip(c), code)


def jurisdiction(code: Column) -> Column:
    out = F.lit("COUNTY")
    for level, codes in LEVELS.items():
        out = F.when(code.isin(codes), level).otherwise(out)
    return out


def county_city(c: Column) -> Column:
    """struct(county, city): the one independent city is a city, everything else a county without that word."""
    t = strip(F.nullif(c, F.lit("")))
    city = F.lower(t).isin(CITY)
    bare = strip(F.regexp_replace(t, r"(?i) county$", ""))
    county = F.coalesce(lookup(COUNTY, F.upper(bare)), title_case(bare))
    return F.struct(F.when(~city, county).alias("county"), F.when(city, "Baltimore").alias("city"))


def district(c: Column, office_text: Column | None = None, state: str = "MD") -> Column:
    """A district in its office's form: "MD-06", a number, "District 4", "Circuit 3", or a county's name."""
    known = F.lit("") if office_text is None else F.when(F.coalesce(office_text, F.lit("")) == "", "").otherwise(office(office_text))

    def form(v: Column) -> Column:
        t, code = v["t"], v["code"]
        low, digits = F.lower(t), F.nullif(F.regexp_extract(t, r"(\d+)", 1), F.lit(""))
        short = F.regexp_replace(digits, r"^0+(?=\d)", "")
        padded = F.when(F.length(short) < 2, F.lpad(short, 2, "0")).otherwise(short)
        county = F.when(digits.isNull() & (F.size(F.split(t, r"\s+")) <= 2), title_case(t))
        return (
            F.when((code == "US_HOUSE") | low.contains("congressional"), F.coalesce(F.concat(F.lit(f"{state}-"), padded), t))
            .when(code.isin("STATE_SENATE", "STATE_HOUSE") | low.contains("legislative"), F.coalesce(digits, t))
            .when(low.contains("councilmanic") | low.contains("commissioner district"), F.coalesce(F.concat(F.lit("District "), digits), t))
            .when(low.contains("circuit") | low.contains("judicial"), F.coalesce(F.concat(F.lit("Circuit "), digits), t))
            .otherwise(F.coalesce(lookup(COUNTY, F.upper(t)), county, t))
        )

    return let(F.struct(strip(F.nullif(c, F.lit(""))).alias("t"), known.alias("code")), form)


#: What federal codes are shown as.
READABLE_OFFICE = {"US_HOUSE": "U.S. Representative", "US_SENATE": "U.S. Senator", "PRESIDENT": "President of the United States"}


def readable_office(code: Column) -> Column:
    return F.coalesce(lookup(READABLE_OFFICE, code), code)


def only_at_level(value: Column, level: Column, wanted: str) -> Column:
    """``value`` where the level is ``wanted``, else null."""
    return F.when(level == wanted, value)


def match_confidence(name: Column, city: Column, state: Column, employer: Column, occupation: Column) -> Column:
    """0.4 for the name, 0.2 each for city and state, 0.1 each for employer and occupation, where given."""
    total = F.lit(0).cast("decimal(3,2)")
    for c, w in ((name, "0.4"), (city, "0.2"), (state, "0.2"), (employer, "0.1"), (occupation, "0.1")):
        total = total + F.when(F.coalesce(c, F.lit("")) != "", F.lit(w).cast("decimal(3,2)")).otherwise(F.lit(0).cast("decimal(3,2)"))
    return F.least(total, F.lit(1).cast("decimal(3,2)")).cast("decimal(3,2)")
