"""Cleaning of text, names and addresses as column expressions (no Python per row)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for no value.
NULL_WORDS = ["nan", "None", ""]
CSV_NULLS = ["", " ", "nan", "NaN", "None", "NULL", "null", "NA", "N/A"]
GENERATION = ["JR", "SR", "II", "III", "IV", "V"]
HONORIFICS = ["MR", "MRS", "MS", "DR", "MX"]
FEDERAL_ORGS = ["PAC", "COM", "ORG", "CCM", "PTY"]
STATE_ORGS = ["Business", "Political Committee", "Labor Organization", "Association", "Other", "Candidate Loan"]


def strip(c: Column) -> Column:
    """Without white space of any script at the ends."""
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` refers to it, and stands once in the plan."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def null_words(c: Column) -> Column:
    t = strip(c)
    return F.when(t.isin(NULL_WORDS), None).otherwise(t)


def csv_null(c: Column) -> Column:
    return F.when(c.isin(CSV_NULLS), None).otherwise(c)


def default_text(c: Column, default: str = "NOT PROVIDED") -> Column:
    return F.coalesce(null_words(c), F.lit(default))


def bulk_text(c: Column) -> Column:
    t = strip(c)
    return F.when((t == "") | (F.upper(t) == "NULL"), None).otherwise(t)


def title_case(c: Column) -> Column:
    """Each run of letters starts with a capital; the rest is lower case."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def org_name(c: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"[,.\-'\"()]", "")
    return F.upper(F.trim(F.regexp_replace(bare, r"\s+", " ")))


def candidate_name(c: Column) -> Column:
    spaced = F.regexp_replace(F.coalesce(c, F.lit("")), r"[,.\-'\"()]", " ")
    return F.upper(F.trim(F.regexp_replace(spaced, r"\s+", " ")))


def contributor_key(name: Column, city: Column, state: Column, employer: Column, kind: Column, orgs: list[str] | None = None) -> Column:
    """``ORG|name`` for organizations, else name, city, state and employer; null counts as empty."""
    part = lambda c: F.upper(strip(F.coalesce(c, F.lit(""))))
    known = F.upper(kind).isin(FEDERAL_ORGS) if orgs is None else kind.isin(orgs)
    person = F.concat_ws("|", part(name), part(city), part(state), part(employer))
    return F.when(F.coalesce(known, F.lit(False)), F.concat(F.lit("ORG|"), org_name(name))).otherwise(person)


def fec_name(c: Column) -> Column:
    """"LAST, FIRST MIDDLE TITLE SUFFIX" as "First Middle Last Suffix"; without a comma in title case."""
    halves = F.split(c, ",", 2)
    last, right = strip(halves[0]), strip(F.get(halves, F.lit(1)))
    words = F.filter(F.split(right, r"\s+"), lambda w: w != "")
    bare = lambda w: F.upper(F.rtrim(w, F.lit(".")))
    ends = F.filter(words, lambda w: bare(w).isin(GENERATION))
    given = F.filter(words, lambda w: ~bare(w).isin(GENERATION + HONORIFICS))

    def one(w: Column) -> Column:
        low, letters = F.lower(w), F.rtrim(w, F.lit("."))
        return (
            F.when(F.length(letters) == 1, F.concat(F.upper(letters), F.lit(".")))
            .when(low.startswith("mc") & (F.length(w) > 2), F.concat(F.lit("Mc"), title_case(F.substr(w, F.lit(3)))))
            .when(low.startswith("o'") & (F.length(w) > 2), F.concat(F.lit("O'"), title_case(F.substr(w, F.lit(3)))))
            .otherwise(title_case(w))
        )

    def ending(w: Column) -> Column:
        b = bare(w)
        return F.when(b.isin("JR", "SR"), F.concat(F.initcap(F.lower(b)), F.lit("."))).otherwise(b)

    parts = F.concat(F.transform(given, one), F.array(one(last)), F.transform(ends, ending))
    return F.when(c.isNull(), None).when(~c.contains(","), title_case(strip(c))).otherwise(F.array_join(parts, " "))


def full_name(first: Column, last: Column) -> Column:
    joined = F.trim(F.concat_ws(" ", first, last))
    return F.regexp_replace(joined, r",\s*(Jr\.?|Sr\.?|II|III|IV|V|2nd|3rd|4th|5th)$", " $1")


def split_full_name(c: Column) -> Column:
    """struct(first, last): the last word is the family name."""
    words = F.split(strip(c), r"\s+")
    n = F.size(words)
    return F.struct(F.when(n > 1, F.array_join(F.slice(words, 1, n - 1), " ")).alias("first"), F.element_at(words, -1).alias("last"))


def name_variants(c: Column) -> Column:
    """Full name, last word, first and last word, last two words."""
    words = F.split(candidate_name(c), " ")
    n = F.size(words)
    last = F.element_at(words, -1)
    full = F.array_join(words, " ")
    more = F.array(full, last, F.concat_ws(" ", words[0], last), F.concat_ws(" ", F.element_at(words, -2), last))
    return F.array_distinct(F.when(n >= 2, more).otherwise(F.array(full)))


def digits(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit(""))


#: What follows a candidate's name in "Last  First ..." (two blanks), in the order they are sought; the first that
#: occurs ends the name, wherever it stands.
NAME_ENDS = [
    "Citizens to Elect", "Committee to Elect", "Friends of", "Friends for", "Citizens for", "Committee for", "for Governor",
    "for Congress", "for Senate", "for Delegate", "for County", "for State", "for School", "for Commissioner", "for Judge",
    "for Sheriff", "for Maryland", "for Baltimore", "for Allegany", "for Anne Arundel", "for Calvert", "for Caroline",
    "for Carroll", "for Cecil", "for Charles", "for Dorchester", "for Frederick", "for Garrett", "for Harford", "for Howard",
    "for Kent", "for Montgomery", "for Prince George", "for Queen Anne", "for Somerset", "for Talbot", "for Washington",
    "for Wicomico", "for Worcester", "for Hagerstown", "for Cumberland", "for Our", "for Republican", "for Democrat",
    "for Citizens", "for Progress", "for Change", "for Mayor", "for Council", "for District", "Marylanders For", "Campaign for",
    "Campaign", "Committee", "Committe", "- Personal Treasurer", "Personal Treasurer", "The Friends Of",
]
#: Openings and endings of committees' names in any other form; one of each is taken off.
NAME_OPENINGS = [
    "Friends of", "Friends for", "Committee to Elect", "Committee for", "Citizens for", "Citizens to Elect", "Elect", "Re-Elect",
    "Re Elect", "Team of", "Vote for", "Campaign for", "The Friends Of", "Marylanders for",
]
NAME_CLOSINGS = [
    "for Governor", "for Congress", "for Senate", "for Delegate", "for County Council", "for State Senate", "for School Board",
    "for Commissioner", "for County Executive", "for Judge", "for Sheriff", "for Maryland", "for Our County", "Campaign",
    "Committee", "- Personal Treasurer Account", "- Personal Treasurer", "Personal Treasurer Account",
]


def _any_of(phrases: list[str]) -> str:
    return "(?:" + "|".join(p.replace("-", r"\-") for p in phrases) + ")"


def candidate_of_committee(c: Column) -> Column:
    """The person a candidate committee is named for, in capitals; null for null and empty names.

    In "Last  First ... ending" the given names end at the first of ``NAME_ENDS`` (in their order) that occurs; a name in
    brackets stands for the given names if there are no others. Any other form loses one opening and one closing. Then
    "A (B)" becomes "B A", and "A, B" becomes "B A".
    """
    wide = r"(?U)^([\w\s\-']+?)\s{2,}(.+)$"
    only, bracket = r"^\(([^)]+)\)$", r"(?U)^(\w+)\s*\((\w+)\)"
    ends = []
    for phrase in NAME_ENDS:
        words = r"\s+".join(phrase.removeprefix("- ").split())
        ends.append("(?is)" + (rf"\s*-\s*{words}" if phrase.startswith("- ") else rf"\b{words}\b") + ".*$")

    def given_names(rest: Column) -> Column:
        # the first ending, in their order, that occurs
        found = F.get(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: F.rlike(rest, e)), F.lit(0))
        return F.when(found.isNull(), rest).otherwise(strip(F.regexp_replace(rest, found, "")))

    def without_brackets(given: Column) -> Column:
        bare = F.when(given.rlike(only), F.regexp_extract(given, only, 1)).otherwise(strip(F.regexp_replace(given, r"\s*\([^)]+\)\s*", " ")))
        return F.regexp_replace(bare, r"[.,;:\-]+$", "")

    def wide_form(name: Column) -> Column:
        rest, last = strip(F.regexp_extract(name, wide, 2)), strip(F.regexp_extract(name, wide, 1))
        return let(let(let(rest, given_names), without_brackets), lambda given: F.when(given == "", last).otherwise(F.concat(given, F.lit(" "), last)))

    def other_form(name: Column) -> Column:
        opened = strip(F.regexp_replace(F.regexp_replace(name, r"(?U)\s+", " "), "(?i)^" + _any_of(NAME_OPENINGS), ""))
        return strip(F.regexp_replace(opened, "(?i)" + _any_of(NAME_CLOSINGS) + "$", ""))

    def unbracketed(person: Column) -> Column:
        return F.when(person.rlike(bracket), F.concat(F.regexp_extract(person, bracket, 2), F.lit(" "), F.regexp_extract(person, bracket, 1))).otherwise(person)

    def unturned(person: Column) -> Column:
        halves = F.split(person, ",", 2)
        return F.when(person.contains(","), F.concat(strip(F.get(halves, F.lit(1))), F.lit(" "), strip(F.get(halves, F.lit(0))))).otherwise(person)

    person = let(strip(c), lambda name: F.when(name.rlike(wide), wide_form(name)).otherwise(other_form(name)))
    person = let(let(person, unbracketed), unturned)
    return F.nullif(F.upper(strip(F.regexp_replace(person, r"(?U)\s+", " "))), F.lit(""))
