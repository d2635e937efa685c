"""Address records that denote the same location.

Distinct texts are split into parts once. Street names become weighted character n-grams; the inverted index is kept
per house number (or box number), which must agree, and only rare n-grams enter it (prefix filter). Candidates are
verified by cosine and by their parts: direction, unit, place and street type must not contradict each other. A text
then belongs to the most frequent location that is at least as complete as itself.

Defined results: null, empty and "unknown" texts, and texts without house or box number, have no location and no
pair; records with identical texts are one location and no pair; repeated ids count once per record; a text whose
street type is missing belongs to the most frequent street of that name at this number and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.address_parts import PARTS, parse
from ledgerloom.llm.places import place_keys
from ledgerloom.llm.sparse import similar_pairs
from ledgerloom.session import cut, spread

#: A misspelling makes n-grams that are rare and so weigh much; edit distance decides between what this lets through.
STREET_COSINE = 0.2


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(t, parse(t)) for t in batch["text"]]
        rows = [(t, *[p[x] for x in PARTS]) for t, p in rows if p]
        yield pd.DataFrame(rows, columns=["text", *PARTS])


def address_parts(texts: DataFrame) -> DataFrame:
    """One row for each distinct text that holds a location."""
    schema = ", ".join(f"{c} string" for c in ["text", *PARTS])
    return spread(texts.select("text").where("text IS NOT NULL").distinct()).mapInPandas(_split, schema)


def locations(texts: DataFrame) -> DataFrame:
    """(text, location) of each distinct text with a location; ``texts`` has column ``text``."""
    parts = cut(place_keys(address_parts(texts)))
    fields = ["kind", "house", "dir", "street", "type", "unit", "place"]
    forms = parts.groupBy(fields).agg(F.count(F.lit(1)).alias("n"))
    forms = cut(forms.withColumn("id", F.concat_ws("|", *fields)))
    shorter = F.least(F.length("l.text"), F.length("r.text"))
    misspelt = F.levenshtein("l.text", "r.text", 3).between(0, F.when(shorter >= 9, 3).when(shorter >= 5, 2).otherwise(1))
    letters = lambda c: F.array_sort(F.split(c, ""))
    swapped = (F.col("l.letters") == F.col("r.letters")) & (letters("l.text") == letters("r.text"))
    near = similar_pairs(
        forms.select("id", "kind", "house", "dir", "unit", F.col("street").alias("text"), F.xxhash64(letters("street")).alias("letters")),
        "text",
        STREET_COSINE,
        sizes=(1, 2),
        block=["kind", "house", "dir", "unit"],
        ordered=F.col("l.id") != F.col("r.id"),
        also=misspelt | swapped,
    )
    x = forms.select(*[F.col(c).alias(f"x_{c}") for c in ["id", "type", "place", "street", "n"]])
    y = forms.select(*[F.col(c).alias(f"y_{c}") for c in ["id", "type", "place", "street", "n"]])
    pairs = near.join(x, F.col("a") == F.col("x_id")).join(y, F.col("b") == F.col("y_id"))

    def covered(part: str) -> F.Column:
        return (F.col(f"x_{part}") == "") | (F.col(f"x_{part}") == F.col(f"y_{part}"))

    typo_town = (
        ~F.col("x_place").rlike("^[0-9]+$") & (F.col("x_place") != "") & ~F.col("y_place").rlike("^[0-9]+$")
        & (F.levenshtein("x_place", "y_place") <= 2)
    )
    ok = covered("type") & (covered("place") | typo_town)
    # a street can only be a misspelling of one at least as frequent; an incomplete form has to give way to a complete one
    more = (F.col("y_n") > F.col("x_n")) | ((F.col("y_n") == F.col("x_n")) & (F.col("b") < F.col("a")))
    fuller = ((F.col("x_type") == "") & (F.col("y_type") != "")) | ((F.col("x_place") == "") & (F.col("y_place") != ""))
    best = Window.partitionBy("a").orderBy(fuller.desc(), F.col("y_n").desc(), F.col("cos").desc(), "b")
    step = (
        pairs.where(ok & (more | fuller)).withColumn("k", F.row_number().over(best)).where("k = 1").select("a", F.col("b").alias("up"))
    )
    step = cut(step)
    tree = forms.select("id").join(step, F.col("id") == F.col("a"), "left").select("id", F.coalesce("up", "id").alias("root"))
    # every round doubles the steps taken towards the root; a step never leads back, so the rounds end
    while True:
        up = tree.select(F.col("id").alias("root"), F.col("root").alias("next"))
        tree = cut(tree.join(up, "root").select("id", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        if tree.where("moved").isEmpty():
            break
        tree = tree.drop("moved")
    named = parts.withColumn("id", F.concat_ws("|", *fields)).join(tree.drop("moved"), "id")
    return named.select("text", F.col("root").alias("location"))


def same_location_pairs(records: DataFrame) -> DataFrame:
    """(id_a, id_b) of records (id, text) at one location whose texts differ, id_a < id_b."""
    placed = cut(records.join(locations(records), "text").select("id", "text", "location").distinct())
    return pairs_of_texts(placed, "location").select("id_a", "id_b")


def pairs_of_texts(members: DataFrame, group: str) -> DataFrame:
    """(``group``, id_a, id_b), id_a < id_b, of ``members`` (id, text, ``group``) in one group whose texts differ.

    Distinct texts are paired first, so copies of one text never meet each other.
    """
    texts = members.select(group, "text").distinct()
    a, b = texts.withColumnRenamed("text", "t_a"), texts.withColumnRenamed("text", "t_b")
    pairs = a.join(b, group).where("t_a < t_b")
    left = members.select(group, F.col("text").alias("t_a"), F.col("id").alias("i"))
    right = members.select(group, F.col("text").alias("t_b"), F.col("id").alias("j"))
    out = pairs.join(left, [group, "t_a"]).join(right, [group, "t_b"]).where("i <> j")
    return out.select(group, F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"))
