"""The best record of each duplicate group, field by field, by iterative truth discovery.

Every row of a group claims one value per field. Values that say the same (an employer with and without its legal form, an
occupation written short, a town misspelt) are one claim. Rows come from sources: a source is a load (the rows created in one
month, or what a column ``source`` says) together with a field, as a load may carry good names and outdated employers. Two
estimates are made in turn until no source's trust changes by more than ``TOLERANCE``: the support of each claim, by the
trust of the sources that make it; and the trust of each source, by how far the other rows of its groups support what it
claims. The claim of the highest support wins, where people move and change jobs, so each older row of a group counts
``1 / RECENCY`` of the next younger one: the newest value stands unless its source is much less reliable than those it
contradicts. Of the rows that make the winning claim the one with the most complete text without slips survives. A name makes
two claims: family with given name, and middle names if it has any; initials, short forms and slips are folded into a full
spelling of the group.

Every step is a join or an aggregate; ranks are counted in ranges of a sorted order, and similar claims of one group meet
in an n-gram join, so a group of any size is never gathered in one task nor paired with itself.

Defined results: a field that no row of the group names has no survivor; a group member without a row is passed over;
rows of equal age rank by id; identical texts give their smallest id; repeated memberships count once; a source whose
claims no other row can confirm has the mean trust.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import name_parts as N
from ledgerloom.llm.sparse import similar_pairs
from ledgerloom.session import cut, discard, shuffle_tasks, spread

TOLERANCE = 1e-3
#: From round ``STEADY`` on steps shrink by ``DAMP``, so that the rounds end even where estimates would swing.
STEADY, DAMP = 20, 0.7
#: Claims of mean trust that every source is given beside its own.
PRIOR = 10.0
#: How much more the next younger row weighs.
RECENCY = 3.0
#: Least cosine of 1- and 2-grams of claims that may be spellings of each other.
CLAIM_COSINE = 0.15
FIELDS = ["name", "city", "employer", "occupation"]


def _name_claims(p: dict) -> tuple[str, str]:
    """``family|given names it may stand for`` and the middle names, each run together by blanks; empty if there are none."""
    tokens, k = p["tokens"], p["family"]
    if not tokens:
        return "", ""
    family, rest = ("".join(tokens[:k]), tokens[k:]) if k else (tokens[-1], tokens[:-1])
    return family + "|" + " ".join(N.formal_names(rest[0]) if rest else []), " ".join(rest[1:])


def _same_word(a: Column, b: Column) -> Column:
    """Equal, an initial of the other, or a slip of it."""
    least = F.least(F.length(a), F.length(b))
    return (a == b) | ((least == 1) & (F.substring(a, 1, 1) == F.substring(b, 1, 1))) | ((least > 2) & (F.levenshtein(a, b) <= F.when(least >= 5, 2).otherwise(1)))


def _same_name(a: Column, b: Column) -> Column:
    fa, fb, ga, gb = F.split_part(a, F.lit("|"), F.lit(1)), F.split_part(b, F.lit("|"), F.lit(1)), F.split_part(a, F.lit("|"), F.lit(2)), F.split_part(b, F.lit("|"), F.lit(2))

    def given(x: Column, y: Column) -> Column:
        return (x == "") | (y == "") | F.exists(F.split(x, " "), lambda v: F.exists(F.split(y, " "), lambda w: _same_word(v, w)))

    family = _same_word(fa, fb) | F.arrays_overlap(F.split(fa, "-"), F.split(fb, "-"))
    return (family & given(ga, gb)) | ((ga != "") & (gb != "") & given(fa, gb) & given(ga, fb))  # the latter: typed the other way round


def _same_middle(a: Column, b: Column) -> Column:
    x, y = F.split(a, " "), F.split(b, " ")
    return (F.size(x) == F.size(y)) & F.forall(F.zip_with(x, y, _same_word), lambda same: F.coalesce(same, F.lit(False)))


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for field, text in zip(b["field"], b["text"], strict=True):
            tidy, middle = " ".join(text.split()), ""
            if field == "employer":
                o = N.organization(text) if N.names_employer(text) else {"core": ""}
                claim = o["core"]
                legal = len([w for w in N.plain(text).replace(".", "").split() if w not in N.ORG_WORDS])
                full = legal * 10 + len(tidy)
            elif field == "occupation":
                claim = N.job(text)
                full = 100 if " ".join(text.lower().split()) == claim else 0
            elif field == "city":
                claim = "".join(c for c in N.plain(text) if c.isalpha())
                claim = "" if claim in {"unknown", "na", "none", "nan"} else claim
                full = tidy.count(" ") * 10
            else:
                p = N.person(text)
                claim, middle = _name_claims(p)
                words = [t for t in p["tokens"] if len(t) > 1]
                full = len(words) * 100 + len(p["tokens"]) * 30 + (20 if p["suffix"] else 0) - (5 if p["order"] == "comma" else 0) - (300 if p["nick"] else 0)
                full -= 60 * sum(t in N._FORMAL for t in words[:1])
            letters = [c for c in text if c.isalpha()]
            cased = bool(letters) and not text.isupper() and not text.islower()
            out.append((field, text, claim, middle, float(full) + (3.0 if cased else 0.0) - (2.0 if tidy != text else 0.0)))
        yield pd.DataFrame(out, columns=["field", "text", "claim", "middle", "full"])


def claims(members: DataFrame) -> DataFrame:
    """(group_id, id, field, text, claim, full, created_at), with ``middle`` as a field of its own, of members (group_id, id, FIELDS, created_at)."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS])
    long = members.select("group_id", "id", "created_at", F.inline(entries)).where("trim(text) <> ''")
    forms = cut(spread(long.select("field", "text").distinct()).mapInPandas(_forms, "field string, text string, claim string, middle string, full double"))
    made = long.join(forms.where("claim <> ''"), ["field", "text"])
    middles = made.where("middle <> ''").withColumns({"field": F.lit("middle"), "claim": F.col("middle")})
    return made.unionByName(middles).drop("middle")


def ranks(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their rank from 1 in ``order`` within ``group``; ``order`` must be total.

    Rows are sorted by group and order in ranges; a group may span many of them, and each range only adds the sizes of the
    group's earlier ones (one number a group and range).
    """
    placed = cut(rows.repartitionByRange(shuffle_tasks(rows.sparkSession), F.col(group), *order).withColumn("_p", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(group, "_p").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(group, "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = F.row_number().over(Window.partitionBy("_p", group).orderBy(*order))
    return placed.withColumn("_own", own).join(sizes, [group, "_p"]).withColumn(name, F.col("_own") + F.col("_off")).drop("_p", "_own", "_off")


def fold_spellings(c: DataFrame) -> DataFrame:
    """``c`` with each claim that is a misspelling or short form of a more usual one of its group replaced by that."""
    named = F.col("field").isin("name", "middle")
    whole = ~F.col("claim").rlike(r"(^|[ |]).?( |$)")
    cn = F.when(named, F.when(whole, F.lit(1 << 40)).otherwise(0) + F.countDistinct("id")).otherwise(F.max("n"))
    spelled = c.where("field <> 'occupation'").groupBy("group_id", "field", "claim").agg(cn.alias("cn"))
    near = F.levenshtein("l.text", "r.text") <= F.when(F.length("l.text") >= 12, 3).otherwise(2)
    same = F.when(F.col("l.field") == "name", _same_name(F.col("l.text"), F.col("r.text"))).when(F.col("l.field") == "middle", _same_middle(F.col("l.text"), F.col("r.text"))).otherwise(near)
    more = (F.col("r.cn") > F.col("l.cn")) | (F.col("l.field").isin("name", "middle") & (F.col("r.cn") == F.col("l.cn")) & (F.col("r.text") > F.col("l.text")))
    items = spelled.select(F.sha2(F.to_json(F.struct("group_id", "field", "claim")), 256).alias("id"), "group_id", "field", F.col("claim").alias("text"), "cn")
    pairs = similar_pairs(items, "text", CLAIM_COSINE, sizes=(1, 2), block=["group_id", "field"], ordered=more, also=same)
    x = items.select(F.col("id").alias("a"), "group_id", "field", F.col("text").alias("claim"))
    y = items.select(F.col("id").alias("b"), F.struct("cn", F.col("text").alias("claim")).alias("y"))
    fixed = pairs.join(x, "a").join(y, "b").groupBy("group_id", "field", "claim").agg(F.max("y").getField("claim").alias("right"))
    return c.join(fixed, ["group_id", "field", "claim"], "left").withColumn("claim", F.coalesce("right", "claim")).drop("right")


def source_trust(c: DataFrame) -> DataFrame:
    """(source, field, trust) of claims (group_id, field, claim, source): how far other rows support what a source says."""
    cells = cut(c.groupBy("group_id", "field", "claim", "source").agg(F.count(F.lit(1)).alias("k")))
    trust = cut(cells.select("source", "field").distinct().withColumn("trust", F.lit(1.0)))
    step = 1.0
    for turn in itertools.count():
        backed = cells.join(trust, ["source", "field"]).withColumn("s", F.col("k") * F.col("trust"))
        support = backed.groupBy("group_id", "field", "claim").agg(F.sum("s").alias("support"))
        total = support.groupBy("group_id", "field").agg(F.sum("support").alias("total"))
        judged = backed.join(support, ["group_id", "field", "claim"]).join(total, ["group_id", "field"])
        # each row is judged by the others of its group
        others, rest = F.col("support") - F.col("trust"), F.col("total") - F.col("trust")
        judged = judged.where(rest > 1e-9).groupBy("source", "field").agg(F.sum(F.col("k") * others / rest).alias("agreed"), F.sum("k").alias("n"))
        mean = judged.agg(F.coalesce(F.sum("agreed") / F.sum("n"), F.lit(1.0)).alias("mean"))
        fresh = trust.join(judged, ["source", "field"], "left").join(F.broadcast(mean))
        new = (F.coalesce("agreed", F.lit(0.0)) + PRIOR * F.col("mean")) / (F.coalesce("n", F.lit(0)) + PRIOR)
        moved = cut(fresh.select("source", "field", (F.col("trust") + (new - F.col("trust")) * step).alias("trust"), F.abs((new - F.col("trust")) * step).alias("change")))
        discard(trust)
        trust = moved
        change = moved.agg(F.max("change")).first()[0]
        if change is None or change < TOLERANCE:
            return moved.drop("change")
        trust = moved
        step *= DAMP if turn >= STEADY else 1.0


def survivors(members: DataFrame, known: DataFrame) -> DataFrame:
    """(group_id, field, contributor_id) of members (group_id, id, FIELDS, created_at, and source if there is such a column).

    ``known`` (field, text, n) says how often a text occurs among all records: a slip is rarer than what it misspells.
    """
    once = members.dropDuplicates(["group_id", "id"])
    load = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in members.columns else F.coalesce(F.substring(F.col("created_at").cast("string"), 1, 7), F.lit(""))
    ages = ranks(once.select("group_id", "id", "created_at", load.alias("source")), "group_id", [F.col("created_at").desc_nulls_last(), F.col("id").desc()], "age")
    ages = ages.select("group_id", "id", "source", F.col("age").cast("double").alias("age"))
    c = claims(once).join(ages, ["group_id", "id"]).join(known, ["field", "text"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    c = fold_spellings(cut(c))
    # counted from the youngest row that names the field: any size of group weighs alike, and no field's weights are all 0
    top = c.groupBy("group_id", "field").agg(F.min("age").alias("top"))
    c = cut(c.join(top, ["group_id", "field"]).withColumn("weight", F.pow(F.lit(RECENCY), F.col("top") - F.col("age"))).drop("top"))
    trust = source_trust(c)
    votes = c.join(trust, ["source", "field"]).groupBy("group_id", "field", "claim").agg(F.sum(F.col("weight") * F.col("trust")).alias("support"))
    best = cut(votes.groupBy("group_id", "field").agg(F.max(F.struct("support", "claim")).getField("claim").alias("claim")))
    won = c.join(best, ["group_id", "field", "claim"])
    middle = best.where("field = 'middle'").select("group_id", F.col("claim").alias("middle"))
    strays = c.where("field = 'middle'").join(middle, "group_id").where("claim <> middle").select("group_id", F.lit("name").alias("field"), "id", F.lit(1).alias("stray")).distinct()
    won = cut(won.where("field <> 'middle'").join(strays, ["group_id", "field", "id"], "left").withColumn("stray", F.coalesce("stray", F.lit(0))))
    # names: words no other row of the group confirms, but nearly, are slips
    words = won.where("field = 'name'").select("group_id", "id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{2,})"), F.lit(1)))).alias("word"))
    seen = cut(words.groupBy("group_id", "word").agg(F.countDistinct("id").alias("k"), F.min("id").alias("by")))
    items = seen.select(F.sha2(F.to_json(F.struct("group_id", "word")), 256).alias("id"), "group_id", F.col("word").alias("text"), "k")
    lone = (F.col("l.k") == 1) & (F.col("r.k") > 1) & (F.length("l.text") >= 4)
    near = similar_pairs(items, "text", CLAIM_COSINE, sizes=(1, 2), block=["group_id"], ordered=lone, also=F.levenshtein("l.text", "r.text") <= 2)
    slips = seen.join(items.select("id", "group_id", F.col("text").alias("word")), ["group_id", "word"]).join(near.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
    slips = slips.select("group_id", F.col("by").alias("id"), F.lit("name").alias("field"), F.lit(1).alias("slip")).distinct()
    ready = won.join(slips, ["group_id", "id", "field"], "left").withColumn("slip", F.coalesce("slip", F.lit(0)))
    usual = F.when(F.col("field") == "name", F.lit(0.0)).otherwise(F.log(1.0 + F.col("n")) * 4)
    first = F.min(F.struct("stray", "slip", (-F.col("full") - usual).alias("full"), (-F.col("n")).alias("n"), "text", "id"))
    return ready.groupBy("group_id", "field").agg(first.alias("m")).select("group_id", "field", F.col("m.id").alias("contributor_id"))
