"""Records that name an entity of a register without its key, each matched with a confidence to one row or to none.

Sorted neighbourhood: names of both sides are sorted under several composite keys, and each mention meets the
``WINDOW`` register rows before and after its place in each order. Weighted field similarities of name, style, office,
election and dates give a confidence.

Names are then assigned one to one: a *name* of the mentions (all ways to write one person or group) takes at most one
name of the register and the other way round, so that the total confidence is largest. Any number of rows may carry a
name; what the assignment forbids is that a name of its own also takes a similar name that belongs to another. A spelling
is a name of its own if it stands in several texts and in at least one ``RATIO``-th as many as the name it resembles,
and if more than a letter doubled, added, lost or misplaced sets it apart; otherwise it is a slip of that one. Within its assigned name each row takes the register row of the highest confidence, by
style, office, election and dates.

Defined results: null and blank names match nothing; a row gets at most one entity; equal confidences go to the
smaller key; repeated rows each get their match; an empty register or table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.committee_parts import FIELDS, office_of, parse
from ledgerloom.session import cut, discard, shuffle_tasks, spread

WINDOW = 6
ACCEPT = 4.6
RATIO = 8
#: Least raise of a bid: the assignment's total is within this much a name of the largest.
RAISE = 0.01


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(t, *[p[f] for f in FIELDS]) for t in b["text"] for p in [parse(t)]]
        yield pd.DataFrame(rows, columns=["text", *FIELDS])


def _offices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"office_text": b["office_text"], "office_code": [office_of(t) for t in b["office_text"]]})


def name_parts(texts: DataFrame) -> DataFrame:
    schema = ", ".join(["text string", *[f"{f} {'array<string>' if f == 'firsts' else 'string'}" for f in FIELDS]])
    return spread(texts.where("trim(text) <> ''").select("text").distinct()).mapInPandas(_split, schema)


def sort_keys() -> Column:
    """The composite keys: family name first, given name first, family name from its end, sorted words from their end."""
    formal = F.coalesce(F.element_at(F.when(F.size("firsts") > 0, F.col("firsts")), -1), F.lit(""))
    words = F.array_join(F.reverse(F.split("core", " ")), " ")
    person = F.array(
        F.concat_ws("|", F.lit("1"), "last", formal, "style"),
        F.concat_ws("|", F.lit("2"), formal, "last"),
        F.concat_ws("|", F.lit("3"), F.reverse("last"), formal),
        F.concat_ws("|", F.lit("4"), "last", "style", formal),
    )
    other = F.array(F.concat_ws("|", F.lit("5"), "kind", "core"), F.concat_ws("|", F.lit("6"), "kind", words), F.concat_ws("|", F.lit("7"), "kind", F.reverse("core")))
    return F.when(F.col("kind") == "candidate", person).otherwise(other)


def neighbours(mentions: DataFrame, register: DataFrame) -> DataFrame:
    """(text, key_id) of mentions (text, ...) and the register rows (key_id, ...) near them in some order.

    All orders are sorted as one, in ranges of the sort key, so no task sees a whole order whatever its keys are. The position
    of a mention is the number of register rows before it: those of its range are counted in place, those of earlier ranges
    come from the ranges' sizes (one row a range). The rows around it are found by an equality join on positions.
    """
    m = mentions.select("text", F.lit(None).cast("string").alias("key_id"), F.explode(sort_keys()).alias("k"))
    r = register.select(F.lit(None).cast("string").alias("text"), "key_id", F.explode(sort_keys()).alias("k"))
    order = [F.col("k"), F.col("key_id").asc_nulls_last(), F.col("text")]
    both = cut(m.unionByName(r).repartitionByRange(shuffle_tasks(mentions.sparkSession), *order).withColumn("part", F.spark_partition_id()))
    sizes = both.groupBy("part").agg(F.count("key_id").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut(both.withColumn("own", F.count("key_id").over(inside)).join(F.broadcast(offsets), "part").withColumn("pos", F.col("own") + F.col("off")))
    spots = placed.where("key_id IS NULL").select("text", F.explode(F.sequence(F.col("pos") - (WINDOW - 1), F.col("pos") + WINDOW)).alias("pos"))
    rows = placed.where("key_id IS NOT NULL").select("key_id", "pos")
    return spots.join(rows, "pos").select("text", "key_id").distinct()


def assign(edges: DataFrame) -> DataFrame:
    """(a, b) of edges (a, b, value): each a and each b at most once, with the largest total of positive values.

    An auction: every a without a partner bids for the b that is worth most to it at its present price, up to what makes its
    second choice, or none, as good, plus ``RAISE``; the highest bid takes the b and frees its former partner. Each round is a
    few aggregates over all bidders at once. Prices only rise, so the rounds end by themselves.
    """
    edges = cut(edges.where("value > 0").groupBy("a", "b").agg(F.max("value").alias("value")))
    held = edges.select("b", "a", F.col("value").alias("price")).limit(0)
    while True:
        owned = held.select(F.col("a"), F.lit(True).alias("owned"))
        worth = edges.join(owned, "a", "left_anti").join(held.select("b", "price"), "b", "left")
        worth = worth.withColumn("net", F.col("value") - F.coalesce("price", F.lit(0.0))).where("net > 0")
        best = F.min(F.struct((-F.col("net")).alias("d"), "b", F.coalesce("price", F.lit(0.0)).alias("price")))
        # the second best: the largest net of the others, 0 if there is none
        ranked = worth.groupBy("a").agg(best.alias("m"), F.slice(F.sort_array(F.collect_list("net"), False), 2, 1).alias("second"))
        bids = ranked.select("a", F.col("m.b").alias("b"), (F.col("m.price") - F.col("m.d") - F.coalesce(F.get("second", F.lit(0)), F.lit(0.0)) + RAISE).alias("bid"))
        won = cut(bids.groupBy("b").agg(F.min(F.struct((-F.col("bid")).alias("d"), "a")).alias("m")).select("b", F.col("m.a").alias("a"), (-F.col("m.d")).alias("price")))
        if won.isEmpty():
            return held.select("a", "b")
        old, held = held, cut(held.join(won, "b", "left_anti").unionByName(won))
        discard(old, won)


def _letters_slipped(a: Column, b: Column) -> Column:
    """Equal, or a letter doubled, added or lost, or letters in another order: nothing another name would be told by."""
    return (a == b) | ((F.abs(F.length(a) - F.length(b)) == 1) & (F.levenshtein(a, b) == 1)) | (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))


def _unit(first: Column) -> Column:
    return F.when(F.col("kind") == "candidate", F.concat_ws("|", "kind", "last", first)).otherwise(F.concat_ws("|", "kind", "core"))


def allowed_names(scored: DataFrame, mentions: DataFrame, register: DataFrame) -> DataFrame:
    """(text, key_id) of ``scored`` (text, key_id, score) that the one-to-one assignment of names leaves."""
    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", "")
    units = mentions.select("text", _unit(F.col("first")).alias("u"), plain.alias("plain"), "kind", "last", "first", "firsts", "core")
    formal = F.coalesce(F.element_at(F.when(F.size("firsts") > 0, F.col("firsts")), -1), F.lit(""))
    names = register.select("key_id", _unit(formal).alias("r"), *[F.col(c).alias(f"r_{c}") for c in ("last", "first", "firsts", "core")])
    fx, fy = F.col("first"), F.col("r_first")
    initial = (F.least(F.length(fx), F.length(fy)) <= 1) & (F.substring(fx, 1, 1) == F.substring(fy, 1, 1))
    same_first = (fx == "") | (fy == "") | initial | F.arrays_overlap("firsts", "r_firsts")
    person = F.col("kind") == "candidate"
    exact = F.when(person, (F.col("last") == F.col("r_last")) & same_first).otherwise(F.col("core") == F.col("r_core"))
    slip = F.when(person, _letters_slipped(F.col("last"), F.col("r_last")) & (same_first | _letters_slipped(fx, fy))).otherwise(True)
    texts = units.groupBy("u").agg(F.countDistinct("plain").alias("n"))
    claims = cut(
        scored.join(units, "text").join(names, "key_id").groupBy("u", "r").agg(F.max("score").alias("value"), F.bool_or(exact).alias("exact"), F.bool_or(slip).alias("slip")).join(texts, "u")
    )
    own = claims.groupBy("u").agg(F.count_if("exact").alias("n_exact"), F.min(F.when(F.col("exact"), F.col("r"))).alias("exact_r"), F.max(F.struct("value", "r", "slip")).alias("m")).select("u", "n_exact", "exact_r", F.col("m.r").alias("best_r"), F.col("m.slip").alias("slip"))
    owners = claims.where("exact").groupBy(F.col("r").alias("best_r")).agg(F.sum("n").alias("n_owner"))
    who = own.join(texts, "u").join(owners, "best_r", "left")
    apart = ~F.col("slip") & (F.col("n") >= 2) & (F.col("n") * RATIO >= F.coalesce("n_owner", F.lit(0)))
    # a spelling that fits several names of the register exactly (a family name alone) is left to its rows
    side = F.when(F.col("n_exact") > 1, None).when(F.col("n_exact") == 1, F.concat(F.lit("="), "exact_r")).when(apart, F.concat(F.lit("~"), "u")).otherwise(F.concat(F.lit("="), "best_r"))
    who = cut(who.select("u", side.alias("side")))
    edges = claims.join(who.where("side IS NOT NULL"), "u").select(F.col("side").alias("a"), F.col("r").alias("b"), "value")
    pairs = assign(edges).select(F.col("a").alias("side"), F.col("b").alias("r"), F.lit(True).alias("paired"))
    judged = scored.join(units.select("text", "u"), "text").join(who, "u").join(names.select("key_id", "r"), "key_id").join(pairs, ["side", "r"], "left")
    return judged.where("side IS NULL OR paired").select("text", "key_id")


def name_score() -> Column:
    """Weighted similarity of the names of mention ``x`` and register row ``y``."""
    c = lambda s, n: F.col(f"{s}.{n}")
    lx, ly = c("x", "last"), c("y", "last")
    longer = F.greatest(F.length(lx), F.length(ly))
    close = lambda a, b, n: F.levenshtein(a, b) <= n
    # without a given name nothing else says that another spelling means the same family
    alone = (c("x", "first") == "") | (c("y", "first") == "")
    last = F.when(lx == ly, 4.0).when(close(lx, ly, F.when(longer >= 8, 3).when(longer >= 5, 2).otherwise(1)), F.when(alone, 2.2).otherwise(3.4) - 0.3 * F.levenshtein(lx, ly)).otherwise(-9.0)
    fx, fy = c("x", "first"), c("y", "first")
    flong = F.greatest(F.length(fx), F.length(fy))
    initial = (F.least(F.length(fx), F.length(fy)) == 1) & (F.substring(fx, 1, 1) == F.substring(fy, 1, 1))
    first = (
        F.when((fx == "") | (fy == ""), 0.0)
        .when(fx == fy, 3.0)
        .when(F.arrays_overlap(c("x", "firsts"), c("y", "firsts")), 2.7)
        .when(initial, 1.5)
        .when(close(fx, fy, F.when(flong >= 6, 2).otherwise(1)), 2.2)
        .otherwise(-5.0)
    )
    mx, my = c("x", "mid"), c("y", "mid")
    mid = F.when((mx == "") | (my == ""), 0.0).when(F.substring(mx, 1, 1) == F.substring(my, 1, 1), 0.5).otherwise(-1.5)
    suffix = F.when(c("x", "suffix") == c("y", "suffix"), 0.2).when((c("x", "suffix") != "") & (c("y", "suffix") != ""), -3.0).otherwise(-0.6)
    style = F.when(c("x", "style") == c("y", "style"), 1.2).otherwise(-0.6)
    ox, oy = c("x", "office"), c("y", "office")
    office = F.when((ox == "") | (oy == ""), 0.0).when(ox == oy, 0.8).otherwise(-1.5)
    person = last + first + mid + suffix + style + office
    cx, cy = c("x", "core"), c("y", "core")
    digits = lambda t: F.array_sort(F.filter(F.split(t, " "), lambda w: w.rlike("^([0-9]+|[a-z])$")))
    far = F.levenshtein(cx, cy)
    room = F.when(F.length(cy) >= 14, 4).when(F.length(cy) >= 8, 3).otherwise(1)
    cut_short = (F.length(cx) >= 8) & (F.startswith(cy, cx) | F.startswith(cx, cy))
    group = F.when(digits(cx) != digits(cy), -9.0).when(far <= room, 7.0 - 0.5 * far).when(cut_short, 5.2).otherwise(-9.0) + F.when(
        c("x", "style") == c("y", "style"), 0.6
    ).otherwise(-0.4)
    return F.when(c("x", "kind") != c("y", "kind"), -9.0).when(c("x", "kind") == "candidate", person).otherwise(group)


def time_score() -> Column:
    """How well a row's day, office and election agree with a register row's life, office and election."""
    day, begun, closed = F.col("day"), F.col("registered"), F.col("closed")
    alive = F.when(day.isNull(), 0.0).when((day >= F.coalesce(begun, day)) & (day <= F.coalesce(closed, day)), 0.8).otherwise(-0.8)
    office = F.when((F.col("office_code") == "") | (F.col("r_office") == ""), 0.0).when(F.col("office_code") == F.col("r_office"), 0.6).otherwise(-1.2)
    election = F.when(F.col("cycle").isNull() | F.col("r_cycle").isNull(), 0.0).when(F.col("cycle") == F.col("r_cycle"), 0.7).otherwise(-0.7)
    return alive + office + election


def match(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(row_id, key_id, confidence) of rows (row_id, text, day, office_text, cycle) and a register
    (key_id, text, registered, closed, cycle); cycle is a kind of election or null."""
    rows = cut(rows.where("trim(text) <> ''"))
    x = cut(name_parts(rows))
    y = cut(register.where("trim(text) <> ''").join(name_parts(register), "text"))
    near = neighbours(x, y.select("key_id", *FIELDS))
    scored = cut(
        near.join(x.alias("x"), near["text"] == F.col("x.text"))
        .join(y.alias("y"), near["key_id"] == F.col("y.key_id"))
        .select(near["text"], near["key_id"], name_score().alias("score"), F.col("y.registered"), F.col("y.closed"), F.col("y.cycle").alias("r_cycle"), F.col("y.office").alias("r_office"))
        .where(F.col("score") >= ACCEPT - 2.1)
    )
    best = Window.partitionBy("text")
    scored = scored.join(allowed_names(scored.select("text", "key_id", "score"), x, y), ["text", "key_id"])
    kept = cut(scored.withColumn("top", F.max("score").over(best)).where(F.col("score") >= F.col("top") - 4.3).drop("top"))
    codes = spread(rows.where("office_text IS NOT NULL").select("office_text").distinct()).mapInPandas(_offices, "office_text string, office_code string")
    given = rows.join(codes, "office_text", "left").withColumn("office_code", F.coalesce("office_code", F.lit("")))
    total = F.col("score") + time_score()
    judged = given.join(kept, "text").select("row_id", "key_id", total.alias("total"))
    chosen = judged.groupBy("row_id").agg(F.min(F.struct((-F.col("total")).alias("t"), "key_id")).alias("m"), F.sort_array(F.collect_list("total"), False).alias("all"))
    # a family name alone that two entities answer to equally well means neither
    clear = F.coalesce(F.col("all")[0] - F.get("all", F.lit(1)) > 0.05, F.lit(True))
    return chosen.where((-F.col("m.t") >= ACCEPT) & clear).select("row_id", F.col("m.key_id").alias("key_id"), F.round(1 / (1 + F.exp(-(-F.col("m.t") - ACCEPT))), 4).alias("confidence"))
