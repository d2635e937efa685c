"""Evaluation passages inside corpus texts, by a positional inverted index.

Both sides are read as sequences of plain words (markup, invisible characters, case and punctuation aside). The index
lists, for each term of an evaluation item, the corpus positions it stands at; a term is the sequence of ``GRAM``
neighbouring words. Intersection starts from the rarest terms: in every stretch of ``STRETCH`` terms of an item the
``SEEDS`` rarest in the corpus are its seeds, and only a pair of text and item that shares a seed is looked at further. A
changed word spoils ``GRAM`` terms, so a run of twelve words with one change always keeps a seed. Offset-adjusted
positions (corpus minus item position) of a pair that fall together make a region; the longest chain of its terms bounds
the run that can be there, and what passes is aligned word by word.

Defined results: null and empty texts and items leak nothing; an item of fewer than ``RUN`` words leaks only whole and
unchanged, one of fewer than ``GRAM`` words never; repeated rows give one pair of ids; the item's own repetitions in one
text are one pair; texts of any length are read whole; a region is found wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut, spread

GRAM = 3
#: Words of an item that must stand in a row, small changes aside; a run shorter than ``SAFE_RUN`` may have one change, as
#: sentences of one mould share up to thirteen words with two or three others between them. ``SLACK``: what one change takes
#: from the score of a chain of whole terms, or from its length where it lies near an end.
RUN, SAFE_RUN, SLACK = 12, 14, 3
STRETCH, SEEDS = RUN - GRAM + 1, GRAM + 1
#: Terms that the best alignment of any accepted run keeps.
HITS = 3
BAND = 8
#: What an edit costs where a matching word gains 1: sentences of one mould but other words earn nothing.
EDIT = 2.0
#: Terms of items up to this number are broadcast to the corpus; more are joined by term.
BROADCAST_TERMS = 500_000


def plain_words(text: Column) -> Column:
    """The words of a text: markup, entities and invisible characters removed, lower case, runs of letters and digits."""
    t = F.regexp_replace(text, "[­​‌‍⁠﻿]", "")
    t = F.regexp_replace(t, r"<[^<>]*>", "")
    t = F.regexp_replace(t, r"&#?[A-Za-z0-9]{2,8};", " ")
    t = F.regexp_replace(F.lower(t), "['’`]", "")
    return F.filter(F.split(t, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(words: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, pos, gram) of ``words`` (key, w): each run of ``GRAM`` words as one hash."""
    n = F.size("w") - (GRAM - 1)
    runs = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.array_join(F.slice("w", i, F.lit(GRAM)), " "))))
    return words.select(key, F.posexplode(F.coalesce(runs, F.array().cast("array<bigint>"))).alias(pos, "gram"))


def longest_run(item: list[str], text: list[str]) -> tuple[int, int, int]:
    """(run, near, exact) in words of ``item``, from the first to the last that matches ``text``: ``run`` of the best local alignment, in which
    a match gains 1 and a change, a lost or an added word costs ``EDIT``; ``near`` of the longest stretch with at most one such edit;
    ``exact`` of the longest without."""
    best, cover, near, exact = 0.0, 0, 0, 0
    m = len(item)
    # (score, first word), then the words of a stretch: without an edit, with one, and with one that no match follows yet
    prev = [(0.0, 0, 0, 0, 0)] * (m + 1)
    for w in text:
        row = [(0.0, 0, 0, 0, 0)]
        for j in range(1, m + 1):
            s, first, whole, once, open_ = prev[j - 1]
            up, left = prev[j], row[j - 1]
            after = max(whole + 1 if whole else 0, up[2], left[2] + 1 if left[2] else 0)
            if w == item[j - 1]:
                c = (s + 1.0, first if s > 0 else j)
                if c[0] > best:
                    best, cover = c[0], j - c[1] + 1
                stretch = (whole + 1, max(once, open_) + 1 if once or open_ else 0)
                near, exact = max(near, *stretch), max(exact, stretch[0])
            else:
                c, stretch = (s - EDIT, first), (0, 0)
            if up[0] - EDIT > c[0]:
                c = (up[0] - EDIT, up[1])
            if left[0] - EDIT > c[0]:
                c = (left[0] - EDIT, left[1])
            row.append((*(c if c[0] > 0 else (0.0, 0)), *stretch, after))
        prev = row
    return cover, near, exact


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        runs = [longest_run(list(i), list(w)) for i, w in zip(b["item_words"], b["w"], strict=True)]
        yield pd.DataFrame(
            {"doc_id": b["doc_id"], "item_id": b["item_id"], "n_words": b["n_words"], "run": [r[0] for r in runs], "near": [r[1] for r in runs], "exact": [r[2] for r in runs]}
        )


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, gram, dpos): where the words of ``docs`` (doc_id, w) hold a gram of ``terms``."""
    wanted = terms.select("gram").distinct()
    n = wanted.count()
    return grams(docs, "doc_id", "dpos").join(F.broadcast(wanted) if n <= BROADCAST_TERMS else wanted, "gram")


def seeds(terms: DataFrame, postings: DataFrame) -> DataFrame:
    """(item_id, ipos, gram): of every ``STRETCH`` neighbouring terms of an item the ``SEEDS`` that stand in the corpus least often.

    A term that stands nowhere is rarest of all: it takes a seed's place, as a change may have spoilt it.
    """
    df = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    known = terms.join(df, "gram", "left").select("item_id", "ipos", "gram", F.coalesce("df", F.lit(0)).alias("df"))
    last = F.max("ipos").over(Window.partitionBy("item_id"))
    # the stretches a term lies in, by their first term; a short item is one stretch
    first = known.withColumn("end", F.greatest(last - (STRETCH - 1), F.lit(0)))
    spans = first.withColumn("start", F.explode(F.sequence(F.greatest(F.col("ipos") - (STRETCH - 1), F.lit(0)), F.least("ipos", "end"))))
    rank = F.row_number().over(Window.partitionBy("item_id", "start").orderBy("df", "ipos"))
    return spans.withColumn("k", rank).where((F.col("k") <= SEEDS) & (F.col("df") > 0)).select("item_id", "ipos", "gram").distinct()


def _bands(diag: Column) -> Column:
    """Neighbouring diagonals fall into one of two overlapping bands."""
    return F.array(F.floor(diag / BAND) * 2, F.floor((diag + BAND // 2) / BAND) * 2 + 1)


def _promising(hits: Column, n_words: Column) -> Column:
    """Whether the chain of (dpos, ipos) terms, in text order, leaves room for an accepted run."""
    need = F.least(F.lit(RUN), n_words)
    start = F.struct(*[F.lit(v).alias(k) for k, v in (("d", -9), ("i", -9), ("first", 0))], F.lit(0.0).alias("score"), F.lit(False).alias("ok"))

    def step(a: Column, x: Column) -> Column:
        gi, gd = x["ipos"] - a["i"] - GRAM, x["dpos"] - a["d"] - GRAM
        inner, shift = F.greatest(F.least(gi, gd), F.lit(0)), F.abs(gi - gd)
        edits = F.when((gi == gd) & (gi < 0), 0).otherwise(F.greatest(F.ceil((F.greatest(gi, gd) + GRAM - 1) / GRAM), shift, F.lit(1)))
        gain = GRAM + F.least(F.least(gi, gd), F.lit(0)) + F.greatest(inner - edits, F.lit(0)) - edits * EDIT
        going = (a["i"] >= 0) & (a["score"] + gain > GRAM)
        score = F.when(going, a["score"] + gain).otherwise(float(GRAM))
        first = F.when(going, a["first"]).otherwise(x["ipos"])
        cover = x["ipos"] + GRAM - first
        fine = (cover >= SAFE_RUN) | ((cover >= need - SLACK) & (score >= need - SLACK))
        # terms that repeat within the region leave the chain open: alignment decides
        odd = (a["i"] >= 0) & ((x["ipos"] <= a["i"]) | (x["dpos"] <= a["d"]))
        return F.struct(x["dpos"].alias("d"), x["ipos"].alias("i"), first.alias("first"), score.alias("score"), (a["ok"] | fine | odd).alias("ok"))

    return F.aggregate(hits, start, step)["ok"]


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, run): texts (doc_id, text) holding at least ``RUN`` running words of items (item_id, text)."""
    docs = docs.select("doc_id", "text").where("text <> ''")
    iw = cut(items.select("item_id", plain_words(F.col("text")).alias("w")).where(F.size("w") >= GRAM).distinct())
    terms = cut(grams(iw, "item_id", "ipos").distinct())
    postings = cut(index(docs.select("doc_id", plain_words(F.col("text")).alias("w")), terms))
    pairs = cut(postings.join(seeds(terms, postings), "gram").select("doc_id", "item_id").distinct())
    hits = postings.join(pairs, "doc_id").join(terms, ["item_id", "gram"])
    lengths = iw.groupBy("item_id").agg(F.max(F.size("w")).alias("n_words"))
    region = (
        hits.select("doc_id", "item_id", "ipos", "dpos", F.explode(_bands(F.col("dpos") - F.col("ipos"))).alias("band"))
        .groupBy("doc_id", "item_id", "band")
        .agg(F.sort_array(F.collect_set(F.struct("dpos", "ipos"))).alias("hits"))
        .join(lengths, "item_id")
        .where((F.size("hits") >= F.least(F.lit(HITS), F.col("n_words") - (GRAM - 1))) & _promising(F.col("hits"), F.col("n_words")))
    )
    room = 2 * GRAM
    at = lambda field: F.transform("hits", lambda h: h[field])
    wide = cut(
        region.select(
            "doc_id", "item_id",
            F.greatest(F.array_min(at("dpos")) - room, F.lit(0)).alias("lo"), (F.array_max(at("dpos")) + GRAM + room).alias("hi"),
            F.greatest(F.array_min(at("ipos")) - room, F.lit(0)).alias("ilo"), (F.array_max(at("ipos")) + GRAM + room).alias("ihi"),
        )
    )
    # few texts are left: only theirs are read again, and only regions travel to Python
    texts = docs.join(wide.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", plain_words(F.col("text")).alias("w"))
    cand = wide.join(texts, "doc_id").join(iw.select("item_id", F.col("w").alias("item_words")), "item_id")
    region_words = spread(
        cand.select(
            "doc_id", "item_id", F.size("item_words").alias("n_words"),
            F.slice("item_words", F.col("ilo") + 1, F.col("ihi") - F.col("ilo")).alias("item_words"), F.slice("w", F.col("lo") + 1, F.col("hi") - F.col("lo")).alias("w"),
        )
    )
    runs = region_words.mapInPandas(_verify, "doc_id bigint, item_id bigint, n_words int, run int, near int, exact int")
    sure = (F.col("run") >= SAFE_RUN) | (F.col("near") >= RUN) | (F.col("exact") == F.col("n_words"))
    return runs.where(sure).groupBy("doc_id", "item_id").agg(F.max(F.greatest("run", "near")).alias("run"))
