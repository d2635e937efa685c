"""Reading level of texts: how large a frequency-ranked vocabulary covers them, and how complex their sentences are.

A word's rank is the number of words at least as frequent in the whole corpus; it comes from a histogram of word
counts, so no task ever sees the vocabulary whole. A text's coverage rank at share s is the smallest vocabulary, taken
by rank, that covers s of its words. Coverage ranks at three shares, sentence length and word length are calibrated on
labelled texts by a ridge regression on their products, and the fit is applied as a column expression.

The fit uses at most ``MAX_LABELS`` labelled texts, chosen by a hash of their ids; everything else reads all rows.

Defined results: texts without a single word (blank, digits only) have level 1; null and empty texts have no row;
without labels the fit has nothing to go by and every text has level 3; texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut

SHARES = (0.5, 0.75, 0.9)
MAX_LABELS = 20_000
RIDGE = 0.3
FEATURES = ["cover50", "cover75", "cover90", "sentence_mean", "sentence_median", "letters", "long7", "long10"]


def clean(text: Column) -> Column:
    t = F.regexp_replace(text, "[­​‌‍⁠﻿]", "")
    t = F.regexp_replace(t, r"<[^<>]*>", " ")
    return F.regexp_replace(t, r"&#?[A-Za-z0-9]{2,8};", " ")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))


def word_ranks(words: DataFrame) -> DataFrame:
    """(word, rank) from (word, n) rows of any granularity."""
    counts = words.groupBy("word").agg(F.sum("n").alias("c"))
    histogram = counts.groupBy("c").agg(F.count(F.lit(1)).alias("words"))
    # one row for each distinct count, at most about the square root of twice the corpus' words
    order = Window.orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.join(histogram.select("c", F.sum("words").over(order).alias("rank")), "c").select("word", "rank")


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, FEATURES) of texts (doc_id, text) that hold a word.

    Texts are read and split once, into a table of their words; ranks and shapes both start from that table.
    """
    split = docs.select("doc_id", F.transform(F.split(clean(F.col("text")), r"[.!?]+(?:\s|$)|\n+"), _words).alias("sentences"))
    base = split.select("doc_id", F.flatten("sentences").alias("w"), F.filter(F.transform("sentences", F.size), lambda n: n > 0).alias("s"))
    base = cut(base.where("size(w) > 0"))
    per = cut(base.select("doc_id", F.explode("w").alias("word")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n")))
    ranked = per.join(word_ranks(per), "word").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("rank", "n"))).alias("r"), F.sum("n").alias("total"))

    def cover(share: float) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).cast("bigint").alias("rank"))
        reached = F.aggregate(
            "r",
            start,
            lambda a, x: F.when(
                a["seen"] <= F.col("total") * share, F.struct((a["seen"] + x["n"]).alias("seen"), x["rank"].alias("rank"))
            ).otherwise(a),
        )
        return F.log(reached["rank"].cast("double"))

    covers = ranked.select("doc_id", *[cover(s).alias(f"cover{round(s * 100)}") for s in SHARES])
    lengths = F.transform("w", lambda x: F.length(x))

    def mean(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)

    shape = base.select("doc_id", "s", lengths.alias("l")).select(
        "doc_id",
        F.log(mean(F.col("s"))).alias("sentence_mean"),
        F.log(F.get(F.sort_array("s"), F.floor(F.size("s") / 2).cast("int")) + 1.0).alias("sentence_median"),
        mean(F.col("l")).alias("letters"),
        mean(F.transform("l", lambda x: F.when(x >= 7, 1.0).otherwise(0.0))).alias("long7"),
        mean(F.transform("l", lambda x: F.when(x >= 10, 1.0).otherwise(0.0))).alias("long10"),
    )
    return covers.join(shape, "doc_id").select("doc_id", *FEATURES)


def _terms(n: int) -> list[tuple[int, ...]]:
    return [(), *[(i,) for i in range(n)], *[(i, j) for i in range(n) for j in range(i, n)]]


def calibrate(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights of the fit from (doc_id, FEATURES, reading_level), at most ``MAX_LABELS`` rows of it."""
    rows = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS).select(*FEATURES, "reading_level").toPandas().to_numpy(dtype=float)
    n = len(FEATURES)
    if not len(rows):
        weights = np.zeros(len(_terms(n)))
        weights[0] = 3.0
        return np.zeros(n), np.ones(n), weights
    x, y = rows[:, :n], rows[:, n]
    mean, scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = (x - mean) / scale
    a = np.stack([np.prod(z[:, list(t)], axis=1) if t else np.ones(len(z)) for t in _terms(n)], axis=1)
    penalty = RIDGE * np.eye(a.shape[1])
    penalty[0, 0] = 0.0
    return mean, scale, np.linalg.solve(a.T @ a + penalty, a.T @ y)


def level(fit: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    mean, scale, weights = fit
    z = [(F.col(f) - float(m)) / float(s) for f, m, s in zip(FEATURES, mean, scale, strict=True)]
    total = F.lit(0.0)
    for t, w in zip(_terms(len(FEATURES)), weights, strict=True):
        term = F.lit(float(w))
        for i in t:
            term = term * z[i]
        total = total + term
    return F.greatest(F.lit(1), F.least(F.lit(5), F.round(total).cast("int"))).cast("int")


def reading_levels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, reading_level) of all ``docs`` (doc_id, text): null and empty texts have none."""
    given = docs.where("text <> ''")
    measured = cut(features(given))
    fit = calibrate(measured.join(labels.where("reading_level IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id"))
    scored = measured.select("doc_id", level(fit).alias("reading_level"))
    return given.select("doc_id").distinct().join(scored, "doc_id", "left").select("doc_id", F.coalesce("reading_level", F.lit(1)).alias("reading_level"))
