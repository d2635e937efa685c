"""Distributed similarity join over sparse n-gram vectors, and average-linkage clustering of its pairs.

A text's vector holds its distinct character n-grams, weighted by inverse document frequency and scaled to length one.
Two vectors with cosine >= t must share an n-gram among each other's *prefix*: the rarest n-grams, up to the point
where what is left is shorter than t. Only prefixes go into the inverted index, so frequent n-grams make no postings;
every candidate is then verified on whole vectors. The join is exact: no pair at or above the threshold is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut, discard, shuffle_tasks, spread

#: A posting list longer than this is met in slices of this length.
SLICE = 5000
#: Most edges of a connected component that one task clusters.
BOUNDED = 20_000


def gram_array(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct character n-grams of ``^text$``; empty for null and for texts shorter than the n-gram."""
    padded = F.concat(F.lit("^"), F.coalesce(text, F.lit("")), F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - (n - 1))
        grams = F.transform(starts, lambda i: F.substr(padded, i, F.lit(n)))
        return F.when(F.length(padded) >= n, grams).otherwise(F.array().cast("array<string>"))

    one = [of_size(n) for n in sizes]
    return F.array_distinct(F.concat(*one))


def vectors(items: DataFrame, text: str, sizes: Sequence[int]) -> DataFrame:
    """``items`` (with a unique ``id``) plus vec: array of (gram, w), rarest first, of length one."""
    grams = items.select("id", F.explode(gram_array(F.col(text), sizes)).alias("gram"))
    n = max(items.count(), 1)
    weights = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    weights = weights.withColumn("w", F.log(1 + F.lit(float(n)) / F.col("df")))
    vec = (
        grams.join(weights, "gram")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("df", "gram", "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        .select(
            "id",
            F.transform("v", lambda x: F.struct(x["gram"].alias("gram"), (x["w"] / F.col("norm")).alias("w"))).alias("vec"),
        )
    )
    return items.join(vec, "id")


def prefix_length(vec: Column, threshold: float) -> Column:
    limit = threshold * threshold - 1e-9
    start = F.struct(F.lit(1.0).alias("rest"), F.lit(0).alias("k"))
    end = F.aggregate(
        vec,
        start,
        lambda a, x: F.when(
            a["rest"] >= limit, F.struct((a["rest"] - x["w"] * x["w"]).alias("rest"), (a["k"] + 1).alias("k"))
        ).otherwise(a),
    )
    return F.greatest(end["k"], F.lit(1))


def cosine(a: Column, b: Column) -> Column:
    """Dot product of two unit vectors."""
    other = F.map_from_arrays(F.transform(b, lambda x: x["gram"]), F.transform(b, lambda x: x["w"]))
    return F.aggregate(
        F.transform(a, lambda x: x["w"] * F.coalesce(F.try_element_at(other, x["gram"]), F.lit(0.0))),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def similar_pairs(
    items: DataFrame,
    text: str,
    threshold: float,
    sizes: Sequence[int] = (2, 3),
    block: Sequence[str] = (),
    ordered: Column | None = None,
    also: Column | None = None,
) -> DataFrame:
    """(a, b, cos) of items of equal ``block`` values with cosine >= ``threshold``.

    Without ``ordered`` every pair comes once, a < b. ``ordered`` is a condition on the columns of ``l`` and ``r``
    (aliases of the two items, their texts as ``text``) that says which pairs to form instead; ``also`` is one more
    that every pair must meet, checked before the dearer cosine.
    """
    vec = cut(vectors(items, text, sizes))
    posting = vec.withColumn("gram", F.explode(F.slice("vec", F.lit(1), prefix_length(F.col("vec"), threshold)))).withColumn(
        "gram", F.col("gram.gram")
    )
    light = posting.drop("vec").withColumnRenamed(text, "text")
    wanted = ordered if ordered is not None else F.col("l.id") < F.col("r.id")
    pairs = spread(meet(cut(light), ["gram", *block], wanted if also is None else wanted & also))
    return verified(pairs, vec, threshold)


def verified(pairs: DataFrame, vec: DataFrame, threshold: float) -> DataFrame:
    """(a, b, cos) of those pairs (a, b) whose :func:`vectors` have cosine >= ``threshold``."""
    v = vec.select("id", "vec")
    both = pairs.join(v.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a").join(
        v.select(F.col("id").alias("b"), F.col("vec").alias("vb")), "b"
    )
    return both.select("a", "b", cosine(F.col("va"), F.col("vb")).alias("cos")).where(F.col("cos") >= threshold)


def meet(rows: DataFrame, keys: Sequence[str], on: Column) -> DataFrame:
    """(a, b): the distinct pairs of ids of ``rows`` (id, ...) with equal ``keys`` that fulfil ``on``, a condition on ``l`` and ``r``.

    Few bytes are much work here, so the join has as many tasks as the session's shuffles, whatever the size. Spark does not
    split a shuffle that was asked for, so rows of a long key are split here: one side in slices of ``SLICE`` rows, the other
    once for each slice. Where no key is long, both sides read one shuffle.
    """
    tasks = shuffle_tasks(rows.sparkSession)
    long = cut(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices")).where("slices > 1"))
    if long.isEmpty():
        discard(long)
        every = own = rows.repartition(tasks, *keys)
    else:
        known = rows.join(long, list(keys), "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
        every = known.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).repartition(tasks, *keys, "slice")
        own = known.withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).repartition(tasks, *keys, "slice")
        keys = [*keys, "slice"]
    for k in reversed(keys):
        on = (F.col(f"l.{k}") == F.col(f"r.{k}")) & on
    return every.alias("l").join(own.alias("r"), on).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()


def best_partners(pairs: DataFrame, n: int) -> DataFrame:
    """Of (a, b, cos) the ``n`` most similar b of each a; ties at the end are all kept."""
    w = Window.partitionBy("a").orderBy(F.col("cos").desc())
    return pairs.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= n).drop("rank")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of nodes with edges (a, b): the smallest node connected with each.

    Each round links every node's neighbours, and the node itself, to the smallest of them, in both directions of growth
    (large and small stars), so distances halve and the rounds are about the logarithm of the longest path.
    """
    near = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = near.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after = cut(small)
        # a forest of stars stays as it is
        same = after.join(near, ["u", "v"], "left_anti").isEmpty() and near.join(after, ["u", "v"], "left_anti").isEmpty()
        discard(near)
        near = after
        if same:
            return near.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(near.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def merge_rounds(edges: Iterable[tuple[str, str, float]], threshold: float) -> dict[str, str]:
    """Cluster of each node of ``edges`` (a, b, sim), in rounds that merge all pairs of clusters nearest to each other."""
    near: dict[str, dict[str, float]] = {}
    for a, b, sim in edges:
        near.setdefault(a, {})[b] = sim
        near.setdefault(b, {})[a] = sim
    size = dict.fromkeys(near, 1)
    into = {n: n for n in near}
    while True:
        best = {}
        for x, ys in near.items():
            found = min(((-total / (size[x] * size[y]), y) for y, total in ys.items()), default=None)
            if found is not None and -found[0] >= threshold:
                best[x] = found[1]
        merges = [(x, y) for x, y in best.items() if x > y and best.get(y) == x]
        if not merges:
            break
        for old, new in merges:
            into[old] = new
            size[new] += size.pop(old)
            for y, total in near.pop(old).items():
                del near[y][old]
                if y != new:
                    near[new][y] = near[new].get(y, 0.0) + total
                    near[y][new] = near[new][y]

    def root(n: str) -> str:
        while into[n] != n:
            n = into[n]
        return n

    return {n: root(n) for n in into}


def average_linkage(edges: DataFrame, threshold: float) -> DataFrame:
    """(id, cluster) of nodes with edges (a, b, sim), by average linkage down to ``threshold``.

    Pairs without an edge have similarity 0. Each round merges all pairs of clusters that are each other's nearest,
    which for average linkage gives the same tree as merging one pair at a time; sums of similarities of merged
    clusters are added up. Ties go to the smallest id. A cluster's id is its smallest member's.

    Clusters merge only if some edge between them reaches the threshold, so components connected by such edges are
    independent and edges between them decide nothing; nodes without such an edge are left out. Components of at most ``BOUNDED`` edges run all their rounds in one task each, larger
    ones in rounds over the whole table, so no component of unknown size is gathered; both follow the same rule.
    """
    links = cut(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim")
        .where("a <> b")
        .groupBy("a", "b")
        .agg(F.max("sim").alias("total"))
    )
    # an average may round up to the threshold
    found = components(links.where(F.col("total") >= threshold - 1e-9))
    ra, rb = found.select(F.col("id").alias("a"), "root"), found.select(F.col("id").alias("b"), F.col("root").alias("root_b"))
    named = cut(links.join(ra, "a").join(rb, "b").where("root = root_b").select("root", "a", "b", "total"))
    large = named.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BOUNDED).select("root")
    large = cut(large)

    def clusters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, roots = [], []
            for e in zip(batch["a"], batch["b"], batch["total"], strict=True):
                got = merge_rounds(zip(*e, strict=True), threshold)
                ids += got.keys()
                roots += got.values()
            yield pd.DataFrame({"id": ids, "cluster": roots})

    # a component's edges are one row
    gathered = named.join(large, "root", "left_anti").groupBy("root").agg(F.collect_list(F.struct("a", "b", "total")).alias("e"))
    rows = gathered.select("e.a", "e.b", "e.total")
    small = cut(rows.mapInPandas(clusters, "id string, cluster string"))
    if large.isEmpty():
        return small
    rest = cut(named.join(large, "root", "left_semi").select("a", "b", "total"))
    return small.unionByName(_rounds(rest, threshold))


def _rounds(links: DataFrame, threshold: float) -> DataFrame:
    """(id, cluster): the rounds of :func:`average_linkage` over a table of links (a, b, total) of any size."""
    nodes = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("cluster", F.col("id"))
    nodes = cut(nodes)
    sizes = nodes.select(F.col("id").alias("c")).withColumn("n", F.lit(1).cast("long"))
    while True:
        na = sizes.select(F.col("c").alias("a"), F.col("n").alias("na"))
        nb = sizes.select(F.col("c").alias("b"), F.col("n").alias("nb"))
        scored = links.join(na, "a").join(nb, "b").withColumn("avg", F.col("total") / (F.col("na") * F.col("nb")))
        scored = scored.where(F.col("avg") >= threshold)
        ends = scored.select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e"),
            "avg",
        ).select("e.*", "avg")
        nearest = ends.groupBy("x").agg(F.min(F.struct((-F.col("avg")).alias("d"), F.col("y"))).getField("y").alias("y"))
        mutual = nearest.alias("p").join(
            nearest.alias("q"), (F.col("p.y") == F.col("q.x")) & (F.col("q.y") == F.col("p.x")) & (F.col("p.x") > F.col("p.y"))
        )
        merge = cut(mutual.select(F.col("p.x").alias("old"), F.col("p.y").alias("new")))
        if merge.isEmpty():
            break

        def renamed(df: DataFrame, column: str) -> DataFrame:
            m = merge.select(F.col("old").alias(column), "new")  # noqa: B023
            return df.join(m, column, "left").withColumn(column, F.coalesce("new", column)).drop("new")

        old = (nodes, sizes, links, merge)
        nodes = cut(renamed(nodes, "cluster"))
        sizes = cut(renamed(sizes, "c").groupBy("c").agg(F.sum("n").alias("n")))
        moved = renamed(renamed(links, "a"), "b").where("a <> b")
        links = cut(
            moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "total")
            .groupBy("a", "b")
            .agg(F.sum("total").alias("total"))
        )
        discard(*old)
    return nodes
