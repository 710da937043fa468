"""Verified links between members of shared buckets, and connected components (native)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_checked, stored, thinned

#: Buckets up to this size compare all their pairs; members of larger ones meet a guide first.
SMALL_BUCKET = 16
#: Further guides that the ids far from a guide meet at most; what they leave is found by what it differs in.
GUIDES = 4
#: Tokens that ``_differing_mates`` shuffles at a time: so many, or so many for each entry where that is more. Disk is held by one round's.
ROUND_TOKENS, ENTRY_TOKENS = 32_000_000, 4
#: Slack of comparisons with fractions.
TINY = 1e-9


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every id has one parent and no parent has one itself."""
    roles = edges.select(F.col("b").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("a").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = roles.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Union-find over edges (a, b) by alternating large-star and small-star steps.

    Returns (id, label), the least id of its component, for every id that has an edge. Each
    step hooks neighbours to the least one among them and is written to the shared folder, where
    it replaces the step before; rounds grow with the logarithm of the longest path. No step
    gathers a node's neighbours: the least is a partial aggregate, and hooking is a join.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b").where("a <> b")
        large = stored(large, "large-star")
        discard(edges)
        least = large.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "u")
        small = large.join(least, F.col("b") == F.col("u")).select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        edges = stored(small, "small-star")
        discard(large)
    ids = edges.select(F.col("b").alias("id"), F.col("a").alias("label"))
    labels = stored(ids.unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("label"))).distinct(), "labels")
    discard(edges)
    return labels


def _with_sets(pairs: DataFrame, grams: DataFrame, sets: Callable[[Column], Column] | None, least: float = 0.0) -> DataFrame:
    """Pairs (a, b) with their sets (a_set, b_set) and sizes (a_n, b_n); those that their sizes keep below ``least`` go."""
    left, right = (grams.select(F.col("id").alias(x), F.col("grams").alias(f"{x}_set"), F.col("n").alias(f"{x}_n")) for x in "ab")
    both = pairs.join(right, "b").join(left, "a")
    if least:
        both = both.where(F.least("a_n", "b_n") >= (least - TINY) * F.greatest("a_n", "b_n"))
    return both.withColumns({x: sets(F.col(x)) for x in ("a_set", "b_set")}) if sets else both


def _of_similar_size(pairs: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sizes allow a Jaccard similarity of ``threshold``; no set is shuffled for that."""
    sizes = [grams.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n")) for x in "ab"]
    both = pairs.join(sizes[1], "b").join(sizes[0], "a")
    return both.where(F.least("a_n", "b_n") >= (threshold - TINY) * F.greatest("a_n", "b_n")).select("a", "b")


def _paired(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """The sets of the ids in a stored frame of pairs (a, b) and few others, so hardly more than these are shuffled."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "paired")
    return thinned(grams, ids, ["id"], ["id"])


def _near(pairs: DataFrame, grams: DataFrame, sets: Callable[[Column], Column] | None, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of ``threshold`` or more."""
    both = _with_sets(pairs, grams, sets, threshold)
    both = both.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("n"), F.size(F.array_intersect("a_set", "b_set")).alias("common"))
    return both.where(F.col("common") >= (threshold - TINY) * (F.col("n") - F.col("common"))).select("a", "b")


def _guided(large: DataFrame) -> DataFrame:
    """(guide, id): each member of a large bucket beside the bucket's guide, the id whose buckets are fullest.

    That is what near copies were made from, if it is there.
    """
    weighed = large.join(large.groupBy("id").agg(F.sum("size").alias("mass")), "id")
    fullest = weighed.groupBy("key").agg((-F.max(F.struct("mass", (-F.col("id")).alias("minus")))["minus"]).alias("guide"))
    return large.join(fullest, "key").where("guide <> id").select("guide", "id").distinct()


def _differing_mates(guided: DataFrame, labels: DataFrame, threshold: float, most: int) -> DataFrame:
    """Stored pairs (a, b) of ids of one guide that may be near and of which one at least isn't near the guide.

    ``guided`` has (guide, id, tokens, d, i, g, w): ``tokens`` are the elements in which the id
    and its guide differ (d of the guide's that the id lacks, i of its own). With c = threshold /
    (1 + threshold), w = (1 - c) d + c i and g = (1 - 2 c) * (size of the guide), an id is near
    the guide if w <= g, and two ids are near only if they share w + w' - g tokens. Where one is
    not near the guide that is more than none, so prefix filtering is exact: with tokens
    ordered from the rarest, two such ids share one among the first few of each, and
    enough tokens follow it in both. Tokens go by a hash of 32 bits: tokens that it takes for one
    can but add pairs. Guides are dealt to rounds of some ``most`` tokens.
    """
    far = F.col("w") > F.col("g") + TINY
    bounds = guided.groupBy("guide").agg(F.min(F.when(far, F.col("w"))).alias("far_w"), F.min("w").alias("least_w")).where("far_w IS NOT NULL")
    some = join_checked(guided, stored(bounds, "bounds"), "guide").withColumn("far", far)
    shared = F.col("w") - F.col("g") + F.when(F.col("far"), F.col("least_w")).otherwise(F.col("far_w"))
    some = some.withColumn("head", (F.col("d") + F.col("i") - F.ceil(shared - TINY) + 1).cast("int")).where("head > 0")
    # Tokens move without what is the same for all tokens of an id.
    heads = some.select("guide", "id", "far", "head", "d", "i", "g", "w").join(labels, "id", "left")
    heads = stored(heads.withColumn("label", F.coalesce("label", "id")), "heads")
    rounds = max(1, -(-(heads.agg(F.sum(F.col("d") + F.col("i"))).first()[0] or 0) // most))
    turn = F.pmod(F.xxhash64("guide"), F.lit(rounds))
    pairs = [_sharing(some.where(turn == at), heads.where(turn == at)) for at in range(rounds)]
    discard(heads)
    return pairs[0] if rounds == 1 else stored(reduce(DataFrame.unionByName, pairs).distinct(), "mates")


def _sharing(some: DataFrame, heads: DataFrame) -> DataFrame:
    """Stored pairs (a, b) that ``_differing_mates`` finds under some guides."""
    tokens = some.select("guide", "id", F.explode("tokens").alias("token")).select("guide", "id", F.hash("token").alias("token"))
    rarity = tokens.groupBy("guide", "token").agg(F.count(F.lit(1)).cast("int").alias("rarity")).where("rarity > 1")
    # A token that no other id has can't be shared; it still takes its place among the first, so places are counted from the end.
    ordered = tokens.join(rarity, ["guide", "token"]).withColumn("rest", F.row_number().over(Window.partitionBy("guide", "id").orderBy(F.desc("rarity"), F.desc("token"))))
    first = ordered.join(heads, ["guide", "id"]).where(F.col("d") + F.col("i") - F.col("rest") + 1 <= F.col("head"))
    first = stored(first.select("guide", "token", "id", "far", "label", "d", "i", "g", "w", "rest"), "rare-tokens")
    other = first.select(*[F.col(x).alias(f"{x}_") for x in ("guide", "token", "id", "far", "label", "d", "i", "w", "rest")])
    due = F.col("w") + F.col("w_") - F.col("g") - TINY
    enough = (F.least("rest", "rest_") >= due) & (F.least("d", "d_") + F.least("i", "i_") >= due)
    once = (F.col("id") < F.col("id_")) | ~F.col("far_")
    pairs = first.where("far").join(other, (F.col("guide") == F.col("guide_")) & (F.col("token") == F.col("token_")) & (F.col("label") != F.col("label_")) & once & enough)
    pairs = stored(pairs.select(F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")).distinct(), "sharing")
    discard(first)
    return pairs


def _further_guides(guided: DataFrame, members: DataFrame, grams: DataFrame, sets: Callable[[Column], Column] | None, threshold: float) -> DataFrame | None:
    """Stored links (a, b) between ids that are far from their guide and further guides chosen among them.

    A family of near copies that shares a bucket with a larger one is far from its guide as a whole. In
    every round the fullest id of what a guide has left far is the next guide of these, so such a family becomes one
    component by as many comparisons as it has members, and its pairs need not be compared.
    """
    mass = members.groupBy("id").agg(F.sum("size").alias("mass"))
    rest = stored(guided.where(F.col("w") > F.col("g") + TINY).select("guide", "id").join(mass, "id"), "far")
    # Hardly more than the sets of ids that are far are shuffled.
    grams = thinned(grams, stored(rest.select("id").distinct(), "far-ids"), ["id"], ["id"])
    links = None
    for _ in range(GUIDES):
        next_ = rest.groupBy("guide").agg(F.count(F.lit(1)).alias("size"), (-F.max(F.struct("mass", (-F.col("id")).alias("minus")))["minus"]).alias("next")).where(F.col("size") > SMALL_BUCKET)
        next_ = stored(next_.select(F.col("guide").alias("guide_"), "next"), "next-guides")
        if next_.isEmpty():
            break
        beside = stored(rest.join(next_, F.col("guide") == F.col("guide_")).select("guide", "next", "id", "mass"), "beside-next")
        pairs = beside.where("next <> id").select(F.least("next", "id").alias("a"), F.greatest("next", "id").alias("b")).distinct()
        found = stored(_near(pairs, grams, sets, threshold), "next-links")
        links = found if links is None else links.unionByName(found)
        known = found.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(found.select(F.col("b").alias("x"), F.col("a").alias("y")))
        left = stored(beside.where("next <> id").join(known, (F.col("next") == F.col("x")) & (F.col("id") == F.col("y")), "left_anti").select("guide", "id", "mass"), "far")
        discard(rest)
        discard(beside)
        rest = left
    return links


def link_buckets(entries: DataFrame, grams_of: Callable[[DataFrame], DataFrame], threshold: float, sets: Callable[[Column], Column] | None = None) -> DataFrame:
    """Components of the graph that links bucket mates of similarity ``threshold`` or more.

    ``entries`` is a stored frame (id, keys): ids that share a key are candidates. ``grams_of``
    gives (id, grams), arrays of distinct hashes, for a frame of ids; with ``sets`` it gives
    (id, grams, n) where ``sets`` of a pair's grams, taken when the pair is compared, are the
    arrays and n their size, so what is shuffled can be the shorter text. ``entries`` is not
    read any more once ``grams_of`` is called. Returns (id, label)
    for ids with a link. Not every pair of a bucket is compared, yet no link that would join two
    components is missed: small buckets compare all pairs; a member of a large one is compared
    with the bucket's guide; two members near the guide are in one component already, and of
    all other pairs those that can be near are found by what they share beside the
    guide (``_differing_mates``), once ids far from a guide have met further ones (``_further_guides``).
    """
    most = max(ROUND_TOKENS, ENTRY_TOKENS * entries.count())
    exploded = entries.select("id", F.explode("keys").alias("key"))
    buckets = stored(exploded.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("size")).where("least < most"), "buckets")
    # Buckets of the same two ids say the same once.
    twins = buckets.where("size = 2").select(F.col("least").alias("a"), F.col("most").alias("b")).distinct()
    # Most keys have no mate; a bitmap tells most of them, so they don't move a second time.
    crowds = buckets.where("size > 2")
    members = stored(thinned(exploded, crowds, ["key"], ["key"]).join(crowds, "key").select("key", "id", "size").distinct(), "members")
    ids = stored(twins.select(F.explode(F.array("a", "b")).alias("id")).unionByName(members.select("id")).distinct(), "candidates")
    grams = grams_of(ids)
    grams = stored(grams if sets else grams.withColumn("n", F.size("grams")), "grams")
    discard(ids)

    few = members.where(F.col("size") <= SMALL_BUCKET).select("key", "id")
    close = few.join(few.withColumnRenamed("id", "b"), "key").where("id < b").select(F.col("id").alias("a"), "b")
    c = threshold / (1 + threshold)
    beside = stored(_guided(members.where(F.col("size") > SMALL_BUCKET)).select(F.col("guide").alias("a"), F.col("id").alias("b")), "beside")
    guided = _with_sets(beside, _paired(beside, grams), sets)
    guided = guided.select(F.col("a").alias("guide"), F.col("b").alias("id"), "a_n", F.array_except("a_set", "b_set").alias("lacking"), F.array_except("b_set", "a_set").alias("own"))
    guided = guided.select("guide", "id", F.concat("lacking", "own").alias("tokens"), F.size("lacking").alias("d"), F.size("own").alias("i"), (F.col("a_n") * (1 - 2 * c)).alias("g"))
    guided = stored(guided.withColumn("w", F.col("d") * (1 - c) + F.col("i") * c), "guided")
    links = guided.where(F.col("w") <= F.col("g") + TINY).select(F.least("guide", "id").alias("a"), F.greatest("guide", "id").alias("b"))
    others = twins.unionByName(close).distinct().join(guided.select(F.least("guide", "id").alias("a"), F.greatest("guide", "id").alias("b")), ["a", "b"], "left_anti")
    others = stored(_of_similar_size(others, grams, threshold), "similar-sizes")
    discard(buckets)
    discard(beside)
    links = stored(links.unionByName(_near(others, _paired(others, grams), sets, threshold)), "links")
    further = _further_guides(guided, members, grams, sets, threshold)
    links = links if further is None else stored(links.unionByName(further), "links")
    labels = connected_components(links)
    discard(members)
    mates = _differing_mates(guided, labels, threshold, most)
    discard(guided)
    mates = stored(_of_similar_size(mates, grams, threshold), "similar-sizes")
    found = stored(_near(mates, _paired(mates, grams), sets, threshold), "links")
    discard(grams)
    return labels if found.isEmpty() else connected_components(links.unionByName(found))
