"""Connected components of things that share buckets, without the pairs of a bucket.

A bucket of g members offers g² pairs, but only components are wanted. So every bucket first links its members to one
hub, the member that shares most places with others; verified links are joined into components. What a hub cannot
decide is left to the second step: pairs of one bucket whose members still lie in different components, thinned by a
cheap necessary condition inside the join. Together these verify every pair that could still join two components, so
the components are those of all verified pairs of all buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cellframe.llm.shared import keep

Verify = Callable[[DataFrame], DataFrame]
Near = Callable[[str, str], Column]
Sides = tuple[DataFrame, DataFrame, Near]
Narrow = Callable[[DataFrame, DataFrame], list[Sides]]


def components(edges: DataFrame) -> DataFrame:
    """(id, label): for each id in ``edges`` (a, b), the smallest id it is connected with.

    Each round hooks every vertex to its smallest neighbour, follows hooks once, and contracts the edges; a chain or a
    star takes a logarithmic number of rounds in practice. All tables are joined and grouped by key, nothing returns to
    the driver but a count, and every round's hooks and edges are written to the shared folder.
    """
    edges = keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    left = edges.count()
    while left:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("id"), F.least("a", "m").alias("to")
        )
        next_hook = hooks.select(F.col("id").alias("to"), F.col("to").alias("then"))
        hooks = keep(hooks.join(next_hook, "to", "left").select("id", F.coalesce("then", "to").alias("to")))
        if labels is None:
            labels = hooks.select("id", F.col("to").alias("label"))
        else:
            step = hooks.select(F.col("id").alias("label"), "to")
            labels = labels.join(step, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
        for end in ("a", "b"):
            step = hooks.select(F.col("id").alias(end), F.col("to").alias(f"{end}_to"))
            edges = edges.join(step, end, "left").withColumn(end, F.coalesce(f"{end}_to", end)).drop(f"{end}_to")
        edges = keep(
            edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
        left = edges.count()
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return keep(labels)


def link(members: DataFrame, describe: Callable[[DataFrame], DataFrame], near: Near, verify: Verify,
         narrow: Narrow | None = None) -> DataFrame:
    """(id, label) of all ids that have a verified link.

    ``members`` (key, id) are the buckets, without repeated rows. ``describe`` gets (id) and returns (id, …), what
    ``near(x, y)`` and ``verify`` compare: ``near`` gets the names of two structs of these columns and must hold for
    every pair that ``verify`` accepts. ``verify`` takes (a, b, of_a, of_b) with a < b and returns rows of (a, b).

    ``narrow`` gets the members that are left for the second step, (key, id, label, of), and all descriptions, (id, of). It says
    what to compare there: pairs of tables (key, id, label, of), with an ``of`` of their own, and what a member a of the first and
    one b of the second must fulfil. For every pair that ``verify`` accepts this must hold in one bucket at least, in one order
    of the two. Without ``narrow`` all members of a bucket are compared by ``near``.
    """
    shared = members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    multi = keep(members.join(shared.select("key"), "key"))
    sizes = multi.groupBy("key").agg(F.count("id").alias("n"))
    fame = multi.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("fame"))
    hubs = (
        multi.join(fame, "id").groupBy("key").agg(F.max(F.struct("fame", "id")).alias("hub")).select("key", "hub.id")
        .withColumnRenamed("id", "hub")
    )
    pairs = multi.join(hubs, "key").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    ).where("a < b").distinct()
    described = keep(describe(multi.select("id").distinct()))
    described = described.select("id", F.struct(*[c for c in described.columns if c != "id"]).alias("of"))

    def with_description(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(described.select(F.col("id").alias(end), F.col("of").alias(f"of_{end}")), end)
        return pairs

    def verified(pairs: DataFrame) -> DataFrame:
        return keep(verify(with_description(pairs).where(near("of_a", "of_b"))).select("a", "b").distinct())

    edges = verified(pairs)
    labels = components(edges)
    labelled = multi.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    rest = labelled.join(mixed.select("key"), "key").join(described, "id")
    everything: list[Sides] = [(rest, rest, lambda x, y: F.expr("a < b") & near(x, y))]
    late = None
    for *sides, holds in narrow(rest, described) if narrow else everything:
        one, two = (
            side.select(F.col("key").alias(f"k_{end}"), F.col("id").alias(end), F.col("label").alias(f"l_{end}"),
                        F.col("of").alias(f"of_{end}"))
            for side, end in zip(sides, ("a", "b"))
        )
        found = one.join(two, F.expr("k_a = k_b AND l_a <> l_b") & holds("of_a", "of_b")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        late = found if late is None else late.unionByName(found)
    late = late.distinct()
    more = verified(late.join(pairs, ["a", "b"], "left_anti"))
    return labels if more.isEmpty() else components(edges.unionByName(more))
