"""From LSH buckets to components: star-shaped candidates, confirmed, in rounds that lose no pair of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch, uniform
from shopfloor.llm.graph import connected_components

FIRST_CENTRES = 32


def bucket_members(scratch: Scratch, keyed: DataFrame) -> DataFrame:
    """Rows ``(rep, key, ...)`` of buckets with two or more different reps, with the bucket's ``hub`` and ``size``.

    ``keyed`` is a written table with each rep once a bucket.  Most buckets hold one rep, so
    keys are counted alone first; the members that are left are few.
    """
    shared = scratch.save(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    some = scratch.save(keyed.join(shared, "key"), "some")
    hubs = some.groupBy("key").agg(F.min("rep").alias("hub"))
    members = scratch.save(some.join(hubs, "key"), "members")
    scratch.drop(shared, some)
    return members


def one_node(named: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that join all nodes of an id, from rows ``(id, node)`` of ids with several nodes."""
    least = named.groupBy("id").agg(F.min("node").alias("a"))
    return named.join(least, "id").where("node > a").select("a", F.col("node").alias("b")).distinct()


def split_buckets(scratch: Scratch, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that still span several components, with their component ``c``."""
    named = (members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("c", F.coalesce("component", "rep")).drop("component"))
    named = scratch.save(named, "named")
    split = named.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1")
    out = scratch.save(named.join(split.select("key"), "key"), "split")
    scratch.drop(named)
    return out


def bucket_components(scratch: Scratch, members: DataFrame, attrs: list[str], plausible: Callable[[], Column],
                      confirmed: Callable[[DataFrame], DataFrame],
                      refine: Callable[[DataFrame], tuple[DataFrame, list[str], Callable[[], Column], DataFrame]]
                      | None = None, known: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` of all reps that a confirmed pair of some bucket, or a pair ``(a, b)`` of ``known``, links.

    ``plausible()`` compares a pair's ``attrs`` (``x_`` + name at the centre) and
    may refuse only pairs that cannot be links; ``confirmed`` keeps the true
    links of a table of distinct pairs ``(a, b)``.

    First every bucket's smallest rep is the centre of a star.  A star can miss
    links between its leaves, so a bucket that still spans several components
    goes on.  ``refine`` may add links and sharper attributes to what is left.
    Then, in each round, twice as many members, in a hash order, are centres, and
    only pairs from different components are tested, each in the first bucket
    that both share.  It ends when every pair of a bucket has been tested or
    lies in one component.
    """
    def at_centre(names: list[str]) -> list[Column]:
        return [F.col(c).alias(f"x_{c}") for c in names]

    hubs = members.where("rep = hub").select("key", *at_centre(attrs))
    star = (members.where("rep > hub").join(hubs, "key").where(plausible())
            .select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    links = scratch.save(confirmed(star), "links")
    links = links if known is None else links.unionByName(known)
    labels = connected_components(scratch, links)
    rest = split_buckets(scratch, members.select("key", "rep", "size", *attrs), labels)
    if refine is not None and rest.limit(1).count():
        rest, attrs, plausible, more = refine(rest)
        links = links.unionByName(more)
        labels = connected_components(scratch, links)
        rest = split_buckets(scratch, rest.select("key", "rep", "size", *attrs), labels)
    own = rest.groupBy("rep").agg(F.collect_set("key").alias("keys"))  # at most one per band or probe
    members = scratch.save(rest.join(own, "rep").select("key", "rep", "size", "keys", *attrs), "open")
    first_shared = F.array_min(F.array_intersect("keys", "x_keys")) == F.col("key")
    done = 0
    while True:
        high = 2 * done + FIRST_CENTRES
        rest = split_buckets(scratch, members.where(F.col("size") > done), labels)
        if not rest.limit(1).count():
            scratch.drop(rest, members)
            return labels
        placed = rest.withColumn("u", uniform("rep") * F.col("size"))
        centres = placed.where((F.col("u") >= done) & (F.col("u") < high)).select(
            "key", F.col("rep").alias("x"), F.col("c").alias("x_c"), F.col("keys").alias("x_keys"), *at_centre(attrs))
        others = placed.where(F.col("u") >= done).select("key", "rep", "c", "u", "keys", *attrs)
        new = ((F.col("u") >= high) | (F.col("rep") < F.col("x"))) & (F.col("c") != F.col("x_c"))
        pairs = (centres.join(others, "key").where(new & plausible() & first_shared)
                 .select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct())
        more = scratch.save(confirmed(pairs), "links")
        scratch.drop(rest)
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = connected_components(scratch, links)
        done = high
