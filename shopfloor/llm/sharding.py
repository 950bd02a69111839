"""Operator 10: balanced label propagation into shards of nearly equal bytes.

Documents are linked by a group (equal texts).  Large groups (at most shards / LUMP
of them) are placed first, whole where a shard has room, else over as few shards
as can be.  All other linked documents start in shards by hash.  In every round
each group looks at its bytes per shard (pre-aggregated) and its members
elsewhere want to join the shard that holds most of it, its home.  A shard admits
its room and what leaves it in the same round; where more bytes want to come, a
seeded share of the parts moves.  A group whose home stays without room
moves as a whole to shards with room, also ones it did not touch, so no group
that a shard can hold stays cut.  The rounds are joins on written tables and end
when no move is admitted.

Documents without a link have no edge to cut.  They fill the shards up to equal
bytes in a hash order; slice totals place each slice, and only rows of one
slice are ordered together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch, gapless_rank, sums_before, table, uniform

SHARDS = 8
LUMP = 0.02  # groups above this share of a shard are placed before the others
KEY = ["id", "size", "text_crc32"]


def place_large(large: list[tuple[str, int, int]], shards: int, capacity: float) -> tuple[list[tuple], list[float]]:
    """Runs ``(group, first, end, shard)`` of the rows of groups ``(group, rows, bytes of a row)``, and the room left.

    The largest come first, each whole into the fullest shard that has room for
    it.  A group that no shard can take whole is cut, over as few shards as can be.
    """
    room = [float(capacity)] * shards
    runs = []
    for group, rows, each in sorted(large, key=lambda g: (-g[1] * g[2], g[0])):
        at = 0
        while at < rows:
            whole = [s for s in range(shards) if room[s] >= (rows - at) * each]
            to = min(whole, key=lambda s: (room[s], s)) if whole else max(range(shards), key=lambda s: (room[s], -s))
            end = rows if whole else min(rows, at + max(1, int(room[to] // each)))
            runs.append((group, at, end, to))
            room[to] -= (end - at) * each
            at = end
    return runs, room


def admitted_shares(wanted: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The share of ``wanted[from, to]`` bytes that may move at once.

    A shard admits its room and what leaves it in the same round.  Starting from
    all wishes, shards that would overflow admit less until none does.
    """
    flow = wanted.astype(float)
    for _ in range(10_000):
        comes, most = flow.sum(axis=0), np.maximum(room + flow.sum(axis=1), 0.0)
        if (comes <= most * (1 + 1e-9) + 1e-9).all():
            break
        flow *= np.minimum(1.0, most / np.maximum(comes, 1e-9))[None, :]
    return np.divide(flow, wanted, out=np.zeros_like(flow), where=wanted > 0)


def propagate(scratch: Scratch, held: DataFrame, room: list[float]) -> DataFrame:
    """``(group, shard)`` of every group of ``held`` rows ``(group, shard, bytes)``, whole, under the room of each shard.

    A group's home is the shard that holds most of it; ties go by a hash of the
    group.  Every move joins two parts of a group, so the rounds end.  Then a
    group whose home had no room moves with its home part: what is still cut
    fills the shards with room in a hash order.
    """
    shards, turn = len(room), 0
    while True:
        load = {r["shard"]: r["b"] for r in held.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
        best = held.groupBy("group").agg(F.count("*").alias("parts"), F.max(
            F.struct("bytes", F.xxhash64("group", "shard").alias("tie"), "shard")).alias("most")).where("parts > 1")
        wish = held.join(best.select("group", F.col("most.shard").alias("home")), "group").where("shard <> home")
        wish = scratch.save(wish.select("group", "shard", "home", "bytes"), "wishes")
        wanted = np.zeros((shards, shards))
        for r in wish.groupBy("shard", "home").agg(F.sum("bytes").alias("b")).collect():
            wanted[r["shard"], r["home"]] = r["b"]
        share = admitted_shares(wanted, np.array([room[s] - load.get(s, 0) for s in range(shards)]))
        at = (F.col("shard") * shards + F.col("home") + 1).cast("int")
        goes = wish.where(uniform("group", "shard", seed=turn) < F.element_at(F.lit(share.ravel()), at))
        goes = scratch.save(goes.select("group", "shard", "home"), "moves")
        scratch.drop(wish)
        if not goes.limit(1).count():
            scratch.drop(goes)
            break
        moved = held.join(goes, ["group", "shard"], "left").select(
            "group", F.coalesce("home", "shard").alias("shard"), "bytes")
        new = scratch.save(moved.groupBy("group", "shard").agg(F.sum("bytes").alias("bytes")), "held")
        scratch.drop(goes, held)
        held, turn = new, turn + 1
    groups = scratch.save(held.groupBy("group").agg(
        F.min("shard").alias("shard"), F.max("shard").alias("last"), F.sum("bytes").alias("size")), "groups")
    scratch.drop(held)
    whole = groups.where("shard = last")
    load = {r["shard"]: r["b"] for r in whole.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    cut = fill(scratch, groups.where("shard < last").select("group", "size"),
               [max(0.0, room[s] - load.get(s, 0)) for s in range(shards)], ["group"])
    return scratch.save(whole.select("group", "shard").unionByName(cut.select("group", "shard")), "homes")


def fill(scratch: Scratch, alone: DataFrame, room: list[float], key: list[str]) -> DataFrame:
    """Give rows ``(*key, size)`` a ``shard`` so that shards receive bytes in proportion to ``room``."""
    keyed = scratch.save(alone.withColumn("draw", uniform(*key)), "alone")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    placed = sums_before(scratch, keyed, [], [F.col(c) for c in ("draw", *key)], "size", "before")
    place = F.col("before") + F.col("size") / F.lit(2.0)
    open_ = sum(room) or 1.0
    shard, edge = F.lit(len(room) - 1), total
    for s in range(len(room) - 1, 0, -1):
        edge -= total * room[s] / open_
        shard = F.when(place < edge, F.lit(s - 1)).otherwise(shard)  # the lowest edge ends up tested first
    return placed.withColumn("shard", shard.cast("int")).select(*alone.columns, "shard")


def start_shard(room: list[float]) -> Column:
    """A shard by hash, as likely as it has room."""
    draw, total, edge = uniform("id", "size", seed=1), sum(max(0.0, b) for b in room) or 1.0, 1.0
    shard = F.lit(len(room) - 1)
    for s in range(len(room) - 1, 0, -1):
        edge -= max(0.0, room[s]) / total
        shard = F.when(draw < edge, F.lit(s - 1)).otherwise(shard)
    return shard.cast("int")


def large_rows(scratch: Scratch, rows: DataFrame, runs: list[tuple]) -> DataFrame:
    """The rows of the placed groups with their ``shard``; a cut group's rows are numbered in a hash order."""
    cut = {group for group, first, _, _ in runs if first}
    placed = scratch.spark.createDataFrame(runs, "group string, first long, end long, shard int")
    whole = rows.join(F.broadcast(placed.where(~F.col("group").isin(cut))), "group").select(*KEY, "shard")
    if not cut:
        return whole
    pieces = placed.where(F.col("group").isin(cut))
    parts = scratch.save(rows.join(F.broadcast(pieces.select("group").distinct()), "group"), "cut")
    numbered = gapless_rank(scratch, parts, "group", KEY, "number")
    inside = (F.col("number") >= F.col("first")) & (F.col("number") < F.col("end"))
    numbered = numbered.join(F.broadcast(pieces), "group").where(inside)
    return whole.unionByName(numbered.select(*KEY, "shard"))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shards: int = SHARDS) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot`` for every row; equal texts are linked.

    The law is ``bytes``.  A size is the text's UTF-8 bytes plus one; a null text
    has none, the checksum 0, and no links.  Empty texts are equal.  Rows that
    repeat an id, and null ids, are rows of their own.  ``slot`` numbers a shard's
    rows from 0.  Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32"), F.sha2(text, 256).alias("group"))
    rows = scratch.save(rows, "rows")
    groups = scratch.save(rows.where("group IS NOT NULL").groupBy("group").agg(
        F.count("*").alias("n"), F.max("size").alias("each")).where("n > 1"), "groups")  # equal texts, equal sizes
    alone = rows.join(groups.select("group"), "group", "left_anti").select(*KEY)
    total = rows.agg(F.sum("size")).first()[0] or 0
    is_large = F.col("n") * F.col("each") > F.lit(LUMP * total / shards)
    large = [tuple(r) for r in groups.where(is_large).select("group", "n", "each").collect()]  # at most shards / LUMP
    runs, room = place_large(large, shards, total / shards)
    linked = rows.join(groups.where(~is_large).select("group"), "group")
    linked = scratch.save(linked.select(*KEY, "group", start_shard(room).alias("start")), "linked")
    held = scratch.save(linked.groupBy("group", F.col("start").alias("shard")).agg(F.sum("size").alias("bytes")), "held")
    homes = propagate(scratch, held, room)
    linked = linked.join(homes, "group").select(*KEY, "shard")
    if runs:
        linked = scratch.save(linked.unionByName(large_rows(scratch, rows, runs)), "placed")
    else:
        linked = scratch.save(linked, "placed")
    load = {r["shard"]: r["b"] for r in linked.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    filled = fill(scratch, alone, [max(0.0, total / shards - load.get(s, 0)) for s in range(shards)], KEY)
    whole = scratch.save(linked.unionByName(filled), "shards")
    numbered = gapless_rank(scratch, whole, "shard", KEY, "slot")
    return numbered.select("id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


def op10_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
