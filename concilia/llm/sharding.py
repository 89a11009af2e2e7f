"""Sharding by balanced label propagation, in DataFrame operations only.

Documents of a group (equal texts, or any group column) are linked. They start in even shards; in
each round the members of a group that isn't settled vote for the shard that most of their neighbours
are in, among those with room for the group, and move there together if its quota allows. Quotas are
the rows that a shard may hold and doesn't hold yet for settled groups, so row counts stay at most one apart.

The largest groups go first: where a group of one size class (half an octave) is refused, smaller ones
wait for the next round. Rounds go on until no shard has room for any group left; each settles a group
at least. At that end every group left is larger than the room of every shard, so there are fewer such
groups than shards. They and the rows without links fill the seats that are left, in one sequence
in which a group's rows are together, so fewer groups than shards are cut. A group larger than a shard is
first dealt into parts of a whole shard and a rest. One rule holds for groups of every size; every row
reports its links and how many of them are cut.

The driver gets counts per shard and size class, and the groups left. Groups of more than a ten-thousandth
of all rows, of which there are at most ten thousand, are the only ones broadcast besides.

Defined cases: a null text is empty and has size 8; repeated rows are rows of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, ranked, text_key

SHARDS = 24


def quotas(wishes: list[tuple[int, int, int, int, int]], room: list[int]) -> list[tuple[int, int, int]]:
    """(shard, size class, how many groups may come) of wishes (shard, size class, groups, rows, largest group).

    The largest classes come first; classes below the first one with a refusal wait.
    """
    left, allowed, least = list(room), [], None
    for shard, size, n, rows, largest in sorted(wishes, key=lambda w: (-w[1], w[0])):
        if least is not None and size < least:
            break
        k = n if rows <= left[shard] else left[shard] // largest
        left[shard] -= rows if k == n else k * largest
        least = least if k == n else size
        if k:
            allowed.append((shard, size, k))
    return allowed


def dealt(rows: DataFrame, seats: int) -> DataFrame:
    """rows (rid, grp) with part: groups larger than ``seats`` are cut into parts of that many rows and a rest; big tells them."""
    large = F.broadcast(cut(rows.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > seats).select("grp")))  # at most two for each shard
    parts = ranked(rows.join(large, "grp", "left_semi"), ["grp"], ["rid"], "turn").select("rid", "grp", F.floor(F.col("turn") / seats).alias("part"), F.lit(True).alias("big"))
    return cut(parts.unionByName(rows.join(large, "grp", "left_anti").select("rid", "grp", F.lit(0).cast("long").alias("part"), F.lit(False).alias("big"))))


def settled(groups: DataFrame, room: list[int]) -> tuple[list[DataFrame], DataFrame, list[int]]:
    """Groups (grp, part, size, votes: shard -> members) with their shard, the groups that no shard has room for, and the room left."""
    spark, shards = groups.sparkSession, len(room)
    room, done, open_ = list(room), [], groups
    while True:
        space = F.array(*[F.lit(r).cast("long") for r in room])
        fits = F.filter(F.array(*[F.lit(j) for j in range(shards)]), lambda j: F.get(space, j) >= F.col("size"))
        # Most neighbours; then any shard, another one for each group.
        vote = lambda j: F.struct(F.coalesce(F.try_element_at("votes", j), F.lit(0).cast("long")).alias("n"), F.xxhash64("grp", "part", j).alias("h"), j.alias("j"))
        asked = cut(open_.select("grp", "part", "size", "votes", F.array_max(F.transform(fits, vote))["j"].alias("target"), F.floor(F.log2("size") * 2).cast("int").alias("class")))
        wishes = asked.where("target is not null").groupBy("target", "class").agg(F.count("*"), F.sum("size"), F.max("size")).collect()
        if not wishes:
            return done, asked.select("grp", "part", "size"), room
        table = F.broadcast(spark.createDataFrame(quotas([tuple(w) for w in wishes], room), "target int, class int, quota long"))
        turns = ranked(asked, ["target", "class"], ["grp", "part"], "turn").join(table, ["target", "class"], "left")
        judged = cut(turns.select("grp", "part", "size", "votes", F.when(F.col("turn") < F.col("quota"), F.col("target")).alias("shard")))
        for r in judged.where("shard is not null").groupBy("shard").agg(F.sum("size").alias("n")).collect():
            room[r["shard"]] -= r["n"]
        done.append(judged.where("shard is not null").select("grp", "part", "size", "shard"))
        open_ = judged.where("shard is null").select("grp", "part", "size", "votes")


def propagate(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """rows (rid: unique long from 0, grp) -> rid, grp, linked, shard, with row counts per shard at most one apart."""
    spark, total = rows.sparkSession, rows.count()
    placed = dealt(rows, max(1, total // shards)).withColumn("start", (F.col("rid") % shards).cast("int"))
    near = placed.groupBy("grp", "part", "big", "start").agg(F.count("*").alias("n"))
    groups = near.groupBy("grp", "part").agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("start", "n"))).alias("votes"), F.max("big").alias("big"))
    done, rest, room = settled(cut(groups.where("big or size > 1")), [total // shards + (j < total % shards) for j in range(shards)])
    rest = sorted(((r["size"], r["grp"], r["part"]) for r in rest.collect()), reverse=True)  # fewer than shards

    # Groups with a shard: the hot ones by broadcast, the others by a join; what is left over has neither.
    empty = spark.createDataFrame([], "grp string, part long, size long, shard int")
    homes = cut(reduce(DataFrame.unionByName, done, empty))
    hot = F.col("size") > max(1_000, total // 10_000)
    often = F.broadcast(homes.where(hot).select("grp", "part", F.col("shard").alias("hot")))
    first = placed.select("rid", "grp", "part", "big").join(often, ["grp", "part"], "left")
    housed = first.where("hot is not null").select("rid", "grp", F.lit(True).alias("linked"), F.col("hot").alias("shard"))
    others = cut(first.where("hot is null").drop("hot").join(homes.where(~hot).select("grp", "part", "shard"), ["grp", "part"], "left"))
    housed = housed.unionByName(others.where("shard is not null").select("rid", "grp", F.lit(True).alias("linked"), "shard"))

    # Seats that are left, the largest rooms first, are filled by the rest groups, one after the other, and then by rows without links.
    starts, at = [], 0
    for size, grp, part in rest:
        starts.append((grp, part, at))
        at += size
    table = F.broadcast(spark.createDataFrame(starts, "grp string, part long, from long"))
    over = others.where("shard is null").drop("shard").join(table, ["grp", "part"], "left")
    seated = ranked(over.withColumn("run", F.coalesce("from", F.lit(at))), ["run"], ["rid"], "turn")
    spans, end = [], 0
    for r, j in sorted(((r, j) for j, r in enumerate(room) if r), reverse=True):
        end += r
        spans.append((j, end))
    ends = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(e).cast("long").alias("e")) for j, e in spans] or [F.struct(F.lit(0).alias("j"), F.lit(0).cast("long").alias("e"))])
    seat = F.get(F.filter(ends, lambda s: s["e"] > F.col("run") + F.col("turn")), 0)["j"]
    return housed.unionByName(seated.select("rid", "grp", (F.col("big") | F.col("from").isNotNull()).alias("linked"), seat.alias("shard")))


def shard(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, grp, n_links, n_cut for every row of df (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    narrow = df.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key(F.col("text")).alias("grp"))
    narrow = cut(ranked(narrow, [], ["doc_id", "grp"], "rid"))
    placed = cut(propagate(narrow.select("rid", "grp"), shards))
    # Only groups in several shards have cut links; their rows look their counts up, at most `shards` rows for a group.
    there = placed.where("linked").groupBy("grp", "shard").agg(F.count("*").alias("n"))
    group = there.groupBy("grp").agg(F.sum("n").alias("of"))
    counts = cut(there.join(group, "grp").select("grp", "shard", (F.col("of") - 1).alias("n_links"), (F.col("of") - F.col("n")).alias("n_cut")))
    slotted = ranked(placed.join(counts, ["grp", "shard"], "left").select("rid", "shard", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_cut", F.lit(0)).alias("n_cut")), ["shard"], ["rid"], "slot")
    return narrow.join(slotted, "rid").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "grp", "n_links", "n_cut"
    )


def op2_shard_by_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


QUERIES = {"op2_shard_by_labels": op2_shard_by_labels}
SQL: dict[str, str] = {}
