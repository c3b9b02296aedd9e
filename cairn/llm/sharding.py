"""Sharding by balanced label propagation.

Documents with equal texts are linked; an edge is cut when its two ends lie in
different shards. Every document begins in a pseudo-random shard. In each round a
group's members move towards the shard where most of their neighbours are, under
capacity quotas: what a shard takes in and what stays there may not pass its quota,
and the groups that save most edges go first. If groups are still scattered after the
rounds, or a shard holds more linked rows than its quota, all groups are placed anew by
their sizes, largest first, each whole wherever one fits. Then documents without links
fill every shard to its quota exactly, so that the counts of documents differ by one at
most.

All of it is joins, grouped sums and windows. A group is seen only as its counts per
shard (summed before the shuffle), admissions are sums over bins of equal gain, small
groups are placed by running sums over hash blocks, only the large ones (a fixed number
for a shard at most) by their sizes on the driver, and slots are numbered in hash blocks: no task holds a whole group or shard. The rounds
carry only rows that have links, and no text.
"""

from __future__ import annotations

from bisect import insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import release
from .common import block_count, numbered, pick, store


def _quota(total: int, shards: int, shard: Column) -> Column:
    return F.lit(total // shards) + (shard < total % shards).cast("int")


def _wanted(size: Column, shards: int, total: int) -> Column:
    """In how many shards a group gathers: one, or more if it is larger than a quota."""
    return F.greatest(F.lit(1), F.ceil(size / F.lit(max(1, total // shards))))


def _targets(counts: DataFrame, shards: int, total: int, turn: int) -> DataFrame:
    """(gid, target, moving): where each group gathers and how many rows move there.
    ``counts``: (gid, shard, n). Targets are admitted by falling gain while the rows that
    stay and those that come fit the target's quota; an offer that does not fit alone is
    skipped. Shards with room for the whole group are preferred; each turn one more shard
    by hash is a candidate. What leaves a shard is credited in the next turn."""
    size = counts.groupBy("gid").agg(F.sum("n").alias("size"), F.count("*").alias("parts"))
    wanted = _wanted(F.col("size"), shards, total)
    linked = counts.groupBy("shard").agg(F.sum("n").alias("linked"))
    other = F.pmod(F.xxhash64("gid", F.lit(turn)), F.lit(shards)).cast("int")
    others = size.where(F.col("parts") > wanted).select("gid", other.alias("shard"), F.lit(0).cast("long").alias("n"))
    known = counts.union(others).groupBy("gid", "shard").agg(F.max("n").alias("n"))
    known = known.join(F.broadcast(linked), "shard", "left").join(size, "gid")  # linked: one row a shard
    fits = F.coalesce("linked", F.lit(0)) + F.col("size") - F.col("n") <= _quota(total, shards, F.col("shard"))
    rank = F.row_number().over(Window.partitionBy("gid").orderBy(fits.desc(), F.desc("n"), F.xxhash64("gid", "shard"), "shard"))
    ranked = known.withColumn("rank", rank)  # at most ``shards`` rows a group
    gathers = ranked.where(F.col("rank") <= wanted)
    split = F.col("parts") > wanted
    leaving = ranked.where(F.col("rank") > wanted).groupBy("gid").agg(F.sum("n").alias("leaving"))
    offers = gathers.where(split).join(leaving, "gid").withColumn("share", F.ceil(F.col("leaving") / wanted))
    offers = offers.select("gid", F.col("shard").alias("target"), F.col("share").alias("moving"), F.col("n").alias("there"))
    room = _quota(total, shards, F.col("target")) - F.coalesce("linked", F.lit(0))
    offers = offers.join(F.broadcast(linked.withColumnRenamed("shard", "target")), "target", "left")
    offers = offers.where(F.col("moving") <= room).drop("linked")
    # Bins of equal gain (the edges that a move saves), cut finer by a hash of the group.
    gain = F.floor(F.log2(F.col("moving") * F.col("there") + 1) * 4)
    offers = offers.withColumn("bin", (1000 - gain) * 256 + F.pmod(F.xxhash64("gid", F.lit(turn)), F.lit(256)))
    bins = offers.groupBy("target", "bin").agg(F.sum("moving").alias("in"))
    running = F.sum("in").over(Window.partitionBy("target").orderBy("bin"))
    admitted = (
        bins.withColumn("running", running)
        .join(linked, bins["target"] == linked["shard"], "left")
        .where(F.col("running") + F.coalesce("linked", F.lit(0)) <= _quota(total, shards, F.col("target")))
        .select("target", "bin")
    )
    return offers.join(admitted, ["target", "bin"]).select("gid", "target", "moving")


def _round(state: DataFrame, targets: DataFrame) -> DataFrame:
    """Moves the rows of groups whose targets were admitted: those outside all targets,
    dealt evenly over the targets by a hash of the row."""
    goals = targets.groupBy("gid").agg(F.sort_array(F.collect_set("target")).alias("goals"))  # at most ``shards`` values
    moved = state.join(goals, "gid", "left")
    stays = F.col("goals").isNull() | F.array_contains("goals", F.col("shard"))
    to = F.element_at("goals", (F.pmod(F.xxhash64("row"), F.size("goals")) + 1).cast("int"))
    return moved.select("row", "gid", F.when(stays, F.col("shard")).otherwise(to).alias("shard"))


Piece = tuple[int, int, int, int]


def _place(groups: list[tuple[int, int]], rooms: list[int]) -> list[Piece]:
    """(gid, from, until, shard): the shards of the rows of ``groups`` (gid, size) by
    their numbers; ``rooms`` loses what they take. Largest first, each goes whole to the
    smallest room that holds it. One larger than all shards' quotas fills whole shards,
    and its rest is placed like a group. One that fits nowhere is cut, after the others,
    over the largest rooms."""
    out: list[Piece] = []
    waiting = sorted((size, gid, 0) for gid, size in groups)  # the last is the largest
    quota = max(rooms, default=0)
    cut: list[tuple[int, int, int]] = []

    def put(gid: int, at: int, n: int, shard: int) -> None:
        out.append((gid, at, at + n, shard))
        rooms[shard] -= n

    while waiting:
        size, gid, at = waiting.pop()
        fits = [(room, j) for j, room in enumerate(rooms) if room >= size]
        room, j = min(fits) if fits else max((room, -j) for j, room in enumerate(rooms))
        if fits:
            put(gid, at, size, j)
        elif size > quota and room > 0:
            put(gid, at, room, -j)
            insort(waiting, (size - room, gid, at + room))
        else:
            cut.append((size, gid, at))
    for size, gid, at in cut:
        while size:
            room, j = max((room, -j) for j, room in enumerate(rooms))
            put(gid, at, min(size, room), -j)
            size, at = size - min(size, room), at + min(size, room)
    return out


def _packed(state: DataFrame, shards: int, total: int, block_rows: int) -> DataFrame:
    """``state`` with every group placed anew by its size: the large ones by ``_place``,
    the small ones one after the other into the rooms left. The small ones on a border of
    two rooms, fewer than ``shards``, go where they still fit."""
    spark = state.sparkSession
    rooms = [total // shards + (j < total % shards) for j in range(shards)]
    sizes = store(state.groupBy("gid").agg(F.count("*").alias("size")), "shard-sizes")
    least = total // shards // 256  # so at most 256 larger ones for a shard, and its remainder
    large = sizes.where(F.col("size") > least).collect()
    pieces = _place([(int(r["gid"]), int(r["size"])) for r in large], rooms)
    small = sizes.where(F.col("size") <= least)
    blocks = block_count(small.count(), block_rows)
    small = small.withColumn("block", F.pmod(F.xxhash64("gid"), F.lit(blocks)).cast("int"))
    of_block = small.groupBy("block").agg(F.sum("size").alias("of_block"))  # one row a block
    before = of_block.select("block", (F.sum("of_block").over(Window.orderBy("block")) - F.col("of_block")).alias("before"))
    within = F.sum("size").over(Window.partitionBy("block").orderBy("gid"))
    start = F.col("before") + F.col("within") - F.col("size")
    until = [sum(rooms[: j + 1]) for j in range(shards)]
    at = lambda x: sum((F.when(x >= u, 1).otherwise(0) for u in until[:-1]), F.lit(0)).cast("int")
    small = small.withColumn("within", within).join(F.broadcast(before), "block")
    small = small.select("gid", "size", at(start).alias("shard"), at(start + F.col("size") - 1).alias("last"))
    small = store(small, "shard-small")
    whole = small.where("shard = last")
    for r in whole.groupBy("shard").agg(F.sum("size").alias("n")).collect():  # one row a shard
        rooms[r["shard"]] -= int(r["n"])
    border = small.where("shard < last").collect()
    pieces += _place([(int(r["gid"]), int(r["size"])) for r in border], rooms)
    parts = spark.createDataFrame(pieces, "gid bigint, from long, until long, shard int")
    parts = F.broadcast(parts)  # the large groups, the border ones and their cuts
    counts: dict[int, int] = {}
    for gid, *_ in pieces:
        counts[gid] = counts.get(gid, 0) + 1
    in_parts = spark.createDataFrame([(gid,) for gid, n in counts.items() if n > 1], "gid bigint")
    rows = state.select("row", "gid")
    cut = store(rows.join(F.broadcast(in_parts), "gid", "left_semi"), "shard-cut")
    cut = numbered(cut, F.col("gid"), F.col("row"), block_count(total, block_rows))
    cut = cut.join(parts, "gid").where("number >= from and number < until").select("row", "gid", "shard")
    one = rows.join(F.broadcast(in_parts), "gid", "left_anti")
    one_large = one.join(parts, "gid").select("row", "gid", "shard")
    one_small = one.join(parts, "gid", "left_anti").join(whole.select("gid", "shard"), "gid").select("row", "gid", "shard")
    return cut.union(one_large).union(one_small)


def assign_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 6,
    block_rows: int = 20_000,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row.

    ``size`` is the UTF-8 length of the text plus 1 (NULL: no bytes), ``text_crc32`` the
    CRC-32 of its bytes. The law is ``rows``: the shards' counts differ by one at most,
    so ``grown_shard`` is NULL. ``slot`` is gapless from 0 in each shard. NULL and empty
    texts are equal and linked like any other; rows with one doc_id, or none, are rows
    of their own. Fewer rows than shards leave shards empty; no rows, no result rows.
    What ``rounds`` rounds leave scattered is placed by the groups' sizes, so a group
    is cut only where it is larger than a quota or fits in no shard beside larger ones.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store(
        pick(docs, doc_id=id_col, text=text_col).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("gid"),
        ),
        "shard-rows",
    )
    total = rows.count()
    groups = rows.groupBy("gid").count().where("count > 1").select("gid")
    first = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    state = store(rows.join(groups, "gid", "left_semi").select("row", "gid", first.alias("shard")), "shard-state")
    wanted = _wanted(F.col("size"), shards, total)
    for turn in range(rounds + 1):
        counts = store(state.groupBy("gid", "shard").agg(F.count("*").alias("n")), "shard-counts")
        sizes = counts.groupBy("gid").agg(F.sum("n").alias("size"), F.count("*").alias("parts"))
        scattered = not sizes.where(F.col("parts") > wanted).isEmpty()
        if not scattered or turn == rounds:
            break
        targets = store(_targets(counts, shards, total, turn), "shard-targets")
        if targets.isEmpty():
            break
        after = store(_round(state, targets), "shard-state")
        release(state)
        state = after
    quotas = [total // shards + (j < total % shards) for j in range(shards)]
    # One row a shard: how many linked rows it has.
    held = {int(r["shard"]): int(r["n"]) for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    if scattered or any(n > quotas[j] for j, n in held.items()):
        state = store(_packed(state, shards, total, block_rows), "shard-state")
        held = {int(r["shard"]): int(r["n"]) for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # Linked rows keep their shards; the others are a pool that is dealt out to fill the
    # quotas exactly.
    placed = store(rows.join(state.select("row", "shard"), "row", "left"), "shard-placed")
    pool = F.lit(shards)
    ranked = store(numbered(placed, F.coalesce("shard", pool), F.col("row"), block_count(total, block_rows)), "shard-ranked")
    room = [quotas[j] - held.get(j, 0) for j in range(shards)]
    of = lambda values, at: F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), at + 1)
    own, number = F.col("shard"), F.col("number")
    # The pool's number t goes to the shard whose room covers t.
    until = [sum(room[: j + 1]) for j in range(shards)]
    to = sum((F.when(number >= u, 1).otherwise(0) for u in until[:-1]), F.lit(0))
    dealt = ranked.withColumn("to", F.coalesce(own, to).cast("int"))
    base = of([held.get(j, 0) - (until[j] - room[j]) for j in range(shards)], F.col("to"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("to").alias("shard"),
        F.when(own.isNotNull(), number).otherwise(base + number).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
