"""Shards of even size that keep linked documents together, by balanced label propagation.

Documents with an equal ``link`` (by default: an equal text) are neighbours. Each starts in a seeded shard. In
a round a group's documents are counted by shard, and those outside its fullest shard want to go there; a
group larger than a shard fills several. What may move is a quota: a shard takes no more linked
documents than it has rows, counting those that leave it in the same round, so exchanges are free; documents
without neighbours, and small groups that are whole, make room. A group that finds its shard full turns to
another in the next round.
Moves never part documents that are together, so every round leaves fewer links cut.

After the last round shards give up exactly the rows above their quota, documents without neighbours
first, then those of the smallest groups, to shards below it: row counts are at most one apart.

Ranks inside a shard come from counts by hash slots, so no task numbers a whole shard; what comes to the
driver are counts by shard and by pair of shards. Groups are counted before they are shuffled, as
(link, shard); rows meet their group in a plain join, which adaptive execution may split.

Defined results: a null text counts as empty and has no bytes; empty texts are one group; rows of one id are
rows of their own; rows without an id are placed like others; repeated rows repeat; with fewer rows than
shards some shards are empty; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import durable, range_bucket, seeded, stored

SHARDS, ROUNDS, SEED = 24, 6, 12
#: hash slots for ranks inside a shard
SLOTS = 1024
#: groups up to this size stay in one slot, so that rows which must leave leave together
SMALL = 1000
#: groups of at most this part of a shard move as one, and make room once they are whole
UNIT = 1 / 20
_GRAINS = 1 << 20
#: part of a short quota that is used, as documents are drawn by hash
_CARE = 0.99


def _chance(*what: Column) -> Column:
    return F.pmod(F.xxhash64(*what), F.lit(_GRAINS)) / F.lit(float(_GRAINS))


def _by_shard(values: list, shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (shard + 1).cast("int"))


def shares(demand: list[list[int]], bound: list[int], quota: int) -> list[float]:
    """For each shard the part of the documents which want to come that may: after the round none holds more
    documents that make no room (``bound`` before it) than ``quota``, those that leave counted."""
    n = len(bound)
    taken = [1.0] * n
    for _ in range(100):
        before = list(taken)
        for t in range(n):
            coming = sum(demand[s][t] for s in range(n))
            leaving = sum(demand[t][u] * taken[u] for u in range(n))
            room = max(0.0, quota - bound[t] + leaving)
            if coming * taken[t] > room:
                taken[t] = _CARE * room / coming
        if before == taken:
            break
    return taken


def _targets(members: DataFrame, shards: int, quota: int, full: list[bool], seed: int) -> DataFrame:
    """(link, keeps, targets) of the groups that lie in more shards than they need."""
    held = members.groupBy("link", "n", "shard").agg(F.count(F.lit(1)).alias("here"))
    need = F.ceil(F.col("n") / F.lit(quota))
    closed = _by_shard(full, F.col("shard")) & (need == 1)
    group = Window.partitionBy("link")
    order = (closed, F.col("here").desc(), F.xxhash64(F.lit(seed), "link", "shard"))
    best = (
        held.withColumns({
            "spread": F.count(F.lit(1)).over(group),
            "place": F.row_number().over(group.orderBy(*order)),  # at most one row for each shard
        })
        .where((F.col("spread") > need) & (F.col("place") <= need))
        .withColumn("room", F.greatest(F.lit(quota) - F.col("here"), F.lit(0)))
    )
    upto = group.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.when(need == 1, F.lit(1.0)).otherwise(F.sum("room").over(upto) / F.sum("room").over(group))
    return best.withColumn("reach", reach).groupBy("link").agg(
        F.collect_set("shard").alias("keeps"),
        F.sort_array(F.collect_list(F.struct("reach", "shard"))).alias("targets"),
    )


def propagate(members: DataFrame, shards: int, quota: int, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """``members`` (row, link, n, draw, shard, ...) after label propagation under quotas."""
    full = [False] * shards
    for turn in range(rounds):
        targets = _targets(members, shards, quota, full, seed)
        spot = _chance(F.lit(seed + turn), F.col("row"))
        goal = F.filter("targets", lambda t: t["reach"] > spot)[0]["shard"]
        outside = F.col("targets").isNotNull() & ~F.array_contains("keeps", F.col("shard"))
        small = F.col("n") <= quota * UNIT
        wanted = durable(
            members.join(targets, "link", "left")
            .withColumns({"to": F.when(outside, goal), "yields": small & F.col("targets").isNull()})
            .drop("keeps", "targets")
        )
        demand, bound = [[0] * shards for _ in range(shards)], [0] * shards
        # at most shards x (shards + 2) rows
        for r in wanted.groupBy("shard", "to", "yields").count().collect():
            bound[r["shard"]] += 0 if r["yields"] else r["count"]
            if r["to"] is not None:
                demand[r["shard"]][r["to"]] = r["count"]
        wanted = wanted.drop("yields")
        if not any(map(any, demand)):
            return wanted.drop("to")
        taken = shares(demand, bound, quota)
        full = [t < 0.5 for t in taken]
        # a small group moves as one; of a large one each document draws for itself
        draw = F.when(small, _chance(F.lit(-turn), F.col("link"))).otherwise(_chance(F.lit(-turn), F.col("row")))
        goes = F.col("to").isNotNull() & (draw < _by_shard(taken, F.coalesce("to", F.lit(0))))
        members = wanted.withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).drop("to")
    return durable(members)


def _offsets(rows: DataFrame, *slots: str) -> DataFrame:
    """(shard, slots..., start): how many rows of the shard lie in earlier slots."""
    counts = rows.groupBy("shard", *slots).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy(*slots).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("shard", *slots, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))


def evened(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (row, link, n, draw, shard, ...) with counts at most one apart and as few moved as that takes."""
    sizes = [0] * shards
    for r in rows.groupBy("shard").count().collect():
        sizes[r["shard"]] = r["count"]
    base, extra = divmod(sum(sizes), shards)
    largest = sorted(range(shards), key=lambda s: (-sizes[s], s))[:extra]
    quota = [base + (s in largest) for s in range(shards)]
    over = [max(0, n - q) for n, q in zip(sizes, quota)]
    if not any(over):
        return rows
    ahead = [sum(over[:s]) for s in range(shards)]
    # deficits laid end to end: the border a running number has passed last names the shard
    takers = [s for s in range(shards) if sizes[s] < quota[s]]
    borders = [sum(quota[t] - sizes[t] for t in takers[: k + 1]) for k in range(len(takers))]
    kind = F.when(F.col("n") == 1, 0).otherwise(1 + F.floor(F.log2("n"))).cast("int")
    spot = F.when(F.col("n") <= SMALL, F.xxhash64("link")).otherwise(F.xxhash64("row"))
    slotted = rows.withColumns({"kind": kind, "slot": F.pmod(spot, F.lit(SLOTS)).cast("int")})
    at = slotted.join(_offsets(slotted, "kind", "slot"), ["shard", "kind", "slot"])
    mine = _by_shard(over, F.col("shard"))
    stay = at.where(F.col("start") >= mine)
    within = Window.partitionBy("shard", "kind", "slot").orderBy("link", "draw", "row")
    place = F.col("start") + F.row_number().over(within) - 1
    last = F.array(*[F.lit(s) for s in [*takers, takers[-1]]])
    goal = F.element_at(last, (range_bucket(_by_shard(ahead, F.col("shard")) + F.col("place"), borders) + 1).cast("int"))
    leave = at.where(F.col("start") < mine).withColumn("place", place).withColumn(
        "shard", F.when(F.col("place") < mine, goal).otherwise(F.col("shard"))
    )
    return stay.unionByName(leave.drop("place")).select(*rows.columns)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard."""
    slotted = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(SLOTS)).cast("int"))
    within = Window.partitionBy("shard", "part").orderBy("draw", "row")
    return (
        slotted.withColumn("place", F.row_number().over(within))
        .join(_offsets(slotted, "part"), ["shard", "part"])
        .withColumn("slot", F.col("start") + F.col("place") - 1)
        .drop("part", "place", "start")
    )


def shard_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    link: Column | None = None,
    rounds: int = ROUNDS,
    row: Column | None = None,
) -> DataFrame:
    """(row, doc_id, size, text_crc32, link, shard, slot), one row for each row of ``docs``; documents
    with an equal ``link`` belong together. ``row`` names a column that tells rows apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = durable(docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        (F.unhex(F.md5(text)) if link is None else link).alias("link"),
    ).withColumn("draw", seeded(SEED, F.col("doc_id"), F.col("link"))))
    groups = read.groupBy("link").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    start = durable(
        read.join(groups, "link", "left")
        .withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(shards)).cast("int"))
    )
    quota = max(1, start.count() // shards)
    alone = start.where((F.col("n") == 1) | F.col("link").isNull())
    members = propagate(start.where((F.col("n") > 1) & F.col("link").isNotNull()), shards, quota, rounds)
    placed = durable(evened(alone.unionByName(members), shards))
    return numbered(placed).select("row", "doc_id", "size", "text_crc32", "link", "shard", "slot")


def write_shards(docs: DataFrame, root: str, file_rows: int = 50_000, **how) -> None:
    """Write ``docs`` as Parquet (doc, slot) in folders ``shard=``, in the order of slots, ``file_rows`` to a file."""
    id_col, text_col = how.pop("id_col", "doc_id"), how.pop("text_col", "text")
    whole = stored(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")
    ))
    placed = shard_documents(
        whole.select("row", F.col("doc")[id_col].alias("id"), F.col("doc")[text_col].alias("text")),
        "id", "text", row=F.col("row"), **how,
    )
    out = whole.join(placed.select("row", "shard", "slot"), "row").drop("row")
    (
        out.repartition("shard", F.floor(F.col("slot") / file_rows))
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite").partitionBy("shard").parquet(root)
    )
