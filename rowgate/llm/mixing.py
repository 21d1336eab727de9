"""Interleaving sources to target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import ROW, carried, sums_before, unpacked

REST = -1
MOST_UNITS = 100_000
RUN = 512


def schedule(units: Mapping[int, int]) -> list[tuple[int, int, int]]:
    """One period of the schedule: ``(slot, lane, block)`` for ``sum(units)`` slots.

    Block ``k`` (from 0) of a lane with ``u`` of ``t`` units is released at ``floor(k * t / u)`` and
    due at ``ceil((k + 1) * t / u)``. Of the released blocks the earliest deadline goes first, ties by
    lane. The weights sum to 1, so every block meets its window, and at any slot each lane has had
    its share give or take less than one block. After ``t`` slots everything repeats.
    """
    total = sum(units.values())
    waiting = [(0, lane, 0) for lane in sorted(units)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, lane, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * total // units[lane]), lane, block))
        _, lane, block = heapq.heappop(ready)
        slots.append((slot, lane, block))
        if block + 1 < units[lane]:
            heapq.heappush(waiting, ((block + 1) * total // units[lane], lane, block + 1))
    return slots


@dataclass(frozen=True)
class Phase:
    """A stretch of the mix with the same lanes. A lane takes its blocks ``begin[lane]`` to ``end[lane] - 1``."""

    first_slot: int
    units: dict[int, int]
    begin: dict[int, int]
    end: dict[int, int]


def phases(units: Mapping[int, int], blocks: Mapping[int, int]) -> list[Phase]:
    """Stretches of the mix: each lasts until a lane is out of blocks; the others go on at their weights to one another."""
    found: list[Phase] = []
    taken = {lane: 0 for lane, n in blocks.items() if n}
    slot = 0
    while taken:
        active = {lane: units[lane] for lane in taken}
        total = sum(active.values())
        places: dict[int, list[int]] = {lane: [] for lane in active}
        for at, lane, _ in schedule(active):
            places[lane].append(at)
        left = {lane: blocks[lane] - n for lane, n in taken.items()}
        slots = 1 + min((n - 1) // active[x] * total + places[x][(n - 1) % active[x]] for x, n in left.items())
        whole, part = divmod(slots, total)
        end = {x: n + whole * active[x] + bisect_left(places[x], part) for x, n in taken.items()}
        found.append(Phase(slot, active, dict(taken), end))
        taken = {x: n for x, n in end.items() if n < blocks[x]}
        slot += slots
    return found


def _slots(spark: SparkSession, found: list[Phase]) -> DataFrame:
    """A row for each phase, lane and place in its period: the slot of that block in the first period."""
    rows = [
        (lane, p.begin[lane], p.end[lane], p.units[lane], place, p.first_slot + at, sum(p.units.values()))
        for p in found
        for at, lane, place in schedule(p.units)
    ]
    return spark.createDataFrame(
        rows, "lane int, begin long, end long, units long, place long, first long, period long"
    )


def _short_blocks(found: list[Phase], rows: Mapping[int, int], block_rows: int) -> list[tuple[int, int]]:
    """The slot of each lane's last block and the rows that it lacks."""
    short = []
    for phase in found:
        places = {(lane, place): at for at, lane, place in schedule(phase.units)}
        for lane, end in phase.end.items():
            lacking = end * block_rows - rows[lane]
            if lacking > 0:
                turn, place = divmod(end - 1 - phase.begin[lane], phase.units[lane])
                short.append((phase.first_slot + turn * sum(phase.units.values()) + places[lane, place], lacking))
    return short


def mixed(docs: DataFrame, weights: Mapping[str, int], rest: int = 1, block_rows: int = 8) -> DataFrame:
    """Every row of ``docs``, as the struct ``__row``, with its place in a mix of the sources by ``weights``.

    ``weights`` gives whole units by source. All other sources, and null, share one lane of ``rest``
    units. A lane's rows are shuffled by a hash of doc_id (ties by a hash of the row) and cut into
    blocks of ``block_rows`` rows; Pfair scheduling gives every block a slot. While no lane has run
    out, each has had its weight's share of the slots to within less than one block; when one runs
    out, the others go on at their weights to one another. No row is dropped or repeated; null ids,
    repeated rows and an empty table are as good as any.

    Returns ``__row, lane, block, slot, position``; ``position`` runs from 0 over all rows. The
    driver holds a row count per lane and at most ``MOST_UNITS`` slots, the only rows broadcast.
    Rows are numbered in runs dealt by a hash of id and row, so a hot source, many rows without an id or many
    of one id are no task of their own; only rows that are the same in every column share a run.
    """
    if any(n < 1 for n in [rest, *weights.values()]):
        raise ValueError("weights are whole numbers from 1 on")
    if (sum(weights.values()) + rest) * (len(weights) + 1) > MOST_UNITS:
        raise ValueError(f"units x lanes are limited to {MOST_UNITS}")
    names = sorted(weights)
    units = {REST: rest} | {i: weights[n] for i, n in enumerate(names)}
    lane = F.lit(REST)
    for i, name in enumerate(names):
        lane = F.when(F.col("source") == name, i).otherwise(lane)
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    draws = {"draw": F.xxhash64(F.lit("mix"), "doc_id"), "tie": F.xxhash64(*hashed)}
    drawn = carried(docs, lane=lane, **draws)
    keys = docs.select(lane.alias("lane"), *[c.alias(n) for n, c in draws.items()])
    totals = {r["lane"]: r["count"] for r in keys.groupBy("lane").count().collect()}
    found = phases(units, {x: -(-n // block_rows) for x, n in totals.items()})
    run = F.pmod(F.xxhash64("draw", "tie"), F.lit(max(1, sum(totals.values()) // RUN))).alias("run")
    sizes = keys.groupBy("lane", run).agg(F.count("*").alias("n"))
    begins = sums_before(sizes, ["lane"], "run", "n", "before").drop("n")
    order = Window.partitionBy("lane", "run").orderBy("draw", "tie")
    numbered = drawn.withColumn("run", run).withColumn("inner", F.row_number().over(order) - 1)
    ranked = numbered.join(begins, ["lane", "run"]).select(ROW, "lane", (F.col("before") + F.col("inner")).alias("rank"))
    blocked = ranked.withColumn("block", F.floor(F.col("rank") / block_rows)).alias("r")
    turns = F.broadcast(_slots(docs.sparkSession, found)).alias("s")
    fits = "r.lane = s.lane AND r.block >= s.begin AND r.block < s.end AND (r.block - s.begin) % s.units = s.place"
    turn = F.floor((F.col("r.block") - F.col("s.begin")) / F.col("s.units"))
    placed = blocked.join(turns, F.expr(fits)).select(
        f"r.{ROW}", "r.lane", "r.rank", "r.block", (F.col("s.first") + turn * F.col("s.period")).alias("slot")
    )
    position = F.col("slot") * block_rows + F.col("rank") % block_rows
    for last, lacking in _short_blocks(found, totals, block_rows):
        position = position - F.when(F.col("slot") > last, lacking).otherwise(0)
    return placed.select(ROW, "lane", "block", "slot", position.cast("long").alias("position"))


def in_order(placed: DataFrame) -> DataFrame:
    """The rows that ``mixed`` placed, as they were, in the order of the mix from partition to partition."""
    spark = placed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return unpacked(placed.repartitionByRange(parts, "position").sortWithinPartitions("position"))
