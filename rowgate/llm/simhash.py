"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import binaries, carried, giving_back, staging_for, text_bytes, unpacked
from rowgate.llm.components import components
from rowgate.staging import Staging

SEED = 42
LOT = 1 << 18
LONGEST_KEY = 32
CELL = 4096
#: Row numbers that are broadcast, 50 MB or so as a hash table.
BROADCAST_ROWS = 2_000_000


def fingerprint(text: bytes, words: int) -> int:
    """SimHash of the word shingles of a text's UTF-8 bytes: a bit is set if over half the shingle hashes set it.

    A-Z are lower-cased, words are split at ASCII white space. Fewer words than ``words`` are one
    shingle; no word gives 0. The hashes of a long text are summed up in lots.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(parts) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), LOT):
        pairs = zip(starts[at : at + LOT], ends[at : at + LOT], strict=True)
        lot = np.array([hashed(joined[s:e], SEED) for s, e in pairs], dtype="<u8")
        bits = np.unpackbits(lot.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(ones * 2 > len(starts)).tolist())


def fingerprints(text: Column, words: int) -> Column:
    """The 64-bit fingerprint of each text as a signed long; null texts count as empty."""

    @F.arrow_udf("long")
    def column(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t, words) for t in binaries(texts)), np.uint64, len(texts))
        return pa.array(values.view(np.int64))

    return column(text_bytes(text))


def hexadecimal(value: Column) -> Column:
    """A fingerprint as 16 lower-case digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def key_masks(rows: int, distance: int) -> list[int]:
    """Masks of the bits of each join key, such that fingerprints within ``distance`` bits agree on one key.

    The 64 bits are cut into distance + k blocks; ``distance`` differing bits leave k of them
    untouched, and a key is one choice of k blocks. The smallest k is taken for which ``rows`` random
    fingerprints meet fewer than two others by chance in a key; every k finds the same pairs.
    """
    for k in range(1, 65 - distance):
        blocks = distance + k
        key_bits = 64 * k // blocks
        if rows <= 2 << key_bits or key_bits >= LONGEST_KEY or comb(blocks + 1, k + 1) > 500:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(masks, k)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(values: np.ndarray, distance: int) -> np.ndarray:
    """For each of sorted distinct fingerprints the index of one it is linked to, so that chains reach all links.

    Breadth-first over the fingerprints not reached yet; each is compared with those still open.
    """
    parent = np.arange(len(values))
    open_ = np.arange(1, len(values))
    queue = [0]
    while len(open_):
        if not queue:
            queue, open_ = [int(open_[0])], open_[1:]
            continue
        node = queue.pop()
        near = np.bitwise_count(values[open_] ^ values[node]) <= distance
        found = open_[near]
        parent[found] = node
        queue.extend(found.tolist())
        open_ = open_[~near]
    return parent


def _linker(distance: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Streams rows sorted by cell and yields, for each cell, links that connect what is within ``distance``."""

    def links(cell: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(cell)]))
        sizes = ends - starts
        pairs = starts[sizes == 2]
        near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= distance
        a, b = [fps[pairs[near]]], [fps[pairs[near] + 1]]
        for i in np.flatnonzero(sizes > 2):
            values = np.unique(fps[starts[i] : ends[i]])
            parent = _forest(values, distance)
            linked = np.flatnonzero(parent != np.arange(len(values)))
            a.append(values[linked])
            b.append(values[parent[linked]])
        return np.concatenate(a), np.concatenate(b)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cell: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            both = [pa.array(x.view(np.int64)) for x in links(cell, fps)]
            return pa.RecordBatch.from_arrays(both, names=["a", "b"])

        held_cell, held_fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            held_cell = np.concatenate((held_cell, batch.column("cell").to_numpy()))
            held_fps = np.concatenate((held_fps, batch.column("fp").to_numpy().view(np.uint64)))
            last = int(np.searchsorted(held_cell, held_cell[-1])) if len(held_cell) else 0
            if last:
                yield found(held_cell[:last], held_fps[:last])
                held_cell, held_fps = held_cell[last:], held_fps[last:]
        if len(held_cell):
            yield found(held_cell, held_fps)

    return rows


def linked_fingerprints(distinct: DataFrame, distance: int, cell: int = CELL) -> DataFrame:
    """Links (``a``, ``b``) between the distinct fingerprints ``fp`` that connect all within ``distance`` bits.

    Every fingerprint goes to one row for each key; rows of a key meet in a task and are compared.
    Keys with over ``cell`` fingerprints are cut into parts of about that many, and every two parts
    meet in a cell of their own, so no task gets an unbounded group. A cell yields a spanning forest
    of its links, at most one row for each fingerprint, and not its pairs.
    """
    masks = key_masks(distinct.count(), distance)
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = keyed.groupBy("key").count().where(F.col("count") > cell)
    large = large.select("key", F.ceil(F.col("count") / cell).alias("parts"))
    parted = keyed.join(large, "key", "left").withColumn("part", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))))
    others = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
    celled = parted.withColumn("other", others).select(
        "fp",
        F.when(F.col("parts").isNull(), F.col("key"))
        .otherwise(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")))
        .alias("cell"),
    )
    met = celled.repartition("cell").sortWithinPartitions("cell")
    return met.mapInArrow(giving_back(_linker(distance)), "a long, b long").distinct()


def fingerprint_components(distinct: DataFrame, distance: int, staging: Staging) -> DataFrame:
    """``fp, group`` for the fingerprints that have a link: the smallest fingerprint reachable."""
    links = linked_fingerprints(distinct, distance)
    found = components(links, staging, "simhash-links")
    return found.select(F.col("node").alias("fp"), F.col("component").alias("group"))


def near_duplicates(docs: DataFrame, words: int, distance: int, staging: Staging | None = None) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: documents whose fingerprints differ in at most ``distance`` bits are linked.

    Fingerprints are taken of whole texts; null, empty and blank texts have fingerprint 0 and are
    linked like any other. ``component_id`` is the smallest doc_id reachable by links, null only if
    all ids reached are null. Repeated rows stay. Copies share a fingerprint and are one node of the
    search, whatever their number.
    """
    staging = staging_for(docs.sparkSession, staging)
    prints = staging.keep(docs.select("doc_id", fingerprints(F.col("text"), words).alias("fp")), "fingerprints")
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    groups = fingerprint_components(lowest.select("fp"), distance, staging)
    grouped = staging.keep(lowest.join(groups, "fp", "left").withColumn("group", F.coalesce("group", "fp")), "groups")
    ids = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    by_print = grouped.join(ids, "group").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words: int, distance: int, staging: Staging | None = None) -> DataFrame:
    """One row of each group of near duplicates, all columns as they were.

    The row with the smallest doc_id stays (null ids last); of several rows with that id, one stays.
    Rows are written once with their fingerprint and a number. Groups, and the numbers that stay, come from
    these two and the id; texts are then read where they lie and rows dropped by number, a lookup
    in a broadcast of up to ``BROADCAST_ROWS`` numbers, of those that stay or those that go, whichever are
    fewer. Only where both are more do rows meet the numbers by a shuffle. Columns with any name stay.
    """
    staging = staging_for(docs.sparkSession, staging)
    packed = carried(docs, fp=fingerprints(F.col("text"), words), id=F.col("doc_id").cast("long"))
    rows = staging.keep(packed.withColumn("number", F.monotonically_increasing_id()), "rows")
    prints = rows.select("fp", "id", "number")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "number")
    first = staging.keep(prints.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")), "firsts")
    groups = fingerprint_components(first.select("fp"), distance, staging)
    by_group = first.join(groups, "fp", "left").groupBy(F.coalesce("group", "fp").alias("group"))
    chosen = by_group.agg(F.min("first").alias("first"), F.sum("rows").alias("rows"))
    stay = staging.keep(chosen.select(F.col("first.number").alias("kept_number"), "rows"), "stay")
    kept, total = stay.agg(F.count(F.lit(1)), F.sum("rows")).first()
    stay = stay.select("kept_number")
    same = F.col("number") == F.col("kept_number")
    if kept > BROADCAST_ROWS >= (total or 0) - kept:
        gone = prints.select("number").join(stay, same, "left_anti").withColumnRenamed("number", "kept_number")
        return unpacked(rows.join(F.broadcast(gone), same, "left_anti"))
    return unpacked(rows.join(F.broadcast(stay) if kept <= BROADCAST_ROWS else stay, same, "left_semi"))
