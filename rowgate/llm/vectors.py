"""Embedding near-duplicates over a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards. In each shard a flat graph is built and pruned;
the lists that a vector has from its shards are united. Every vector is then searched for in its
shards from medoids, first greedily, then through all vectors in range. What is found is verified
in double precision, counted and connected; no list of all pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from rowgate.llm.common import staging_for
from rowgate.llm.components import components
from rowgate.staging import Staging

SHARD = 1024
CELL = 4096
MOST_CLUSTERS = 4096
SAMPLE = 16384
DEGREE = 24
NEAREST = 48
DRAWN = 24
ALPHA = 1.2
STARTS = 12
BEAM = 32
QUERIES = 512
SLACK = 1e-4
STRATA = (0, 4, 64)


def usable(vector: Column) -> Column:
    """True for vectors with numbers only, all finite, and not all zero."""
    numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(numbers & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vector: Column) -> Column:
    """A vector of doubles whose largest number is 1 or -1, the same for all exact multiples."""
    most = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    return F.transform(F.array(most), lambda m: F.transform(vector, lambda x: x.cast("double") / m + F.lit(0.0)))[0]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows of doubles with length 1, whatever their scale."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def centroids(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Directions of clusters of the sample's rows, by spherical k-means from evenly taken rows."""
    clusters = min(clusters, len(sample))
    found = sample[np.linspace(0, len(sample) - 1, clusters).astype(np.int64)].copy()
    for _ in range(rounds):
        home = np.concatenate([(part @ found.T).argmax(axis=1) for part in np.array_split(sample, 1 + len(sample) // 4096)])
        sums = np.zeros_like(found)
        np.add.at(sums, home, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        found = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), found)
    return found


def _assigner(broadcast, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives each vector the list of its nearest clusters, by dimension."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = broadcast.value
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            shards: list = [None] * len(sizes)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                first, centres = by_size[size]
                near = _matrix(vectors.take(pa.array(rows))) @ centres.T
                take = min(overlap, near.shape[1])
                best = np.sort(np.argpartition(-near, take - 1, axis=1)[:, :take], axis=1) + first
                for row, own in zip(rows.tolist(), best.tolist(), strict=True):
                    shards[row] = own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shards, pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"]
            )

    return assign


def robust_pruned(near: np.ndarray, ids: np.ndarray, like: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """For every row the ``degree`` neighbours that robust pruning leaves of its candidates; -1 where there are fewer.

    ``ids`` are candidates, nearest first, with ``like`` their likeness to the row (-1 for none);
    ``near`` holds the likeness of all to all. The nearest candidate is taken, and those much nearer
    to it than to the row are struck out; and so on, for all rows at once.
    """
    rows = np.arange(len(ids))
    gap = np.where(ids >= 0, np.sqrt(np.maximum(2 - 2 * like, 0)), np.inf)
    chosen = np.full((len(ids), degree), -1, dtype=np.int64)
    for k in range(degree):
        best = gap.argmin(axis=1)
        alive = np.isfinite(gap[rows, best])
        if not alive.any():
            break
        taken = ids[rows, best]
        chosen[alive, k] = taken[alive]
        between = np.sqrt(np.maximum(2 - 2 * near[np.maximum(taken, 0)[:, None], np.maximum(ids, 0)], 0))
        gap[alive[:, None] & (ALPHA * between <= gap)] = np.inf
        gap[rows, best] = np.inf
    return chosen


def flat_graph(unit: np.ndarray, seed: int) -> np.ndarray:
    """Neighbour lists (-1 filled) over the rows of ``unit``: pruned, made mutual, every row reachable from the first medoid."""
    n = len(unit)
    if n == 1:
        return np.full((1, 1), -1, dtype=np.int64)
    near = unit @ unit.T
    random = np.random.default_rng(seed)
    np.fill_diagonal(near, -2)
    take = min(NEAREST, n - 1)
    close = np.concatenate([np.argpartition(-near[at : at + QUERIES], take - 1, axis=1)[:, :take] for at in range(0, n, QUERIES)])
    ids = np.concatenate((close, random.integers(0, n, (n, DRAWN))), axis=1)
    own = np.arange(n)[:, None]
    ids.sort(axis=1)
    again = np.zeros_like(ids, dtype=bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    ids[again | (ids == own)] = -1
    like = np.where(ids >= 0, near[own, np.maximum(ids, 0)], -1)
    out = robust_pruned(near, ids, like)
    source, place = np.nonzero(out >= 0)
    target = out[source, place]
    pairs = np.unique(np.concatenate((source * n + target, target * n + source)))
    head, tail = np.divmod(pairs, n)
    order = np.lexsort((-near[head, tail], head))
    head, tail = head[order], tail[order]
    degree = np.bincount(head, minlength=n)
    rank = np.arange(len(head)) - np.repeat(np.cumsum(degree) - degree, degree)
    wide = np.full((n, degree.max()), -1, dtype=np.int64)
    wide[head, rank] = tail
    if wide.shape[1] > 2 * DEGREE:
        wide_like = np.where(wide >= 0, near[own, np.maximum(wide, 0)], -1)
        wide = robust_pruned(near, wide, wide_like, 2 * DEGREE)
    return _reachable(wide, near, medoids(unit, 1)[0])


def _reachable(lists: np.ndarray, near: np.ndarray, start: int) -> np.ndarray:
    """Adds a link from the nearest reached row to a row of each part that cannot be reached from ``start``."""
    seen = np.zeros(len(lists), dtype=bool)
    front = np.array([start])
    extra: list[tuple[int, int]] = []
    while True:
        while len(front):
            seen[front] = True
            found = np.unique(lists[front])
            front = found[(found >= 0) & ~seen[np.maximum(found, 0)]]
        open_ = np.flatnonzero(~seen)
        if not len(open_):
            break
        best = near[np.ix_(open_, np.flatnonzero(seen))]
        row, column = np.unravel_index(best.argmax(), best.shape)
        extra.append((int(np.flatnonzero(seen)[column]), int(open_[row])))
        front = open_[row : row + 1]
    if not extra:
        return lists
    more = np.full((len(lists), max(np.bincount([a for a, _ in extra]))), -1, dtype=np.int64)
    filled = np.zeros(len(lists), dtype=np.int64)
    for a, b in extra:
        more[a, filled[a]] = b
        filled[a] += 1
    return np.concatenate((lists, more), axis=1)


def medoids(unit: np.ndarray, count: int) -> np.ndarray:
    """The row nearest to the middle, then rows each as far as can be from those taken."""
    taken = [int((unit @ unit.mean(axis=0)).argmax())]
    like = unit @ unit[taken[0]]
    while len(taken) < min(count, len(unit)):
        taken.append(int(like.argmin()))
        like = np.maximum(like, unit @ unit[taken[-1]])
    return np.array(taken, dtype=np.int64)


def in_range(unit: np.ndarray, lists: np.ndarray, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) found with a likeness of ``least`` or more by range-expanding greedy search.

    Greedy: from the medoids, the nearest row of the beam that is not expanded yet is, until the beam
    holds none. Range: every row in range that was met is expanded in turn, until no new one is met.
    """
    starts = medoids(unit, STARTS)
    found_query, found_row = [], []
    for low in range(0, len(queries), QUERIES):
        asked = queries[low : low + QUERIES]
        q = len(asked)
        met = np.zeros((q, len(unit)), dtype=bool)
        hit = np.zeros((q, len(unit)), dtype=bool)
        opened = np.zeros((q, len(unit)), dtype=bool)
        beam = np.tile(starts, (q, 1))
        likes = asked @ unit[starts].T
        met[:, starts] = True
        hit[:, starts] |= likes >= least
        done = np.zeros_like(beam, dtype=bool)
        while True:
            order = np.where(done, -3.0, likes).argmax(axis=1)
            rows = np.arange(q)
            active = rows[~done[rows, order] & (likes[rows, order] > -2)]
            if not len(active):
                break
            node = beam[active, order[active]]
            done[active, order[active]] = True
            opened[active, node] = True
            new = lists[node]
            fresh = (new >= 0) & ~met[active[:, None], np.maximum(new, 0)]
            value = np.einsum("ad,akd->ak", asked[active], unit[np.maximum(new, 0)])
            value = np.where(fresh, value, np.float32(-3))
            owner, place = np.nonzero(fresh)
            met[active[owner], new[owner, place]] = True
            near = value >= least
            owner, place = np.nonzero(near)
            hit[active[owner], new[owner, place]] = True
            all_ids = np.concatenate((beam[active], np.maximum(new, 0)), axis=1)
            all_likes = np.concatenate((likes[active], value), axis=1)
            all_done = np.concatenate((done[active], value < -2), axis=1)
            keep = min(BEAM, all_likes.shape[1])
            best = np.argpartition(-all_likes, keep - 1, axis=1)[:, :keep]
            if beam.shape[1] < keep:
                pad = keep - beam.shape[1]
                beam = np.concatenate((beam, np.zeros((q, pad), np.int64)), axis=1)
                likes = np.concatenate((likes, np.full((q, pad), -3, likes.dtype)), axis=1)
                done = np.concatenate((done, np.ones((q, pad), bool)), axis=1)
            beam[active] = np.take_along_axis(all_ids, best, 1)
            likes[active] = np.take_along_axis(all_likes, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        while True:
            owner, node = np.nonzero(hit & ~opened)
            if not len(owner):
                break
            opened[owner, node] = True
            for at in range(0, len(owner), 1 << 14):
                who, new = owner[at : at + (1 << 14)], lists[node[at : at + (1 << 14)]]
                place_owner, place = np.nonzero((new >= 0) & ~met[who[:, None], np.maximum(new, 0)])
                keys = np.unique(who[place_owner] * len(unit) + new[place_owner, place])
                a, b = np.divmod(keys, len(unit))
                met[a, b] = True
                value = np.einsum("ad,ad->a", asked[a], unit[b])
                hit[a, b] = value >= least
        a, b = np.nonzero(hit)
        found_query.append(a + low)
        found_row.append(b)
    return np.concatenate(found_query), np.concatenate(found_row)


def _build(table: pa.Table) -> pa.Table:
    """The neighbour lists of one cell's vectors."""
    table = table.combine_chunks().sort_by("node")
    ids = table.column("node").to_numpy()
    lists = flat_graph(_matrix(table.column("vector").combine_chunks()).astype(np.float32), int(ids[0]) & 0xFFFF)
    named = [ids[row[row >= 0]].tolist() for row in lists]
    return pa.table({"node": pa.array(ids, pa.int64()), "links": pa.array(named, pa.list_(pa.int64()))})


def _tally(ids: np.ndarray, times: np.ndarray, low: np.ndarray, high: np.ndarray, ours: np.ndarray) -> pa.Table:
    """Counts of the links ``low``-``high`` that are ``ours``, and links that connect what all of them do."""
    counts = np.bincount(low[ours], times[high[ours]], len(ids)) + np.bincount(high[ours], times[low[ours]], len(ids))
    partners = np.bincount(low[ours], minlength=len(ids)) + np.bincount(high[ours], minlength=len(ids))
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[low], label[high])
        old = label.copy()
        np.minimum.at(label, low, least)
        np.minimum.at(label, high, least)
        label = label[label]
        if (label == old).all():
            break
    tied, some = np.flatnonzero(label != np.arange(len(ids))), np.flatnonzero(counts)
    return pa.table(
        {
            "a": pa.array(np.concatenate((ids[some], ids[tied]))),
            "b": pa.array([*[None] * len(some), *ids[label[tied]].tolist()], pa.int64()),
            "n": pa.array(np.concatenate((counts[some].astype(np.int64), np.zeros(len(tied), np.int64)))),
            "partners": pa.array(np.concatenate((partners[some].astype(np.int64), np.zeros(len(tied), np.int64)))),
        }
    )


def _searcher(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Searches a cell for its own vectors, or for its guests of one other cell; yields counts (``b`` null) and connecting links.

    ``n`` counts every copy of the vectors linked with, ``partners`` counts them once.
    """

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("guest", "ascending"), ("node", "ascending")])
        ids, times = table.column("node").to_numpy(), table.column("times").to_numpy()
        exact = _matrix(table.column("vector").combine_chunks())
        members = int((~table.column("guest").to_numpy(zero_copy_only=False)).sum())
        asked = 0 if table.column("cell")[0].as_py() == table.column("far")[0].as_py() else members
        if not members or asked == len(ids):
            return pa.table({name: pa.array([], pa.int64()) for name in ("a", "b", "n", "partners")})
        shards, shard = table.column("shards").to_pylist(), table.column("shard")[0].as_py()
        unit = exact.astype(np.float32)
        linked = [x if x is not None else [] for x in table.column("links").to_pylist()[:members]]
        width = max(1, max(map(len, linked)))
        lists = np.full((members, width), -1, dtype=np.int64)
        for row, other in enumerate(linked):
            if other:
                place = np.searchsorted(ids[:members], other)
                place[place == members] = 0
                lists[row, : len(other)] = np.where(ids[place] == other, place, -1)
        query, row = in_range(unit[:members], lists, unit[asked:], threshold - SLACK)
        query += asked
        low, high = np.minimum(query, row), np.maximum(query, row)
        pairs = np.unique(low[low < high] * len(ids) + high[low < high])
        low, high = np.divmod(pairs, len(ids))
        cosine = np.zeros(len(low))
        for at in range(0, len(low), 1 << 16):
            run = slice(at, at + (1 << 16))
            cosine[run] = np.einsum("ad,ad->a", exact[low[run]], exact[high[run]])
        low, high = low[cosine >= threshold], high[cosine >= threshold]
        earlier = [frozenset(x for x in own if x < shard) for own in shards]
        several = np.array([bool(x) for x in earlier])
        ours = np.ones(len(low), dtype=bool)
        for k in np.flatnonzero(several[low] & several[high]).tolist():
            ours[k] = not earlier[low[k]] & earlier[high[k]]
        return _tally(ids, times, low, high, ours)

    return search


def _homing(broadcast, reach: float, widest: np.ndarray | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives each vector its nearest cluster, its angle to that, and the clusters up to that one it must visit.

    A member of a cluster is no nearer to another one, and at most ``widest`` off its own. So no member
    within ``reach`` of a vector is in a cluster that is over twice ``reach`` farther from the vector
    than its own, or over ``reach`` outside what is widest.
    """

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = broadcast.value
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            homes, angles = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
            cells: list = [[]] * len(sizes)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                first, centres = by_size[size]
                angle = np.arccos(np.clip(_matrix(vectors.take(pa.array(rows))) @ centres.T, -1, 1))
                own = angle.argmin(axis=1)
                least = angle.min(axis=1)
                homes[rows], angles[rows] = own + first, least
                if widest is not None:
                    visits = angle <= least[:, None] + 2 * reach + SLACK
                    visits &= angle <= widest[first : first + len(centres)] + reach + SLACK
                    visits &= np.arange(len(centres)) < own[:, None]
                    visits[np.arange(len(rows)), own] = True
                    for row, some in zip(rows.tolist(), visits, strict=True):
                        cells[row] = (np.flatnonzero(some) + first).tolist()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("node", "times", "vector")], pa.array(homes), pa.array(angles), pa.array(cells, pa.list_(pa.int32()))],
                names=["node", "times", "vector", "home", "angle", "cells"],
            )

    return home


def _comparer(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Compares a cell's vectors with a lot of guests, and in the first lot with one another; yields like ``_searcher``."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("guest", "ascending"), ("node", "ascending")])
        ids, times = table.column("node").to_numpy(), table.column("times").to_numpy()
        exact = _matrix(table.column("vector").combine_chunks())
        members = int((~table.column("guest").to_numpy(zero_copy_only=False)).sum())
        begin = 0 if table.column("lot")[0].as_py() == 0 else members
        lows, highs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(begin, len(ids), QUERIES):
            high, low = np.nonzero(exact[at : at + QUERIES] @ exact[:members].T >= threshold - SLACK)
            high += at
            low, high = low[low < high], high[low < high]
            for run in range(0, len(low), 1 << 16):
                a, b = low[run : run + (1 << 16)], high[run : run + (1 << 16)]
                near = np.einsum("ad,ad->a", exact[a], exact[b]) >= threshold
                lows.append(a[near])
                highs.append(b[near])
        low, high = np.concatenate(lows), np.concatenate(highs)
        return _tally(ids, times, low, high, np.ones(len(low), dtype=bool))

    return compare


def _compared(nodes: DataFrame, threshold: float, staging: Staging, name: str) -> DataFrame:
    """Counts and connecting links of all nodes without loss: each is compared with all clusters that can hold partners.

    Clusters are cut into cells of some ``CELL`` / 2 vectors and their guests into lots of ``CELL``.
    """
    spark = nodes.sparkSession
    fitted = _centres(spark, nodes)
    broadcast, reach = spark.sparkContext.broadcast(fitted), float(np.arccos(np.clip(threshold, -1, 1)))
    kind = f"node long, times long, vector {nodes.schema['vector'].dataType.simpleString()}, home int, angle double, cells array<int>"
    given = nodes.select("node", "times", "vector")
    homes = given.mapInArrow(_homing(broadcast, reach), kind).groupBy("home").agg(F.max("angle"), F.count("*")).collect()
    widest = np.full(sum(len(x) for _, x in fitted.values()), -10.0)
    for row in homes:
        widest[row[0]] = row[1]
    visits = staging.keep(given.mapInArrow(_homing(broadcast, reach, widest), kind), f"{name}-visits")
    visits = visits.drop("angle").withColumn("cell", F.explode("cells")).drop("cells")
    shapes = visits.groupBy("cell").agg(F.count("*").alias("all"), F.count(F.when(F.col("cell") == F.col("home"), 1)).alias("own"))
    shapes = shapes.select("cell", F.ceil(F.col("own") / (CELL // 2)).cast("int").alias("parts"), F.ceil(F.col("all") / CELL).cast("int").alias("lots"))
    shapes = staging.keep(shapes.where("parts > 0"), f"{name}-shapes")
    placed = visits.join(F.broadcast(shapes), "cell")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    lot = F.pmod(F.xxhash64(F.lit("lot"), "node"), F.col("lots")).cast("int")
    is_home, columns = F.col("cell") == F.col("home"), ("cell", "part", "lot", "node", "times", "vector", "guest")
    members = placed.where(is_home).withColumn("part", part).withColumn("guest", F.lit(False))
    members = members.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).select(*columns)
    guests = placed.withColumn("lot", lot).withColumn("guest", F.lit(True))
    guests = guests.withColumn("last", F.when(is_home, part).otherwise(F.col("parts")))
    guests = guests.withColumn("part", F.explode(F.filter(F.sequence(F.lit(0), F.col("parts")), lambda x: x < F.col("last"))))
    groups = members.union(guests.select(*columns)).groupBy("cell", "part", "lot")
    return staging.keep(groups.applyInArrow(_comparer(threshold), "a long, b long, n long, partners long"), f"{name}-found")


def _stratum(partners: Column) -> Column:
    """0 for no partner, then by the bounds of ``STRATA``."""
    return sum((partners > most).cast("int") for most in STRATA)


def _audit(nodes: DataFrame, found: DataFrame, threshold: float, queries: int) -> float:
    """The recall of the worst stratum, where recall is a vector's share of its true partners that were found.

    ``queries`` vectors of each number of partners found (by ``STRATA``, the first by a hash) are
    compared with all. Their recalls are averaged by the number of true partners, each vector standing
    for as many as it was drawn from; every partner counts once, however many copies it has.
    """
    partners = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("partners").alias("met"))
    known = nodes.select("node").join(partners, "node", "left")
    known = known.select("node", F.coalesce("met", F.lit(0)).alias("met")).withColumn("stratum", _stratum(F.col("met")))
    drawn: dict[int, tuple[int, float]] = {}
    for row in known.groupBy("stratum").count().collect():
        of_stratum = known.where(F.col("stratum") == row["stratum"])
        taken = of_stratum.orderBy(F.xxhash64("node"), "node").limit(queries).select("node", "met").collect()
        drawn |= {r["node"]: (r["met"], row["count"] / len(taken)) for r in taken}
    ids = nodes.sparkSession.createDataFrame([(i,) for i in drawn], "node long")
    asked = nodes.join(F.broadcast(ids), "node").select("node", "vector").collect()
    groups: dict[int, list] = {}
    for row in asked:
        groups.setdefault(len(row["vector"]), []).append(row)
    prepared = {
        size: (np.array([r["node"] for r in rows]), _matrix(pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))))
        for size, rows in groups.items()
    }

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            for size, (ids, matrix) in prepared.items():
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    part = batch.take(pa.array(rows))
                    near = matrix @ _matrix(part.column("vector")).T >= threshold
                    near &= ids[:, None] != part.column("node").to_numpy()[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), pa.array(near.sum(axis=1, dtype=np.int64))], names=["node", "n"]
                    )

    truth = nodes.select("node", "vector").mapInArrow(compare, "node long, n long").groupBy("node").agg(F.sum("n").alias("near"))
    shares: dict[int, list[tuple[float, float]]] = {}
    for row in truth.where("near > 0").withColumn("stratum", _stratum(F.col("near"))).collect():
        met, weight = drawn[row["node"]]
        shares.setdefault(row["stratum"], []).append((min(1.0, met / row["near"]), weight))
    return min((sum(r * w for r, w in x) / sum(w for _, w in x) for x in shares.values()), default=1.0)


def _centres(spark: SparkSession, nodes: DataFrame, overlap: int = 2) -> dict[int, tuple[int, np.ndarray]]:
    """For each dimension its first shard number and its clusters, fitted on a bounded sample of the vectors.

    There are as many more clusters as the ``overlap`` is larger, so a shard has some two ``SHARD`` vectors whatever that is.
    """
    first, found = 0, {}
    for row in nodes.groupBy(F.size("vector").alias("size")).count().orderBy("size").collect():
        of_size = nodes.where(F.size("vector") == row["size"])
        sample = of_size.orderBy(F.xxhash64("node", F.lit("sample")), "node").limit(SAMPLE).select("vector").collect()
        unit = _matrix(pa.array([r["vector"] for r in sample], pa.list_(pa.float64())))
        centres = centroids(unit, min(MOST_CLUSTERS, -(-row["count"] * overlap // (2 * SHARD))))
        found[row["size"]] = (first, centres)
        first += len(centres)
    return found


def _searched(nodes: DataFrame, threshold: float, overlap: int, staging: Staging, name: str) -> DataFrame:
    """Counts and connecting links of all nodes, from one build and search with ``overlap`` shards a vector."""
    spark = nodes.sparkSession
    broadcast = spark.sparkContext.broadcast(_centres(spark, nodes, overlap))
    schema = f"node long, times long, vector {nodes.schema['vector'].dataType.simpleString()}, shards array<int>"
    assigned = nodes.select("node", "times", "vector").mapInArrow(_assigner(broadcast, overlap), schema)
    assigned = staging.keep(assigned, f"{name}-assigned")
    placed = assigned.withColumn("shard", F.explode("shards"))
    large = placed.groupBy("shard").count().where(F.col("count") > CELL)
    large = large.select("shard", F.ceil(F.col("count") / (CELL // 2)).cast("int").alias("parts"))
    parted = placed.join(F.broadcast(large), "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    parted = parted.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    links = parted.select("shard", "part", "node", "vector").groupBy("shard", "part").applyInArrow(
        _build, "node long, links array<long>"
    )
    united = links.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))
    united = staging.keep(united, f"{name}-graph")
    visits = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    visits = visits.withColumn("cell", F.least("part", "other")).withColumn("far", F.greatest("part", "other"))
    visits = visits.join(united, "node").withColumn("guest", F.col("cell") < F.col("part"))
    visits = visits.withColumn("links", F.when(~F.col("guest"), F.col("links")))
    columns = ("shard", "cell", "far", "node", "times", "vector", "shards", "links", "guest")
    searched = visits.select(*columns).groupBy("shard", "cell", "far")
    return staging.keep(searched.applyInArrow(_searcher(threshold), "a long, b long, n long, partners long"), f"{name}-found")


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = 0.95,
    least_recall: float = 0.97,
    audited: int = 256,
    overlap: int = 2,
    staging: Staging | None = None,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row: links are pairs with a cosine of ``threshold`` or more.

    Vectors that are null, empty, zero or hold nulls or non-finite numbers link with nothing, and so
    do vectors of different dimensions. Equal vectors and exact multiples are one node with a count. ``component_id`` is
    the smallest vec_id reachable; repeated rows count as further vectors. Clusters are fitted on
    ``SAMPLE`` vectors, but all are indexed and searched. After each build the recall is measured for
    ``audited`` vectors of each number of links against all; where it is below ``least_recall`` for vectors
    with few, some or many partners, the build is repeated with twice the
    overlap. If that does not help, all clusters are compared that can hold partners by their angles,
    which loses no link. Shards of over ``CELL`` vectors are cut into
    cells of half as many, and a task holds two of these at most.
    """
    staging = staging_for(embeddings.sparkSession, staging)
    kind = embeddings.schema["embedding"].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))):
        kind = ArrayType(DoubleType())
    rows = embeddings.select("vec_id", F.col("embedding").cast(kind).alias("vector"))
    rows = rows.withColumn("vector", F.when(usable(F.col("vector")), scaled(F.col("vector"))))
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    given = rows.where("vector IS NOT NULL")
    grouped = given.groupBy("hash", "vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("times"))
    nodes = staging.keep(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = None
    for attempt in range(4):
        found = _searched(nodes, threshold, overlap << attempt, staging, f"search-{attempt}")
        recall = _audit(nodes, found, threshold, audited)
        if recall >= least_recall:
            break
    else:
        found = _compared(nodes, threshold, staging, "compared")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b IS NOT NULL").select("a", "b"), staging, "links")
    labelled = nodes.select("node", "low", "times", "hash", "vector").join(groups, "node", "left")
    group, others = F.coalesce("component", "node"), F.col("times") - 1 + F.coalesce("n", F.lit(0))
    counted = labelled.join(counts, "node", "left")
    labelled = staging.keep(
        counted.select("hash", "vector", "low", group.alias("group"), others.alias("n_links")), "labelled"
    )
    lowest = labelled.groupBy("group").agg(F.min("low").alias("component_id"))
    known = labelled.join(lowest, "group").select("hash", "vector", "n_links", "component_id")
    joined = rows.join(known, ["hash", "vector"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
