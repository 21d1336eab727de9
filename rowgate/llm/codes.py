"""Product codes of vectors: integer codebooks by part, nearest entries found through pivots (LAESA).

The distances of every part to a few fixed pivots are computed once and written down. In a round only
the entries change, and their distances to the same pivots are cheap. By the triangle inequality the
difference of the two distances bounds the distance of part and entry from below, for the pivot
that tells most. The bounds put the entries in order and rule most of them out; what is left is
evaluated in whole numbers, so the codes are those of a search through all entries.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.llm.common import staging_for
from rowgate.staging import Staging

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 8
#: Below this, squares of differences of a part of 16 components fit 64 bits with room.
MOST = 1 << 27
#: Parts searched at a time, and entries evaluated in order before all that are left.
LOT, FIRST = 2048, 6
#: Relative room for rounding in bounds, some thousand times the error of a double.
ROOM = 1e-12

Book = list[np.ndarray]


def whole_vectors(df: DataFrame, identifier: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, x``: the vectors without null and non-finite components, floored to ``SCALE``-ths."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    least, most = F.lit(float(-MOST)), F.lit(float(MOST))
    scaled = F.transform(vector, lambda v: F.greatest(least, F.least(most, F.floor(v.cast("double") * SCALE))).cast("int"))
    named = df.select(F.col(f"`{identifier}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias(vector))
    return named.where(F.col(vector).isNotNull() & finite).select("vec_id", "label", scaled.alias("x"))


def _check(vectors: DataFrame, parts: int) -> tuple[int, int]:
    """How many vectors there are, and their length; a ValueError if they cannot be coded together."""
    size, top = F.size("x"), F.array_max(F.transform("x", lambda v: F.abs(v)))
    rows, low, high, most = vectors.agg(F.count(F.lit(1)), F.min(size), F.max(size), F.max(top)).first()
    if rows and (low != high or low % parts):
        raise ValueError(f"vectors of {low} to {high} components do not make {parts} equal parts")
    if rows and most is not None and most >= MOST:
        raise ValueError(f"a component of {MOST / SCALE} or more is too large for whole numbers of 64 bits")
    return rows, low or 0


def pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries far from one another: each next one has the largest distance to those taken, ties to lower index."""
    chosen = [0]
    far = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(entries)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return entries[chosen]


def distances(points: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """The Euclidean distance of each point to each fixed one: roots of exact squares."""
    return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1).astype(np.float64)) for p in fixed], axis=1)


def nearest(
    points: np.ndarray, far: np.ndarray, entries: np.ndarray, entry_far: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """For each point the nearest entry (ties to lower index), the squared distance, and how many were evaluated.

    ``far`` and ``entry_far`` are the distances to the pivots. The entries with the lowest bounds come
    first; of the others, only those are evaluated whose bound is not above the best found.
    """
    rows = len(points)
    bound = np.abs(far[:, :1] - entry_far[:, 0])
    for p in range(1, far.shape[1]):
        np.maximum(bound, np.abs(far[:, p, None] - entry_far[:, p]), out=bound)
    bound -= ROOM * (far.max(axis=1, keepdims=True) + entry_far.max())
    np.maximum(bound, 0, out=bound)
    bound *= bound
    bound *= 1 - ROOM
    first = min(FIRST, len(entries))
    start = np.sort(np.argpartition(bound, first - 1, axis=1)[:, :first], axis=1)
    squares = ((points[:, None, :] - entries[start]) ** 2).sum(axis=2)
    place = squares.argmin(axis=1)
    here = np.arange(rows)
    best, code = squares[here, place], start[here, place]
    np.put_along_axis(bound, start, np.inf, axis=1)
    row, entry = np.nonzero(bound <= best.astype(np.float64)[:, None])
    if len(row):
        found = ((points[row] - entries[entry]) ** 2).sum(axis=1)
        heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        least = np.minimum.reduceat(found, heads)
        owner, sizes = row[heads], np.diff(np.concatenate((heads, [len(row)])))
        # Entries of a point stand in order, so the first with the least square has the lowest index.
        ties = np.where(found == np.repeat(least, sizes), entry, len(entries))
        lowest = np.minimum.reduceat(ties, heads)
        better = (least < best[owner]) | ((least == best[owner]) & (lowest < code[owner]))
        best[owner[better]], code[owner[better]] = least[better], lowest[better]
    return code, best, rows * first + len(row)


def _lists(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def _coder(book: Book, fixed: Book) -> Callable[[pa.RecordBatch], Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Codes the rows of a batch in lots: part, first row, the lot's parts, their codes and squared distances."""
    entry_far = [distances(b, f) for b, f in zip(book, fixed, strict=True)]
    parts, width, shared = len(book), book[0].shape[1], [len(f) for f in fixed]
    ends = np.cumsum([0, *shared])

    def coded(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        x = _lists(batch.column("x"), parts * width, np.int64)
        far = _lists(batch.column("far"), int(ends[-1]), np.float64)
        for at in range(0, len(x), LOT):
            for p in range(parts):
                points = x[at : at + LOT, p * width : (p + 1) * width]
                code, best, _ = nearest(points, far[at : at + LOT, ends[p] : ends[p + 1]], book[p], entry_far[p])
                yield p, at, points, code, best

    return coded


def with_pivot_distances(vectors: DataFrame, fixed: Book) -> DataFrame:
    """``vectors`` with ``far``: each part's distances to the pivots of its position, one after another."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, width = len(fixed), fixed[0].shape[1]
        for batch in batches:
            x = _lists(batch.column("x"), parts * width, np.int64)
            far = np.concatenate([distances(x[:, p * width : (p + 1) * width], f) for p, f in enumerate(fixed)], axis=1)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * far.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "far"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("far", T.ArrayType(T.DoubleType()))])
    return vectors.mapInArrow(rows, schema)


def refined(vectors: DataFrame, book: Book, fixed: Book) -> Book:
    """The codebooks after one round: each used entry becomes the floored mean of its parts.

    A task adds up what it has and sends one row for each entry; the driver gets a number for each component
    of the codebooks, whatever the table's size.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros_like(b) for b in book], [np.zeros(len(b), np.int64) for b in book]
        coded = _coder(book, fixed)
        for batch in batches:
            for p, _, points, code, _ in coded(batch):
                np.add.at(sums[p], code, points)
                counts[p] += np.bincount(code, minlength=len(counts[p]))
        for p, count in enumerate(counts):
            used = np.flatnonzero(count)
            columns = [np.full(len(used), p, np.int32), used.astype(np.int32), count[used]]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(list(sums[p][used]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"],
            )

    partial = vectors.select("x", "far").mapInArrow(rows, "part int, entry int, n long, sums array<long>")
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "value"))
    totals = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    after = [b.copy() for b in book]
    for part, entry, place, n, value in totals.collect():
        after[part][entry, place] = value // n
    return after


def _codes(vectors: DataFrame, book: Book, fixed: Book) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _coder(book, fixed)
        for batch in batches:
            codes, error = np.zeros((len(book), batch.num_rows), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, at, _, code, best in coded(batch):
                codes[p, at : at + len(code)] = code
                error[at : at + len(code)] += best
            names = [row.tobytes().hex() for row in np.ascontiguousarray(codes.T)]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(names, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    schema = T.StructType(
        [vectors.schema["vec_id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    return vectors.select("vec_id", "label", "x", "far").mapInArrow(rows, schema)


def codebooks_sha256(book: Book) -> str:
    numbers = ",".join(str(v) for part in book for v in part.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def compressed(
    df: DataFrame,
    identifier: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    staging: Staging | None = None,
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector without null and non-finite components.

    ``code`` has two hexadecimal digits a part, ``error`` the squared distances to the entries summed
    over the parts, ``label_error`` its sum over the label's vectors, null labels together. Codebooks
    start from the vectors with the smallest ids (null ids last, equal ids by components); with fewer than
    ``entries`` of them they have as many entries as there are vectors. Repeated rows are coded each.
    No vector gives no row. Vectors of different lengths, of a length that ``parts`` does not divide, or with
    a component of 131,072 or more raise a ValueError. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two hexadecimal digits tells 256 entries apart")
    staging = staging_for(df.sparkSession, staging)
    vectors = whole_vectors(df, identifier, vector, label)
    rows, length = _check(vectors, parts)
    if not rows:
        none = vectors.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(n) for n in ("error", "label_error")])
        return none.withColumn("codebooks_sha256", F.lit(codebooks_sha256([])))
    first = vectors.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), parts, length // parts)
    book = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    fixed = [pivots(b, PIVOTS) for b in book]
    known = staging.keep(with_pivot_distances(vectors, fixed), "vectors")
    for _ in range(rounds):
        book = refined(known, book, fixed)
    coded = staging.keep(_codes(known, book, fixed), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # A row meets one row only, so adaptive execution can split a hot label.
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(book)).alias("codebooks_sha256"))


def compressed_sql() -> str:
    """``compressed`` over ``embeddings`` by a search through all entries, for DuckDB."""
    rounds = ""
    for r in range(ROUNDS + 1):
        rounds += f"""
        , squares{r} AS (
            SELECT vec_id, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM comps JOIN book{r} USING (part, place) GROUP BY ALL
        ), near{r} AS MATERIALIZED (
            SELECT * FROM squares{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
        )"""
        if r < ROUNDS:
            rounds += f"""
        , means{r} AS (
            SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n
            FROM comps JOIN near{r} USING (vec_id, part) GROUP BY ALL
        ), book{r + 1} AS MATERIALIZED (
            SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, c) AS c
            FROM book{r} LEFT JOIN means{r} USING (part, entry, place)
        )"""
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, embedding FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        ), listed AS (
            SELECT vec_id, unnest(range(len(embedding))) AS j, unnest(embedding) AS v, len(embedding) // {PARTS} AS width FROM kept
        ), comps AS MATERIALIZED (
            SELECT vec_id, j // width AS part, j % width AS place, CAST(floor(CAST(v AS DOUBLE) * {SCALE}) AS BIGINT) AS x FROM listed
        ), book0 AS MATERIALIZED (
            SELECT part, entry, place, x AS c FROM comps
            JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id)
        ){rounds}, codes AS (
            SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM near{ROUNDS} GROUP BY vec_id
        ), digest AS (
            SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{ROUNDS}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM codes JOIN kept USING (vec_id) CROSS JOIN digest
    """
