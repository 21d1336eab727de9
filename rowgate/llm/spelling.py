"""Spelling variants of a corpus's words: one-edit neighbours found in a reduced alphabet.

The letters of a word are hashed to a few symbols. Words one edit apart have reduced words one edit
apart or equal, so the one-edit neighbourhood of each reduced word is generated in full and joined with
the reduced vocabulary. (An insertion is met as the longer word's deletion, and a replacement from
the side with the smaller symbol.) With few symbols the neighbourhood is small; what agrees only by the
reduction is told apart on the words themselves.

A neighbourhood is a set of 64-bit hashes, rolled along the word. A bitmap of fixed size of the
vocabulary's hashes drops most of them before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import staging_for
from rowgate.staging import Staging

# The letters of a word, those lower-cased, and which words count.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT, MISSPELT, TIMES = 7, 2, 31, 10

SYMBOLS = 8
#: Longer words take their neighbours from open places, which is linear in the length of a word.
LONG = 64
#: Reduced words shared by more words than this are crowded; their words take that way too.
CROWDED = 64
PLACE_BITS = 26
#: Letters worked on at a time.
LOT = 1 << 16
BROADCAST_ROWS = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BACK = pow(_BASE, -1, 1 << 64)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_LENGTH = np.uint64(0xA0761D6478BD642F)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the runs of letters of whole texts with A-Z lower-cased, and how often each is there.

    Where 31 divides the checksum of ``<doc_id>:<run>``, the run has lost the letter that the checksum
    points to. Words have at least seven letters and are there at least twice. Null texts have none; a
    null id is the empty text. Counts are combined in each task before the shuffle, and only runs long
    enough are taken out of a text, which changes nothing, as no run gets longer.
    """
    text = F.col("text").cast("string")
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0))
    given = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    each = docs.select(given.alias("id"), F.explode(runs).alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    summed = each.withColumn("sum", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("sum") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = summed.select(F.when(F.col("sum") % MISSPELT == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def symbol_values(symbols: int) -> np.ndarray:
    """A 64-bit number for each of 256 letters; letters with the same symbol share it."""
    mixed = (np.arange(256, dtype=np.uint64) % np.uint64(symbols) + np.uint64(1)) * _SPREAD
    return (mixed ^ (mixed >> np.uint64(29))) * _SPREAD


def _powers(count: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(count, _BASE, np.uint64))))


class Rolled:
    """The hashes of some words, and of the words with one letter taken out, by sums along the letters."""

    def __init__(self, words: list[bytes], values: np.ndarray):
        self.letters = np.frombuffer(b"".join(words), np.uint8)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.owner = np.repeat(np.arange(len(words)), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.letters)) - starts[self.owner]
        self.power = _powers(int(self.sizes.max(initial=0)))[self.place]
        self.value = values[self.letters]
        term = self.value * self.power
        before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)))
        self.whole = before[starts + self.sizes] - before[starts]
        head = before[:-1] - before[starts][self.owner]
        tail = self.whole[self.owner] - head - term
        self.without = head + tail * np.uint64(_BACK)
        self.open = head + tail


def keyed(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes told apart by the length of the word, spread over all bits."""
    mixed = (hashes + sizes.astype(np.uint64) * _LENGTH) * _SPREAD
    return (mixed ^ (mixed >> np.uint64(32))) * _SPREAD


def places(keys: np.ndarray) -> np.ndarray:
    """The bits of the bitmap that keys stand for."""
    return (keys >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def neighbourhood(words: list[bytes], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the reduced words one edit away from each reduced word, and whose they are.

    One for each deletion (of equal neighbours, the first) and each replacement by a greater symbol.
    """
    rolled = Rolled(words, symbol_values(symbols))
    kind = rolled.letters % symbols
    first = np.concatenate(([True], (kind[1:] != kind[:-1]) | (rolled.place[1:] == 0))) if len(kind) else np.empty(0, bool)
    keys = [keyed(rolled.without[first], rolled.sizes[rolled.owner[first]] - 1)]
    owners = [rolled.owner[first]]
    values = symbol_values(symbols)
    for other in range(1, symbols):
        below = np.flatnonzero(kind < other)
        hashes = rolled.open[below] + values[other] * rolled.power[below]
        keys.append(keyed(hashes, rolled.sizes[rolled.owner[below]]))
        owners.append(rolled.owner[below])
    return np.concatenate(keys), np.concatenate(owners)


def _lots(words: list[bytes]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, word in enumerate(words):
        if i > start and held + len(word) > LOT:
            yield start, i
            start, held = i, 0
        held += len(word)
    if start < len(words):
        yield start, len(words)


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _reduced(symbols: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``key`` and ``place`` of each reduced word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rolled = Rolled(_latin(batch.column("word")), symbol_values(symbols))
            keys = keyed(rolled.whole, rolled.sizes)
            columns = [batch.column("word"), batch.column("n"), pa.array(keys.view(np.int64)), pa.array(places(keys))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "key", "place"])

    return rows


def _generated(symbols: int, bitmap: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each neighbour of a reduced word that can be in the vocabulary."""
    bits = np.frombuffer(bitmap, np.uint8)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _latin(batch.column("word"))
            for low, high in _lots(words):
                keys, owner = neighbourhood(words[low:high], symbols)
                place = places(keys)
                there = np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
                mine = pa.array(owner[there] + low)
                columns = [pa.array(keys[there].view(np.int64)), batch.column("word").take(mine), batch.column("n").take(mine)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "n"])

    return rows


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, kind, number``: each word (kind 0), the word less a letter (1) and the word with a letter open (2).

    Letters keep all their values here, so words meet by chance only: at most one word is a given word, and
    two words agree but for the open letter.
    """
    values = symbol_values(256)
    for batch in batches:
        words, numbers = _latin(batch.column("word")), batch.column("number").to_numpy()
        for low, high in _lots(words):
            rolled = Rolled(words[low:high], values)
            own = numbers[low:high]
            first = np.concatenate(([True], (rolled.letters[1:] != rolled.letters[:-1]) | (rolled.place[1:] == 0)))
            sizes = rolled.sizes[rolled.owner]
            opened = keyed(rolled.open + rolled.power * np.uint64(0xFF51AFD7ED558CCD), sizes)
            keys = [keyed(rolled.whole, rolled.sizes), keyed(rolled.without[first], sizes[first] - 1), opened]
            owners = [own, own[rolled.owner[first]], own[rolled.owner]]
            kinds = np.repeat(np.arange(3, dtype=np.int32), [len(k) for k in keys])
            columns = [np.concatenate(keys).view(np.int64), kinds, np.concatenate(owners)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["key", "kind", "number"])


def _bitmap(keys: DataFrame) -> bytes:
    """A bit for each ``place`` in use: ``2 ** (PLACE_BITS - 3)`` bytes, 8 MB, whatever the vocabulary."""
    place = F.col("place") + 1  # Spark counts bits from 1
    built = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = bytearray(1 << (PLACE_BITS - 3))
    for bucket, bits in built.collect():
        out[(bucket - 1) * len(bits) : bucket * len(bits)] = bits
    return bytes(out)


def _near(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def _pairs(a: DataFrame, b: DataFrame, on: Column) -> DataFrame:
    """Pairs of rows that meet and are one edit apart, as they are."""
    met = a.alias("a").join(b.alias("b"), on & _near(F.col("a.word"), F.col("b.word")))
    return met.select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")
    )


def near_pairs(words: DataFrame, staging: Staging, symbols: int = SYMBOLS, crowded: int = CROWDED, long: int = LONG) -> DataFrame:
    """``word, n, other, other_n``: all pairs of words one inserted, deleted or replaced letter apart, each once.

    Words of up to ``long`` letters meet through reduced words. A reduced word of more than ``crowded``
    words is left out there, so a generated row meets a bounded number of words; its words, those that
    generate it, and long words meet by their own letters with one taken out or left open, where at most as
    many words meet as there are letters. Both ways are exact, and so is their sum.
    """
    short = words.where(F.length("word") <= long)
    keys = staging.keep(short.select("word", "n").mapInArrow(_reduced(symbols), "word string, n long, key long, place long"), "reduced")
    bitmap = _bitmap(keys.select("place"))
    rows = short.select("word", "n").mapInArrow(_generated(symbols, bitmap), "key long, word string, n long")
    hot = staging.keep(keys.groupBy("key").count().where(F.col("count") > crowded).select("key"), "crowded")
    some = hot.count()
    apart = words.where(F.length("word") >= long)
    near_keys = keys
    if some:
        hot = F.broadcast(hot) if some <= BROADCAST_ROWS else hot
        rows = staging.keep(rows, "generated")
        of_hot = rows.join(hot, "key", "left_semi").select("word").union(keys.join(hot, "key", "left_semi").select("word"))
        apart = words.join(of_hot.distinct(), "word", "left_semi").union(apart).distinct()
        rows, near_keys = rows.join(hot, "key", "left_anti"), keys.join(hot, "key", "left_anti")
    generated = _pairs(rows, near_keys, F.col("a.key") == F.col("b.key"))
    same = _pairs(near_keys, near_keys, (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word")))
    apart = staging.keep(apart, "apart")
    opened = apart.select("word", "number").mapInArrow(_opened, "key long, kind int, number long")
    a, b = opened.where("kind > 0").alias("a"), opened.where("kind <> 1").alias("b")
    meet = (F.col("a.key") == F.col("b.key")) & F.expr(
        "(a.kind = 1 AND b.kind = 0) OR (a.kind = 2 AND b.kind = 2 AND a.number < b.number)"
    )
    numbers = a.join(b, meet).select(F.col("a.number").alias("one"), F.col("b.number").alias("two")).distinct()
    ones = apart.select(F.col("number").alias("one"), "word", "n")
    twos = apart.select(F.col("number").alias("two"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    wide = numbers.join(ones, "one").join(twos, "two").where(_near(F.col("word"), F.col("other")))
    found = generated.union(same).union(wide.select("word", "n", "other", "other_n"))
    turned = F.col("word") > F.col("other")
    ordered = found.select(
        F.when(turned, F.col("other")).otherwise(F.col("word")).alias("word"),
        F.when(turned, F.col("other_n")).otherwise(F.col("n")).alias("n"),
        F.when(turned, F.col("word")).otherwise(F.col("other")).alias("other"),
        F.when(turned, F.col("n")).otherwise(F.col("other_n")).alias("other_n"),
    )
    return ordered.distinct()


def roots(forms: DataFrame, staging: Staging, most_rounds: int = 20) -> DataFrame:
    """``word, root``: the end of the chain of forms from each word that has one.

    Each round doubles the steps taken. Along a chain counts grow tenfold, so a few rounds do; a round
    is a join whose one side has a row a word, which adaptive execution can split for a hot form.
    """
    current = forms.select("word", F.col("form").alias("root"))
    for number in range(most_rounds):
        current = staging.keep(current, f"roots-{number}")
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if current.join(onward, "root", "left_semi").isEmpty():
            return current
        current = current.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    raise RuntimeError(f"forms did not end in {most_rounds} rounds")


def variants(docs: DataFrame, symbols: int = SYMBOLS, crowded: int = CROWDED, staging: Staging | None = None) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs`` (columns ``doc_id`` and ``text``).

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it is at least ten times as frequent, else null, and ``root`` the last form reached
    from the word, or the word. Null, empty and blank texts add no word; repeated rows count each; no
    document or no word gives no row. A text is one run of a million letters as well as many short words.
    """
    staging = staging_for(docs.sparkSession, staging)
    words = staging.keep(vocabulary(docs).withColumn("number", F.monotonically_increasing_id()), "words")
    pairs = staging.keep(near_pairs(words, staging, symbols, crowded), "pairs")
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    counted = pairs.union(back).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("n").alias("own"), best.alias("best"))
    often = -F.col("best.less") >= TIMES * F.col("own")
    linked = staging.keep(
        counted.select(
            "word", "n_near",
            F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "linked",
    )
    ends = roots(linked.where(F.col("form").isNotNull()), staging)
    whole = words.select("word", "n").join(linked, "word", "left").join(ends, "word", "left")
    return whole.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def variants_sql() -> str:
    """``variants`` over ``documents``, with neighbours by open places, for DuckDB."""
    runs = f"unnest(regexp_extract_all(text, '[{LETTERS}]{{{LEAST_LETTERS},}}'))"
    letter = "CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END"
    code = f"list_concat([58::BIGINT], flatten(list_transform(string_split(run, ''), lambda c: {letter})))"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: unicode(c)::BIGINT)"
    step = "lambda a, b: xor(a >> 8, steps[CAST((xor(a, b) & 255) + 1 AS INTEGER)])"
    return f"""
        WITH RECURSIVE bits AS (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS step
            FROM (SELECT unnest(range(256)) AS i)
        ), rule AS (SELECT list(step ORDER BY i) AS steps FROM bits
        ), found AS (
            SELECT doc_id, translate({runs}, '{UPPER}', '{LOWER}') AS run FROM documents
        ), each AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL
        ), summed AS (
            SELECT run, n, xor(list_reduce(list_concat(list_concat([4294967295], {digits}), {code}), {step}), 4294967295) AS h
            FROM each, rule
        ), spelt AS (
            SELECT CASE WHEN h % {MISSPELT} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                        ELSE run END AS word, n
            FROM summed
        ), words AS MATERIALIZED (
            SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= {LEAST_LETTERS}
            GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
        ), places AS (
            SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
        ), opened AS (
            SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM places
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM opened a
            JOIN opened b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM opened a JOIN words b ON a.head || a.tail = b.word
            UNION SELECT b.word, a.word, a.n FROM opened a JOIN words b ON a.head || a.tail = b.word
        ), counted AS (
            SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, form := other)) AS best FROM near GROUP BY word
        ), formed AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -best.less >= {TIMES} * n THEN best.form END AS form,
                   CASE WHEN -best.less >= {TIMES} * n THEN -best.less END AS form_n
            FROM words LEFT JOIN counted USING (word)
        ), chain AS (
            SELECT word, form AS reached FROM formed WHERE form IS NOT NULL
            UNION ALL
            SELECT c.word, f.form FROM chain c JOIN formed f ON c.reached = f.word WHERE f.form IS NOT NULL
        ), ends AS (
            SELECT c.word, c.reached FROM chain c JOIN formed f ON c.reached = f.word WHERE f.form IS NULL
        )
        SELECT word, n, n_near, form, form_n, coalesce(reached, word) AS root FROM formed LEFT JOIN ends USING (word)
    """
