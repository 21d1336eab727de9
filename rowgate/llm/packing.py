"""Best-fit packing of tokenized documents into sequences by minimum bin slack."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from rowgate.llm.common import binaries, give_back, lots, staging_for, sums_before, text_bytes
from rowgate.staging import Staging

WORDS_HELD = 1_000_000
LOT_BYTES = 1 << 21
# The pattern that the tokenizer file splits words by, here for words whose letters
# are all ASCII or Latin-1, which have no case or composition of their own.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile("\0|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\0 \t\n\r\v\f]+")
# What a text of plain words does not hold: other characters, and the beginning of a special token.
ODD = re.compile(r"[^!-~À-ÖØ-öø-ÿ \t\n\r\v\f]|<\|")
END = "\0"
SPECIAL = "<|"
RANKS = 1 << 40
#: Sequences packed together where the order of documents is kept, and the numbers set aside for them.
WINDOW = 256
SEQUENCES_A_WINDOW = 1 << 21
#: Runs of rows whose begins are broadcast, some hundred bytes each.
BROADCAST_RUNS = 200_000
FILE, BLOCK = "__file", "__block"


class Memory(dict):
    """What was seen lately: when it is full, the entries not used since it was full before are forgotten."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most = most
        self.old: dict = {}

    def missing(self, keys: Iterable) -> list:
        """Those of different ``keys`` that are not known; all others can be looked up."""
        if len(self) > self.most // 2:
            self.old = dict(self)
            self.clear()
        unknown = []
        for key in [k for k in keys if k not in self]:
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self[key] = value
        return unknown


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit bytes, with the ids of words remembered.

    The tokenizer drops white space and merges nothing across it, so a text's ids are those of its
    words one after another. Texts of plain letters are cut by the tokenizer's own pattern and
    their parts encoded many at a time. Any other text is taken word by word; a word that is not plain is
    encoded as it stands.
    """

    def __init__(self, path: str, words_held: int = WORDS_HELD) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: Memory = Memory(words_held // 4)
        self.parts: Memory = Memory(words_held)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, parts: list[str]) -> None:
        """Encodes parts a thousand to a text; each part ends with a token that ends a word."""
        for at in range(0, len(parts), 1000):
            lot = parts[at : at + 1000]
            ids = np.array(self._encode([" ".join(lot)])[0], dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(lot) and cuts[-1] == len(ids):
                pieces = _cut(ids.tobytes(), cuts * 4)
            else:
                pieces = [np.array(x, dtype="<u4").tobytes() for x in self._encode(lot)]
            self.parts.update(zip(lot, pieces, strict=True))

    def _learn(self, words: list[bytes]) -> None:
        plain: dict[bytes, list[str]] = {}
        others: list[tuple[bytes, str]] = []
        for word in words:
            text = word.decode("utf-8", "replace")
            if SPECIAL not in text and PLAIN.fullmatch(text):
                plain[word] = PARTS.findall(text.lower())
            else:
                others.append((word, text))
        self._learn_parts(self.parts.missing({part for parts in plain.values() for part in parts}))
        for word, parts in plain.items():
            self.words[word] = b"".join([self.parts[p] for p in parts])
        for (word, _), ids in zip(others, self._encode([t for _, t in others]), strict=True):
            self.words[word] = np.array(ids, dtype="<u4").tobytes()

    def _encode_words(self, texts: list[bytes]) -> list[bytes]:
        """Word by word, for texts with letters or marks that are not plain."""
        split = [t.split() for t in texts]
        self._learn(self.words.missing(set().union(*split)))
        known = self.words
        return [b"".join([known[w] for w in words]) for words in split]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """All texts at once: their parts are numbered, so that only different ones are looked up, and ids gathered."""
        cut = PARTS.findall("".join([t + END for t in texts]).lower())
        index = pa.array(cut, pa.string()).dictionary_encode().indices.to_numpy()
        # Numbers are given in order, so a part is new where the largest number so far grows.
        first = np.flatnonzero(np.diff(np.maximum.accumulate(index), prepend=-1))
        parts = [cut[i] for i in first.tolist()]
        del cut
        self._learn_parts(self.parts.missing([p for p in parts if p != END]))
        known = self.parts
        pieces = [b"" if p == END else known[p] for p in parts]
        flat = np.frombuffer(b"".join(pieces), "<u4")
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        starts, taken = np.cumsum(sizes) - sizes, sizes[index]
        ends = np.cumsum(taken)
        places = np.repeat(starts[index] - ends + taken, taken)
        places += np.arange(len(places))
        return _cut(flat[places].tobytes(), ends[index == parts.index(END)] * 4)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, which is given as UTF-8, whatever its length."""
        read = [t.decode("utf-8", "replace") for t in texts]
        plain = [ODD.search(t) is None for t in read]
        of_plain = iter(self._encode_plain([t for t, p in zip(read, plain, strict=True) if p]) if any(plain) else ())
        of_others = iter(self._encode_words([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(of_plain if p else of_others) for p in plain]


def _cut(data: bytes, ends: np.ndarray) -> list[bytes]:
    """``data`` in pieces that end there."""
    places = [0, *ends.tolist()]
    return [data[low:high] for low, high in pairwise(places)]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, words_held: int = WORDS_HELD) -> Encoder:
    """One encoder a Python worker, kept from task to task."""
    if (path, words_held) not in _ENCODERS:
        _ENCODERS[path, words_held] = Encoder(path, words_held)
    return _ENCODERS[path, words_held]


@contextmanager
def lean_encoder(path: str) -> Iterator[Encoder]:
    """An encoder that holds a tenth of the words, and gives their memory back at the end of a task.

    The tokenizer stays: one made anew for each task takes as much again while it is read, and some MB more every time.
    """
    lean = encoder(path, WORDS_HELD // 10)
    yield lean
    lean.words, lean.parts = Memory(lean.words.most), Memory(lean.parts.most)
    give_back()


def _cutter(path: str, capacity: int, end_id: int, extra: Sequence[str] = (), lean: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Encodes documents, ends each with ``end_id``, cuts it; numbers the pieces of each length in the partition.

    All in one pass of Python: a second one in the same stage would be as many workers again.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lean_encoder(path) if lean else nullcontext(encoder(path)) as found:
            yield from coded(batches, found.encode, LOT_BYTES // 4 if lean else LOT_BYTES)

    def coded(batches: Iterator[pa.RecordBatch], encode: Callable, lot: int) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        run, total = None, 0
        for batch in batches:
            texts, ids = binaries(batch.column("text")), batch.column("doc_id").to_pylist()
            parts = batch.column("part").to_pylist()
            others = [batch.column(name) for name in extra]
            runs = list(zip(*[other.to_pylist() for other in others], strict=True)) if others else [()] * len(texts)
            for low, high in lots(texts, lot):
                out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids", "part", "rank")}
                rows: list[int] = []
                within: list[int] = []
                for k, tokens in enumerate(encode(texts[low:high]), low):
                    tokens += end
                    if runs[k] != run:
                        run, total = runs[k], 0
                    for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                        chunk = tokens[at : at + 4 * capacity]
                        n = len(chunk) // 4
                        values = (ids[k], piece, at // 4, n, chunk, parts[k], int(seen[n]))
                        for column, value in zip(out.values(), values, strict=True):
                            column.append(value)
                        rows.append(k)
                        within.append(total)
                        total += n
                        seen[n] += 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
                if extra:
                    arrays += [other.take(pa.array(rows, pa.int64())) for other in others] + [pa.array(within, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*out, *extra, "within"] if extra else list(out))

    return cut


@dataclass(frozen=True)
class Pattern:
    """A filling of a sequence, used for ``times`` sequences from ``first`` on: how many pieces of each length."""

    first: int
    times: int
    pieces: dict[int, int]


def fullest(lengths: list[int], left: dict[int, int], room: int) -> dict[int, int]:
    """Pieces with the largest sum of at most ``room``, as many of each length as are left, by subset-sum over bitsets.

    Lengths come longest first, and are used up in that order, so long pieces are placed while short
    ones remain. Bit ``s`` of a state says that sum ``s`` can be reached with the lengths so far.
    """
    states = [1]
    mask = (1 << (room + 1)) - 1
    taken = []
    for length in lengths:
        if length > room:
            continue
        state, copies, step = states[-1], min(left[length], room // length), 1
        while copies:
            use = min(step, copies)
            state |= (state << (length * use)) & mask
            copies -= use
            step *= 2
        taken.append(length)
        states.append(state)
        if state >> room & 1:
            break
    total = states[-1].bit_length() - 1
    chosen: dict[int, int] = {}
    for i in range(len(taken) - 1, -1, -1):
        length = taken[i]
        while not states[i] >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def minimum_slack(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Fillings for all pieces: each takes the longest piece left and the fullest combination beside it.

    The combination is then removed as often as the counts allow it, as every repeat would find it
    again. Each filling uses up a length or leaves less than a filling's worth of it, so there are
    at most a few fillings for each of the ``capacity`` lengths, whatever the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    found: list[Pattern] = []
    first = 0
    while left:
        lengths = sorted(left, reverse=True)
        longest = lengths[0]
        left[longest] -= 1
        pieces = fullest([n for n in lengths if left[n]], left, capacity - longest)
        left[longest] += 1
        pieces[longest] = pieces.get(longest, 0) + 1
        times = min(left[n] // k for n, k in pieces.items())
        found.append(Pattern(first, times, pieces))
        first += times
        for n, k in pieces.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return found


def _places(found: list[Pattern]) -> dict[str, np.ndarray]:
    """For runs of pieces of a length: the key of the first, the sequence and the offset it has, how many a sequence."""
    rows = []
    used: dict[int, int] = {}
    for pattern in found:
        offset = 0
        for length, each in sorted(pattern.pieces.items(), reverse=True):
            begin = used.get(length, 0)
            rows.append((length * RANKS + begin, begin, pattern.first, each, offset, length))
            used[length] = begin + each * pattern.times
            offset += each * length
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
    return dict(zip(("key", "begin", "first", "each", "offset", "length"), table.T.copy(), strict=True))


def _spots(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of pieces given by their length and their number among those of that length."""
    row = np.searchsorted(table["key"], length * RANKS + rank, "right") - 1
    turn, slot = np.divmod(rank - table["begin"][row], table["each"][row])
    return table["first"][row] + turn, table["offset"][row] + slot * length


def _placer(broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = broadcast.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = _spots(table, length, rank)
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    return place


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    extra: Mapping[str, str] | None = None,
    lean: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids, part, rank``: every document's ids and ``end_id``, cut at ``capacity``.

    ``tokenizer`` is the path of a tokenizer file that drops white space, readable on every machine.
    A null, empty or blank text is just ``end_id``. Only longer documents are cut; the last piece may
    be shorter. ``ids`` holds little-endian 32-bit numbers. ``part`` and ``rank`` number the pieces
    of each length, for ``placed``. Texts are encoded whole, word by word, whatever their length. ``extra``
    names further columns of the result and the columns of ``docs`` that they are; ``within`` then says how many tokens
    were before a piece in its run of rows with the same values of these. A worker keeps what it has
    learned of words from task to task, some 250 MB; a ``lean`` one holds a tenth and gives it back after each.
    """
    extra = extra or {}
    rows = docs.select(
        F.col("doc_id").cast("long"),
        text_bytes(F.col("text")).alias("text"),
        F.spark_partition_id().alias("part"),
        *[F.col(column).alias(name) for name, column in extra.items()],
    )
    schema = StructType.fromDDL("doc_id long, piece int, start long, length long, ids binary, part int, rank long")
    if extra:
        schema = StructType([*schema.fields, *[rows.schema[name] for name in extra]]).add("within", LongType())
    return rows.mapInArrow(_cutter(tokenizer, capacity, end_id, list(extra), lean), schema)


def placed(cut: DataFrame, capacity: int = 2048, staging: Staging | None = None) -> DataFrame:
    """``cut`` (from ``pieces``; columns may be dropped or added) with ``sequence_id`` and ``offset``.

    The driver gets one count for each of the ``capacity`` lengths and makes the fillings from them;
    they, at most some thousands of rows, are broadcast. A piece's rank among those of its length
    comes from counts by partition, so a common length is not gathered anywhere. Pieces are written
    once, without which a lost executor could number them anew. Repeated rows and null ids are
    documents like any other; an empty table has no piece.
    """
    spark = cut.sparkSession
    staging = staging_for(spark, staging)
    kept = staging.keep(cut, "pieces")
    sizes = kept.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    begins = sums_before(sizes, ["length"], "part", "n", "before").drop("n")
    columns = [c for c in kept.columns if c not in ("part", "rank")]
    ranked = kept.join(begins, ["length", "part"]).select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
    broadcast = spark.sparkContext.broadcast(_places(minimum_slack(counts, capacity)))
    schema = StructType([kept.schema[c] for c in columns]).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(_placer(broadcast), schema)


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, staging: Staging | None = None
) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``: all documents packed into sequences of ``capacity``."""
    return placed(pieces(docs, tokenizer, capacity, end_id), capacity, staging)


def _in_file_order(docs: DataFrame) -> tuple[Column, Column]:
    """What tells the runs of rows that a task reads in order: file and first byte, else the partition."""
    try:
        docs.select("_metadata.file_block_start")
    except AnalysisException:
        return F.lit(""), F.spark_partition_id().cast("long")
    return F.col("_metadata.file_name"), F.col("_metadata.file_block_start")


def _window_packer(capacity: int, columns: list[str]) -> Callable[[pa.Table], pa.Table]:
    def pack(rows: pa.Table) -> pa.Table:
        length = rows.column("length").to_numpy()
        order = np.lexsort((rows.column("within").to_numpy(), length))
        starts = np.flatnonzero(np.diff(length[order], prepend=-1))
        rank = np.empty(len(length), np.int64)
        rank[order] = np.arange(len(length)) - np.repeat(starts, np.diff([*starts, len(length)]))
        sizes, counts = np.unique(length, return_counts=True)
        found = _places(minimum_slack(dict(zip(sizes.tolist(), counts.tolist(), strict=True)), capacity))
        sequence, offset = _spots(found, length, rank)
        first = rows.column("window")[0].as_py() * SEQUENCES_A_WINDOW
        return rows.select(columns).append_column("sequence_id", pa.array(first + sequence)).append_column("offset", pa.array(offset))

    return pack


def packed_in_order(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    window: int = WINDOW,
    staging: Staging | None = None,
) -> DataFrame:
    """``packed``, with sequences in the order of the documents from window to window.

    Documents are taken in the order of their files' names and the rows in them, as ``mixing.in_order``
    writes them (rows of no file: from partition to partition). Every ``window`` sequences' worth of tokens
    is packed for itself and its sequences are numbered after those before, so the first part of the
    sequences holds the first part of the documents, to within a window. A task packs a window at a time, of
    bounded size whatever the documents, as long ones are cut first; the driver sees no length. Pieces are
    shuffled once, by window. Null, empty and repeated documents are as in ``packed``; no document, no piece.
    """
    staging = staging_for(docs.sparkSession, staging)
    file, block = _in_file_order(docs)
    cut = pieces(docs.withColumns({FILE: file, BLOCK: block}), tokenizer, capacity, end_id, {"file": FILE, "block": BLOCK}, lean=True)
    columns = ["doc_id", "piece", "start", "length", "ids"]
    kept = staging.keep(cut.select(*columns, "file", "block", "within"), "pieces-in-order")
    totals = kept.groupBy("file", "block").agg(F.max(F.col("within") + F.col("length")).alias("tokens"))
    # One row a run of rows, as many as the scan has splits; names with more digits come later.
    earlier = Window.orderBy(F.length("file"), "file", "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = staging.keep(totals.select("file", "block", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("begin")), "begins")
    few = begins.count() <= BROADCAST_RUNS
    placed_ = kept.join(F.broadcast(begins) if few else begins, ["file", "block"])
    windowed = placed_.select(
        *columns, (F.col("begin") + F.col("within")).alias("within"),
        F.floor((F.col("begin") + F.col("within")) / (window * capacity)).alias("window"),
    )
    schema = StructType([kept.schema[c] for c in columns]).add("sequence_id", LongType()).add("offset", LongType())
    return windowed.groupBy("window").applyInArrow(_window_packer(capacity, columns), schema)
