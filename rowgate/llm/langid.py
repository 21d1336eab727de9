"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from rowgate.llm.common import carried, giving_back, unpacked

UNDETERMINED = "und"
BITS = 15
BUCKETS = 1 << BITS
PIECE = 1 << 18
WORD_CHARACTER = re.compile(r"[^\W\d_]")
# Odd multipliers of the n-gram hash, one for each place.
PLACES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
EDGE = "\x00\x00"


def has_letter(text: str) -> bool:
    """True for a character of the Unicode letter categories; numbers such as ½, ² and ① are none."""
    return any(found[0].isalpha() for found in WORD_CHARACTER.finditer(text))


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts cut into pieces with the two characters before each, in lots of about ``PIECE`` characters."""
    owners: list[int] = []
    parts: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        padded = EDGE + text
        for at in range(0, len(text), PIECE):
            part = padded[at : at + PIECE + 2]
            owners.append(i)
            parts.append(part)
            held += len(part)
            if held >= PIECE:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def _buckets(parts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For n = 1, 2, 3 the bucket of the n-gram that ends at each character; which count; where parts begin."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(lengths) - lengths
    counted = np.ones(len(codes), dtype=bool)
    counted[starts] = False
    counted[starts + 1] = False
    mixed = codes * PLACES[0]
    one = mixed ^ (mixed >> np.uint32(15))
    two = mixed.copy()
    two[1:] ^= (codes[:-1] + np.uint32(1)) * PLACES[1]
    three = two.copy()
    three[2:] ^= (codes[:-2] + np.uint32(7)) * PLACES[2]
    shift = np.uint32(32 - BITS)
    return [(h * PLACES[k]) >> shift for k, h in enumerate((one, two, three))], counted, starts


@dataclass(frozen=True)
class LanguageModel:
    """Log-probabilities of the buckets by language (BUCKETS x languages) and of the languages."""

    languages: list[str]
    grams: np.ndarray
    priors: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its probability; texts without a letter are ``und``."""
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not known:
            return names, scores
        sums = np.tile(self.priors, (len(known), 1))
        for owners, parts in _pieces([texts[i].lower() for i in known]):
            orders, counted, starts = _buckets(parts)
            logs = self.grams[orders[0]]
            for order in orders[1:]:
                logs += self.grams[order]
            logs[~counted] = 0
            np.add.at(sums, owners, np.add.reduceat(logs, starts, axis=0, dtype=np.float64))
        sums -= sums.max(axis=1, keepdims=True)
        chances = np.exp(sums)
        chances /= chances.sum(axis=1, keepdims=True)
        for row, i in enumerate(known):
            best = int(chances[row].argmax())
            names[i], scores[i] = self.languages[best], chances[row, best]
        return names, scores


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts by language of one partition; bucket -1 holds the texts. At most 64 languages are held."""
    held: dict[str, np.ndarray] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for language, counts in held.items():
            full = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(full)), pa.array(full.astype(np.int32) - 1), pa.array(counts[full])],
                names=["lang", "bucket", "n"],
            )
        held.clear()

    for batch in batches:
        by_language: dict[str, list[str]] = {}
        for language, text in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
            by_language.setdefault(language, []).append(text)
        for language, texts in by_language.items():
            if language not in held and len(held) >= 64:
                yield from flushed()
            counts = held.setdefault(language, np.zeros(BUCKETS + 1, dtype=np.int64))
            counts[0] += len(texts)
            for _, parts in _pieces([t.lower() for t in texts]):
                orders, counted, _ = _buckets(parts)
                for order in orders:
                    counts[1:] += np.bincount(order[counted], minlength=BUCKETS)
    yield from flushed()


def train(docs: DataFrame, learned: Column, smoothing: float = 0.5, most_languages: int = 512) -> LanguageModel:
    """Fit on every row of ``docs`` (text, lang) that ``learned`` allows and that has both, with a letter or not.

    Tasks count grams by language and hand over at most ``BUCKETS`` sums a language, so the driver gets
    languages x buckets rows whatever the size of the input; more than ``most_languages`` is an error.
    """
    rows = docs.where(learned & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string"), F.col("lang").cast("string")
    )
    counted = rows.mapInArrow(giving_back(_counts), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = (
        counted.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("ns")).orderBy("lang")
    )
    found = packed.take(most_languages + 1)
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = [r["lang"] for r in found]
    table = np.zeros((BUCKETS + 1, len(languages)))
    for i, row in enumerate(found):
        table[np.asarray(row["buckets"], dtype=np.int64) + 1, i] = row["ns"]
    grams = table[1:] + smoothing
    grams = np.log(grams / grams.sum(axis=0, keepdims=True)) if languages else grams
    priors = np.log(table[0] / table[0].sum()) if languages else table[0]
    return LanguageModel(languages, grams.astype(np.float32), priors)


def _scorer(broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            names, scores = model.predict([t if t is not None else "" for t in batch.column("text").to_pylist()])
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(names, pa.string()), pa.array(scores)],
                names=[*kept.schema.names, "lang_pred", "score"],
            )

    return score


def predict(frame: DataFrame, model: LanguageModel) -> DataFrame:
    """``frame``'s columns but ``text``, with ``lang_pred`` and ``score`` (the probability of that language).

    Null texts and texts without a letter get ``und`` and 0. Equal scores go to the first language in
    alphabetical order. The model (at most 512 languages x 32,768 buckets x 4 bytes) is broadcast.
    """
    kept = [f for f in frame.schema.fields if f.name != "text"]
    schema = StructType(kept).add("lang_pred", StringType()).add("score", DoubleType())
    broadcast = frame.sparkSession.sparkContext.broadcast(model)
    return frame.mapInArrow(giving_back(_scorer(broadcast)), schema)


def identified(docs: DataFrame, model: LanguageModel, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with ``least_score`` or more; all columns as they were.

    Nulls, empty texts and texts without a letter go. Any further columns, also ones called
    ``score`` or ``lang_pred``, and repeated rows stay.
    """
    packed = carried(docs, text=F.col("text").cast("string"))
    scored = predict(packed, model)
    return unpacked(scored.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)))
