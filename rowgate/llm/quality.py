"""Quality classifier: a sparse ensemble of rules over text statistics, scored by Spark column expressions."""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import carried, lots, staging_for, unpacked
from rowgate.staging import Staging

STATS = "__stats"
LOT = 1 << 18
SHORT, LONG = 3, 12
Condition = tuple[str, str, float]

# Classes of characters; all others are letters and marks.
CAPITAL, DIGIT, SPACE, BREAK, STOP, EXCLAIM, QUOTE, BAR, SYMBOL = range(1, 10)
CLASSES = 10
NAMES = (
    "length", "words", "word_length", "distinct_words", "distinct_lines", "repeats", "short_words", "long_words",
    "symbol_ends", "exclaim_ends", "capital_words", "bars", "capitals", "digits", "symbols", "exclaims", "stops",
    "spaces", "breaks",
)


def _class_of(char: str) -> int:
    if char == "\n":
        return BREAK
    if char in ".,;:":
        return STOP
    if char in "!?":
        return EXCLAIM
    if char in "'\"()-":
        return QUOTE
    if char == "|":
        return BAR
    if char.isspace():
        return SPACE
    kind = unicodedata.category(char)
    return CAPITAL if kind == "Lu" else DIGIT if kind == "Nd" else 0 if kind[0] in "LMN" else SYMBOL


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each character of the basic plane; beyond it all count as symbols."""
    table = np.full(1 << 16, SYMBOL, np.uint8)
    for code in range(0xFFFF):
        if not 0xD800 <= code < 0xE000:
            table[code] = _class_of(chr(code))
    return table


def measure(texts: list[str]) -> np.ndarray:
    """The statistics of each text, in the order of ``NAMES``; all are 0 or 1 for the empty text."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), len(NAMES)))
    for low, high in lots(texts, LOT):
        out[low:high] = _measured(texts[low:high], lengths[low:high])
    return out


def _measured(texts: list[str], lengths: np.ndarray) -> np.ndarray:
    """Characters are counted over the joined texts, each closed by a space of its own."""
    rows = len(texts)
    codes = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[np.minimum(codes, 0xFFFF)]
    ends = np.cumsum(lengths + 1) - 1
    owner = np.repeat(np.arange(rows), lengths + 1)
    counts = np.bincount(owner * CLASSES + kinds, minlength=rows * CLASSES).reshape(rows, CLASSES).astype(float)
    counts[:, SPACE] -= 1
    gap = (kinds == SPACE) | (kinds == BREAK)
    first = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    last = np.flatnonzero(~gap[:-1] & gap[1:])
    of_word, size = owner[first], last - first + 1
    capital = (kinds[first] == CAPITAL) & (size > 1) & (kinds[np.minimum(first + 1, len(kinds) - 1)] == CAPITAL)
    final = kinds[last]

    def per_text(chosen: np.ndarray) -> np.ndarray:
        return np.bincount(of_word[chosen], minlength=rows)

    words = np.bincount(of_word, minlength=rows)
    repeats, distinct, lines = np.zeros(rows), np.ones(rows), np.ones(rows)
    for i, text in enumerate(texts):
        parts = text.split()
        if parts:
            repeats[i] = sum(map(eq, parts, islice(parts, 1, None)))
            distinct[i] = len(set(parts)) / len(parts)
        split = text.split("\n")
        lines[i] = len(set(split)) / len(split)
    one, some = np.maximum(lengths, 1), np.maximum(words, 1)
    found = {
        "length": np.log1p(lengths),
        "words": np.log1p(words),
        "word_length": np.where(words > 0, lengths / some, 0),
        "distinct_words": distinct,
        "distinct_lines": lines,
        "repeats": repeats / some,
        "short_words": per_text(size <= SHORT) / some,
        "long_words": per_text(size >= LONG) / some,
        "symbol_ends": per_text((final == SYMBOL) | (final == BAR)) / some,
        "exclaim_ends": per_text(final == EXCLAIM) / some,
        "capital_words": per_text(capital) / some,
        "bars": counts[:, BAR] / some,
        "capitals": counts[:, CAPITAL] / one,
        "digits": counts[:, DIGIT] / one,
        "symbols": (counts[:, SYMBOL] + counts[:, BAR]) / one,
        "exclaims": counts[:, EXCLAIM] / one,
        "stops": counts[:, STOP] / one,
        "spaces": (counts[:, SPACE] + counts[:, BREAK]) / one,
        "breaks": counts[:, BREAK] / one,
    }
    return np.stack([found[name] for name in NAMES], axis=1)


def statistics(text: Column) -> Column:
    """The statistics of each whole text as a struct of doubles; a null text counts as empty."""

    @F.arrow_udf(", ".join(f"{name} double" for name in NAMES))
    def measured(texts: pa.Array) -> pa.Array:
        table = measure(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(column) for column in table.T.copy()], names=list(NAMES))

    return measured(F.coalesce(text.cast("string"), F.lit("")))


def with_statistics(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` with the statistics as the struct ``__stats`` in place of ``text``."""
    rest = [c for c in frame.columns if c != text]
    return frame.select(*rest, statistics(F.col(text)).alias(STATS))


@dataclass(frozen=True)
class RuleModel:
    """A logistic model over rules; a rule is a conjunction of conditions on statistics."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self) -> Column:
        """The chance of label 1, a column over ``__stats``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(_holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(rule: tuple[Condition, ...]) -> Column:
    holds = F.lit(True)
    for name, side, value in rule:
        stat = F.col(f"{STATS}.{name}")
        holds = holds & (stat <= value if side == "<=" else stat > value)
    return holds


def _simplified(path: list[Condition]) -> tuple[Condition, ...]:
    """A path with one condition for each statistic and side: the tightest."""
    tight: dict[tuple[str, str], float] = {}
    for name, side, value in path:
        old = tight.get((name, side))
        tight[name, side] = value if old is None else (min if side == "<=" else max)(old, value)
    return tuple(sorted((n, s, v) for (n, s), v in tight.items()))


def tree_rules(described: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """The conjunctions at all nodes below the root of a tree, from Spark's description of it."""
    path: list[tuple[int, Condition]] = []
    found = []
    for line in described.splitlines():
        if m := re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1])
            path = [x for x in path if x[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
            found.append(_simplified([c for _, c in path]))
    return found


def train(
    docs: DataFrame,
    labels: DataFrame,
    learned: Column,
    most_rows: int = 30_000,
    trees: int = 16,
    depth: int = 3,
    lasso: float = 0.001,
    staging: Staging | None = None,
) -> RuleModel:
    """Fit on at most ``most_rows`` labelled documents, the first by a hash of their id, where ``learned`` allows.

    ``learned`` is a condition on ``doc_id``. Several labels of an id are averaged (from a half on: 1);
    null labels and ids without a text row are left out. A random forest of shallow trees gives the
    rules, a lasso logistic regression their weights; rules of weight 0 are dropped. With one
    class or none, or where no tree finds a split, the model is constant.
    """
    staging = staging_for(docs.sparkSession, staging)
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(learned)
    averaged = marked.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    chosen = averaged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    texts = docs.select("doc_id", F.col("text").alias("__text")).join(F.broadcast(chosen), "doc_id")
    measured = with_statistics(texts, "__text")
    names = list(NAMES)
    features = array_to_vector(F.array(*[F.col(f"{STATS}.{n}") for n in names]))
    rows = staging.keep(measured, "labelled").coalesce(1).sortWithinPartitions("doc_id", *[f"{STATS}.{n}" for n in names])
    frame = rows.select("label", STATS, features.alias("features")).cache()
    share = frame.agg(F.avg("label")).first()[0]
    chance = 0.5 if share is None else share
    constant = RuleModel(math.log((chance + 1e-3) / (1 - chance + 1e-3)), ())
    if chance in (0.0, 1.0) or share is None:
        frame.unpersist()
        return constant
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=17
    ).fit(frame)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString, names)})
    if not rules:
        frame.unpersist()
        return constant
    held = F.array(*[_holds(rule).cast("double") for rule in rules])
    indicated = frame.select("label", array_to_vector(held).alias("features"))
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(indicated)
    frame.unpersist()
    weights = fitted.coefficients.toArray().tolist()
    return RuleModel(float(fitted.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``doc_id, score`` of every row; null and empty texts are scored like any other, repeated rows stay."""
    measured = with_statistics(docs.select("doc_id", F.col("text").alias("__text")), "__text")
    return measured.select("doc_id", model.score().alias("score"))


def accepted(docs: DataFrame, model: RuleModel, least_score: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with at least ``least_score``; all columns stay as they were, whatever their names."""
    measured = with_statistics(carried(docs, __text=F.col("text")), "__text")
    return unpacked(measured.where(model.score() >= least_score))
