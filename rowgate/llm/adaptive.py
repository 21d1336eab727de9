"""Quality rules whose cutoffs come from the data: quantile sketches by language and source, then a join.

Everything is column expressions. A text is measured in its own row. What is measured goes into
sketches with logarithmic buckets, which bound the relative error of a quantile and merge by adding
counts: those of all sources of a language make the language's sketch, those of all languages the
whole table's. A document fails a rule if it lies beyond the fence of its group's quartiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.llm.common import carried, staging_for, unpacked
from rowgate.staging import Staging

# The characters between words and those that count as symbols.
GAPS = " \t\n\x0b\f\r"
GAP_RULE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Neighbouring buckets differ by 1 %, so a quantile is right to half of that.
GROWTH = 1.01
#: Shares up to this are zero.
TINY = 1e-6
ZERO_BUCKET = -(1 << 20)
#: Thresholds have a row a group of some hundred bytes; up to this many are broadcast, 50 MB at most.
BROADCAST_GROUPS = 200_000


@dataclass(frozen=True)
class Rule:
    """A document fails beyond the quartile by ``reach`` times the distance of the quartiles.

    ``spread`` is the least distance that counts: where nearly all documents are alike (most have no
    symbol at all), the quartiles meet, and a fence without room would fail all that differ.
    """

    name: str
    spread: float
    reach: float = 3.0
    low: bool = False


RULES = (
    Rule("symbols", 0.02),
    Rule("dup_lines", 0.15),
    Rule("repeats", 0.1),
    Rule("capitals", 0.05),
    Rule("word_length", 0.5),
    Rule("word_length", 0.5, low=True),
)
#: A group with fewer documents takes the thresholds of its language, a language those of the table.
LEAST_DOCUMENTS = 200


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measured(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the five counts of ``BASE``, ``base_failed`` and the shares the rules look at.

    Texts are taken whole; a null text counts as empty. A share of nothing is 0. Words in repeated
    windows are found by sorting the hashes of a text's windows with their places: a window is
    repeated if the one sorted next to it has its hash (64 bits). Each step is a projection that uses
    the last one's array more than once, so that Catalyst does not put one inside the other.
    """
    kept = [f"`{c}`" for c in rows.columns if c != text]
    whole = rows.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    lines = F.filter(F.split("__text", "\n"), lambda line: F.length(F.translate(line, GAPS, "")) > 0)
    words = F.array_remove(F.split("__text", GAP_RULE), "")
    split = whole.select(
        *kept,
        F.length(F.translate("__text", GAPS, "")).cast("long").alias("word_chars"),
        _count_of(F.col("__text"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("__text"), CAPITALS).alias("__capitals"),
        lines.alias("__lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("__words"),
    )
    starts = F.sequence(F.lit(0), F.size("__words") - WINDOW)
    window = F.transform(
        starts, lambda i: F.struct(F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)]).alias("h"), i.alias("p"))
    )
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    counted = split.select(
        *kept, "word_chars", "n_symbols", "__capitals",
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__words").cast("long").alias("n_words"),
        F.when(F.size("__words") >= WINDOW, F.sort_array(window)).otherwise(none).alias("__sorted"),
    )

    def repeated(window: Column, i: Column) -> Column:
        same = [F.coalesce(F.get("__sorted", i + step)["h"] == window["h"], F.lit(False)) for step in (-1, 1)]
        return F.when(same[0] | same[1], window["p"])

    base = ["word_chars", "n_symbols", "__capitals", "__n_lines", "n_dup_lines", "n_words"]
    found = F.sort_array(F.filter(F.transform("__sorted", repeated), lambda p: p.isNotNull()))
    placed = counted.select(*kept, *base, found.alias("__places"), F.size("__sorted").alias("__n_windows"))
    new = F.transform(
        "__places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW)))
    )
    covered = placed.select(
        *kept, *base,
        F.when(F.size("__places") > 0, F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x))
        .otherwise(0).cast("long").alias("n_repeat_words"),
    )

    def share(part: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(part).cast("double") / F.col(of)).otherwise(0.0)

    few = F.col("n_words") < LEAST_WORDS
    return covered.select(
        *kept, *BASE,
        (few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "n_words").alias("symbols"),
        share("n_dup_lines", "__n_lines").alias("dup_lines"),
        share("n_repeat_words", "n_words").alias("repeats"),
        share("__capitals", "word_chars").alias("capitals"),
        share("word_chars", "n_words").alias("word_length"),
    )


def bucket(value: Column) -> Column:
    """The sketch's bucket of a share: a power of ``GROWTH`` rounded up, or the bucket of zero."""
    power = F.ceil(F.log(value) / F.log(F.lit(GROWTH)))
    return F.when(value > TINY, power).otherwise(ZERO_BUCKET).cast("int")


def bucket_value(number: Column) -> Column:
    """The value that stands for a bucket: in the middle of its bounds by relative error."""
    middle = F.pow(F.lit(GROWTH), number.cast("double")) * (2 / (1 + GROWTH))
    return F.when(number > ZERO_BUCKET, middle).otherwise(0.0)


def sketches(shares: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sketch of each language and source: ``lang, source, name, bucket, n``, of rows that pass the base rules.

    Counts are combined in each task first, so a hot source sends one row for each bucket it fills. Rows
    are left out by not counting them: a filter would be pushed into the steps of ``measured``.
    """
    each = [F.struct(F.lit(n).alias("name"), bucket(F.col(n)).alias("bucket")) for n in names]
    cells = shares.select("lang", "source", "base_failed", F.explode(F.array(*each)).alias("cell"))
    counts = cells.groupBy("lang", "source", "cell.name", "cell.bucket").agg(F.count_if(~F.col("base_failed")).alias("n"))
    return counts.where("n > 0")


def merged(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of the groups ``by``, put together from finer ones by adding up."""
    return sketch.groupBy(*by, "name", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, ``name``, ``documents``, ``q1``, ``q3``: a window holds the buckets of one sketch, some thousand at most."""
    group = Window.partitionBy(*by, "name")
    below = F.sum("n").over(group.orderBy("bucket"))
    counted = sketch.select(*by, "name", "bucket", below.alias("below"), F.sum("n").over(group).alias("documents"))

    def quantile(part: int) -> Column:
        return bucket_value(F.min(F.when(F.col("below") * 4 >= F.col("documents") * part, F.col("bucket"))))

    return counted.groupBy(*by, "name").agg(
        F.first("documents").alias("documents"), quantile(1).alias("q1"), quantile(3).alias("q3")
    )


def fences(found: DataFrame, by: Sequence[str], rules: Sequence[Rule], prefix: str) -> DataFrame:
    """One row a group: ``by``, its number of documents and the fence of each rule, names behind ``prefix``."""

    def fence(rule: Rule) -> Column:
        reach = rule.reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(rule.spread))
        return F.col("q1") - reach if rule.low else F.col("q3") + reach

    columns = [
        F.max(F.when(F.col("name") == rule.name, fence(rule))).alias(f"{prefix}{i}") for i, rule in enumerate(rules)
    ]
    return found.groupBy(*by).agg(F.max("documents").alias(f"{prefix}documents"), *columns)


def thresholds(
    sketch: DataFrame, rules: Sequence[Rule] = RULES, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """``group_lang, group_source, group_documents, level`` and a fence ``fence0``, ``fence1`` ... for each rule.

    A group of fewer than ``least_documents`` takes its language's fences, and a language as small the
    whole table's. Null languages and sources are groups like others.
    """
    by_source = fences(quartiles(sketch, ["lang", "source"]), ["lang", "source"], rules, "s")
    of_lang = merged(sketch, ["lang"])
    by_lang = fences(quartiles(of_lang, ["lang"]), ["lang"], rules, "l")
    overall = fences(quartiles(merged(of_lang, []), []), [], rules, "t").first()  # one row, one number a rule
    same = F.col("a.lang").eqNullSafe(F.col("of"))
    joined = by_source.alias("a").join(by_lang.withColumnRenamed("lang", "of"), same)
    own, langs = F.col("sdocuments") >= least_documents, F.col("ldocuments") >= least_documents
    level = F.when(own, "source").when(langs, "language").otherwise("table")
    chosen = [
        F.when(own, F.col(f"s{i}")).when(langs, F.col(f"l{i}")).otherwise(F.lit(overall[f"t{i}"]).cast("double")).alias(f"fence{i}")
        for i in range(len(rules))
    ]
    return joined.select(
        F.col("a.lang").alias("group_lang"), F.col("a.source").alias("group_source"),
        F.col("sdocuments").alias("group_documents"), level.alias("level"), *chosen,
    )


def _joined(shares: DataFrame, fenced: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``shares`` with ``failed``, the names of the rules a row breaks or ``base`` alone, and ``kept``.

    Thresholds are counted, and broadcast up to ``BROADCAST_GROUPS`` rows; beyond, adaptive execution
    splits the partitions of hot groups, as each row meets one row only.
    """
    few = fenced.count() <= BROADCAST_GROUPS
    same = F.col("lang").eqNullSafe(F.col("group_lang")) & F.col("source").eqNullSafe(F.col("group_source"))
    joined = shares.join(F.broadcast(fenced) if few else fenced.hint("merge"), same, "left")

    def beyond(rule: Rule, i: int) -> Column:
        fence = F.col(f"fence{i}")
        return F.col(rule.name) < fence if rule.low else F.col(rule.name) > fence

    names = [f"{rule.name}_low" if rule.low else rule.name for rule in rules]
    base = F.when(F.col("base_failed"), F.lit("base"))
    beyond_fence = [F.when(~F.col("base_failed") & beyond(r, i), F.lit(names[i])) for i, r in enumerate(rules)]
    marked = joined.withColumn("failed", F.array_compact(F.array(base, *beyond_fence)))
    fence_columns = [f"fence{i}" for i in range(len(rules))]
    # One condition over both sides of the join: a part of it on the row alone would be pushed down and
    # have the steps of ``measured`` put into one another.
    return marked.withColumn("kept", F.size("failed") == 0).drop(
        "group_lang", "group_source", "group_documents", *fence_columns
    )


def judged(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    rules: Sequence[Rule] = RULES,
    least_documents: int = LEAST_DOCUMENTS,
    staging: Staging | None = None,
) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` with its counts, shares, ``level``, ``failed`` and ``kept``.

    Rows with fewer than ten words, or a fifth of them in repeated windows, fail the base rules, whatever
    the thresholds, and do not count for these. All others are kept if no rule fails them. Null, empty
    and blank texts have no word and fail. Repeated rows are judged each, null languages and sources
    are groups of their own, and an empty table gives no row. Measures are written to the shared folder
    once, without texts, and read for the sketches and for the verdict.
    """
    staging = staging_for(docs.sparkSession, staging)
    chosen = [F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep)]
    columns = docs.select(*chosen, F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    shares = staging.keep(measured(columns), "measures")
    sketch = staging.keep(sketches(shares, sorted({r.name for r in rules})), "sketches")
    fenced = staging.keep(thresholds(sketch, rules, least_documents), "thresholds")
    found = _joined(shares, fenced, rules)
    names = [F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)]
    measures = [*BASE, "base_failed", *sorted({r.name for r in rules}), "level", "failed", "kept"]
    return found.select(*names, *[c for c in measures if c not in keep])


def accepted(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    least_documents: int = LEAST_DOCUMENTS,
    staging: Staging | None = None,
) -> DataFrame:
    """The rows that ``judged`` keeps, all columns as they were; texts are read twice and neither shuffled nor written."""
    staging = staging_for(docs.sparkSession, staging)
    packed = carried(
        docs, lang=F.col("lang").cast("string"), source=F.col("source").cast("string"), text=F.col("text").cast("string")
    )
    sketch = staging.keep(sketches(measured(packed.drop("__row")), sorted({r.name for r in rules})), "sketches")
    fenced = staging.keep(thresholds(sketch, rules, least_documents), "thresholds")
    return unpacked(_joined(measured(packed), fenced, rules).where("kept"))


def judged_sql(rules: Sequence[Rule] = RULES, least_documents: int = LEAST_DOCUMENTS) -> str:
    """The rows of ``judged`` over ``documents``, identified by ``doc_id``, for DuckDB."""
    names = sorted({r.name for r in rules})
    cells = " UNION ALL ".join(f"SELECT lang, source, '{n}' AS name, {n} AS x FROM shares WHERE NOT base_failed" for n in names)
    gap, quartile = r"[\x20\x09-\x0D]", "min(CASE WHEN below * 4 >= documents * {} THEN bucket END)"

    def value(b: str) -> str:
        return f"CASE WHEN {b} > {ZERO_BUCKET} THEN pow({GROWTH}, {b}) * ({2 / (1 + GROWTH)!r}) ELSE 0.0 END"

    def fence(rule: Rule) -> str:
        reach = f"{rule.reach} * greatest(q3 - q1, {rule.spread})"
        side = f"q1 - {reach}" if rule.low else f"q3 + {reach}"
        return f"max(CASE WHEN name = '{rule.name}' THEN {side} END)"

    def level(by: str, columns: str) -> str:
        over = f"PARTITION BY {columns}name"
        return f"""{by}_sketch AS (
            SELECT {columns}name, bucket, sum(n) AS n FROM cells GROUP BY ALL
        ), {by}_below AS (
            SELECT *, sum(n) OVER ({over} ORDER BY bucket) AS below, sum(n) OVER ({over}) AS documents FROM {by}_sketch
        ), {by}_ends AS (
            SELECT {columns}name, any_value(documents) AS documents, {quartile.format(1)} AS b1, {quartile.format(3)} AS b3
            FROM {by}_below GROUP BY ALL
        ), {by}_quartiles AS (SELECT *, {value('b1')} AS q1, {value('b3')} AS q3 FROM {by}_ends
        ), {by}_fences AS (
            SELECT {columns}max(documents) AS documents, {", ".join(f"{fence(r)} AS f{i}" for i, r in enumerate(rules))}
            FROM {by}_quartiles GROUP BY ALL
        )"""

    def beyond(rule: Rule, i: int) -> str:
        chosen = f"CASE WHEN s.documents >= {least_documents} THEN s.f{i} WHEN l.documents >= {least_documents} THEN l.f{i} ELSE o.f{i} END"
        return f"coalesce(m.{rule.name} {'<' if rule.low else '>'} {chosen}, false)"

    return f"""
        WITH given AS (
            SELECT doc_id, lang, source, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents
        ), split AS (
            SELECT doc_id, lang, source, rid, t,
                   list_filter(string_split_regex(t, '{gap}+'), lambda w: w <> '') AS w,
                   list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM given
        ), listed AS (
            SELECT rid, list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) AS windows
            FROM split WHERE len(w) >= {WINDOW}
        ), windows AS (
            SELECT rid, unnest(windows) AS h, generate_subscripts(windows, 1) AS p FROM listed
        ), repeated AS (
            SELECT rid, p FROM windows QUALIFY count(*) OVER (PARTITION BY rid, h) > 1
        ), gaps AS (
            SELECT rid, coalesce(lead(p) OVER (PARTITION BY rid ORDER BY p) - p, {WINDOW}) AS gap FROM repeated
        ), covered AS (
            SELECT rid, sum(least(gap, {WINDOW})) AS covered FROM gaps GROUP BY rid
        ), counted AS (
            SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(t, '{gap}', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
                   CAST(length(t) - length(translate(t, '{CAPITALS}', '')) AS BIGINT) AS n_capitals,
                   CAST(len(lines) AS BIGINT) AS n_lines,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(covered, 0) AS BIGINT) AS n_repeat_words
            FROM split LEFT JOIN covered USING (rid)
        ), shares AS (
            SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
                   CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbols,
                   CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_lines,
                   CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeats,
                   CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0.0 END AS capitals,
                   CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS word_length
            FROM counted
        ), drawn AS ({cells}
        ), cells AS (
            SELECT lang, source, name,
                   CASE WHEN x > {TINY} THEN CAST(ceil(ln(x) / ln({GROWTH})) AS INTEGER) ELSE {ZERO_BUCKET} END AS bucket,
                   count(*) AS n
            FROM drawn GROUP BY ALL
        ), {level("source", "lang, source, ")}, {level("lang", "lang, ")}, {level("all", "")}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR {" OR ".join(beyond(r, i) for i, r in enumerate(rules))}) AS kept
        FROM shares m
        LEFT JOIN source_fences s ON m.lang IS NOT DISTINCT FROM s.lang AND m.source IS NOT DISTINCT FROM s.source
        LEFT JOIN lang_fences l ON m.lang IS NOT DISTINCT FROM l.lang
        CROSS JOIN all_fences o
    """
