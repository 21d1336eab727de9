"""Adaptive quality rules against plain Python and DuckDB, and on edge cases."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from rowgate.llm import adaptive
from rowgate.llm import queries as registered
from rowgate.staging import Staging

SF = "/root/testdata/sf0.001"
GAP = re.compile(r"[\x20\x09-\x0D]+")


def counts(text):
    """The five counts by looking at every window of the text."""
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    lines = [line for line in text.split("\n") if GAP.sub("", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def shares(text):
    n, chars, symbols, dup, repeated = counts(text)
    lines = [line for line in (text or "").split("\n") if GAP.sub("", line)]
    capitals = sum("A" <= c <= "Z" for c in text or "")
    return {
        "symbols": symbols / n if n else 0.0,
        "dup_lines": dup / len(lines) if lines else 0.0,
        "repeats": repeated / n if n else 0.0,
        "capitals": capitals / chars if chars else 0.0,
        "word_length": chars / n if n else 0.0,
    }


def failed_base(text):
    n, _, _, _, repeated = counts(text)
    return n < 10 or 100 * repeated > 20 * n


def verdicts(rows, least):
    """Base verdict and rules broken for (lang, source, text) rows, quartiles taken from sorted values."""
    groups = defaultdict(list)
    for lang, source, text in rows:
        if not failed_base(text):
            for key in [("s", lang, source), ("l", lang), ("t",)]:
                groups[key].append(shares(text))

    def near(x):
        if x <= adaptive.TINY:
            return 0.0
        return adaptive.GROWTH ** math.ceil(math.log(x) / math.log(adaptive.GROWTH)) * 2 / (1 + adaptive.GROWTH)

    def quartile(group, name, part):
        values = sorted(s[name] for s in group)
        return near(values[max(0, math.ceil(len(values) * part / 4) - 1)])

    for lang, source, text in rows:
        if failed_base(text):
            yield True, ["base"]
            continue
        group = next((g for k in [("s", lang, source), ("l", lang)] if len(g := groups[k]) >= least), groups[("t",)])
        broken = []
        for rule in adaptive.RULES:
            q1, q3 = quartile(group, rule.name, 1), quartile(group, rule.name, 3)
            reach, x = rule.reach * max(q3 - q1, rule.spread), shares(text)[rule.name]
            if rule.low and x < q1 - reach:
                broken.append(rule.name + "_low")
            if not rule.low and x > q3 + reach:
                broken.append(rule.name)
        yield False, broken


@pytest.mark.parametrize("least", [1, 15, 10_000])
def test_verdicts_equal_plain_python(documents, least):
    rows = documents.collect()
    found = {r["doc_id"]: r for r in adaptive.judged(documents, least_documents=least).collect()}
    expected = verdicts([(r["lang"], r["source"], r["text"]) for r in rows], least)
    for row, (base, broken) in zip(rows, expected, strict=True):
        r = found[row["doc_id"]]
        assert tuple(r[c] for c in adaptive.BASE) == counts(row["text"])
        assert (r["base_failed"], sorted(r["failed"]), r["kept"]) == (base, sorted(broken), not broken)


def test_query_equals_its_sql(spark):
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
        cursor = connection.execute(registered.oracle_sql()["op13_adaptive_quality"])
        names = [d[0] for d in cursor.description]
        expected = sorted(cursor.fetchall())
    found = registered.op13_adaptive_quality(spark, SF)
    assert sorted(map(tuple, found.select(*names).collect())) == expected


def test_plan_holds_no_python_and_shuffles_no_text(spark, documents):
    plan = adaptive.accepted(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
    assert "Exchange hashpartitioning" not in plan.split("== Physical Plan ==")[1]
    judged = adaptive.judged(documents)._jdf.queryExecution().toString()
    assert "Python" not in judged and "text" not in judged.split("== Physical Plan ==")[1]


def test_sketches_merge_to_the_sketch_of_all(spark, documents):
    rows = adaptive.measured(documents.select("doc_id", "lang", "source", "text"))
    names = ["symbols", "word_length"]
    whole = adaptive.sketches(rows.withColumns({"lang": F.lit("x"), "source": F.lit("x")}), names)
    parts = adaptive.merged(adaptive.sketches(rows, names), [])
    columns = ["name", "bucket", "n"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, parts.select(columns).collect()))


def test_quantiles_are_right_to_half_a_bucket(spark):
    values = [0.0, *[1.37**k / 50 for k in range(25)]]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for r in frame.select("x", adaptive.bucket_value(adaptive.bucket(F.col("x"))).alias("y")).collect():
        assert abs(r["y"] - r["x"]) <= r["x"] * (adaptive.GROWTH - 1) / 2 * 1.001


def test_windows_that_overlap_repeat_and_touch(spark):
    texts = [
        "a b c d e a b c d e",
        "a a a a a a",
        "a a a a a",
        "a b c d e f g h x a b c d e f g h y a b c d e",
        "x y a b c d e z b c d e z q",
        " ".join(f"w{i % 37}" for i in range(40_000)),
        "$$$ # <b> é漢   x\x0by\x85z",
        "one\ntwo\none\n\n\n \n one\ntwo\r\n",
        "a b\rc\x1cd",
    ]
    frame = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in adaptive.judged(frame).collect():
        assert tuple(r[c] for c in adaptive.BASE) == counts(texts[r["doc_id"]]), texts[r["doc_id"]][:50]


def test_edge_rows(spark, edge_docs, empty_docs):
    found = adaptive.judged(edge_docs).collect()
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect()}
    assert len(found) == edge_docs.count()
    for r in found:
        assert tuple(r[c] for c in adaptive.BASE) == counts(texts[r["doc_id"]])
        assert r["base_failed"] == failed_base(texts[r["doc_id"]]) and not (r["base_failed"] and r["kept"])
    kept = adaptive.accepted(edge_docs)
    assert kept.columns == edge_docs.columns
    # Both rows with id 6 are kept, and so is the one without an id and a source.
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in found if r["kept"])
    assert adaptive.judged(empty_docs).collect() == [] and adaptive.accepted(empty_docs).collect() == []
    clash = edge_docs.withColumnRenamed("rank", "kept").withColumnRenamed("slot", "symbols")
    assert adaptive.judged(clash, keep=("doc_id", "kept")).columns.count("kept") == 1
    assert adaptive.accepted(clash).columns == clash.columns


def test_a_hot_source_has_thresholds_of_its_own(spark, tmp_path):
    plain = "the cat sat on the mat and then a dog came in with number {}"
    symbols = "{} <b> # the cat & the dog | a mat $ and so * on % to be"
    rows = [(i, plain.format(i), "en", f"s{i % 7}") for i in range(700)]
    rows += [(i, symbols.format(i), "en", "code") for i in range(700, 1300)]
    rows += [(i, symbols.format(i), "en", "s0") for i in range(1300, 1303)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r for r in adaptive.judged(frame, least_documents=50, staging=Staging(spark, str(tmp_path))).collect()}
    assert all(found[i]["kept"] for i in range(1300))
    assert all(found[i]["failed"] == ["symbols"] for i in range(1300, 1303))


def test_labelled_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = [(labels[r["doc_id"]], r["base_failed"], r["kept"]) for r in adaptive.judged(docs).collect() if r["doc_id"] in labels]
    clean = [kept for good, base, kept in found if good and not base]
    junk = [kept for good, _, kept in found if not good]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.05 * len(junk)
