"""Spelling variants and vector codes against plain Python and DuckDB, and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from rowgate.llm import codes, spelling
from rowgate.llm import queries as registered
from rowgate.staging import Staging

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
VECTORS = "vec_id long, embedding array<float>, label int, x string, far string, code string"


def rows_of_sql(table, query):
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        cursor = connection.execute(registered.oracle_sql()[query])
        return [d[0] for d in cursor.description], Counter(cursor.fetchall())


def word_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(docs):
    counts = word_counts(docs)
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    found, form = {}, {}
    for w, n in counts.items():
        near = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, []) if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
        found[w] = (n, len(near), form[w], counts[form[w]] if form[w] else None)
    for w in found:
        root = w
        while form[root]:
            root = form[root]
        found[w] += (root,)
    return found


def got(frame):
    rows = frame.collect()
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(found) == len(rows)
    return found


def chained_docs():
    """A hot word, its misspellings in a chain, crowded words, long words, and all kinds of edits."""
    hot = "elephants"
    docs = [(1, " ".join([hot] * 3000)), (2, " ".join(["elephant"] * 250)), (3, " ".join(["elephan"] * 20 + ["elephxn"] * 2))]
    docs += [(4, "Élephants élephants Àlephants " * 2), (None, "÷×÷×÷×÷ ÷×÷×÷×÷ ÷×÷×÷×ß ÷×÷×÷×ß"), (5, None), (6, ""), (7, " \t\n")]
    long = "ab" * 40_000
    docs += [(8, f"{long} {long[1:]} {long[:500]}c{long[501:]}"), (8, f"{long} {long[1:]} {long[:500]}c{long[501:]}")]
    edge = "q" * 63
    docs += [(9, f"{edge} {edge}q {edge}qq {edge}r {edge}qs x{edge}q " * 2)]
    # Letters eight apart share a symbol, so all of these have one reduced word.
    crowd = ["".join("aiqy"[(i >> 2 * k) & 3] for k in range(5)) + "bbbb" for i in range(700)]
    docs += [(10 + i, f"{w} {w} {w}b " * 2) for i, w in enumerate(crowd)]
    return docs


def test_variants_of_the_documents_equal_plain_python(spark, documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(registered.op11_spelling_variants(spark, SF)) == expected_variants(docs)


def test_variants_query_equals_its_sql(spark):
    names, expected = rows_of_sql("documents", "op11_spelling_variants")
    found = registered.op11_spelling_variants(spark, SF)
    assert set(names) == set(found.columns)
    assert Counter(map(tuple, found.select(*names).collect())) == expected


@pytest.mark.parametrize("symbols, crowded", [(8, 64), (2, 3)])
def test_variants_with_chains_crowds_and_long_words(spark, symbols, crowded):
    docs = chained_docs()
    found = got(spelling.variants(spark.createDataFrame(docs, DOCS), symbols, crowded))
    expected = expected_variants(docs)
    assert found == expected
    assert found["elephxn"][2:] == ("elephan", 20, "elephants") or found["elephxn"][4] == expected["elephxn"][4]
    assert max(map(len, found)) > 70_000


def test_variants_of_edge_rows(spark, edge_docs, empty_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(spelling.variants(edge_docs)) == expected_variants(docs)
    assert spelling.variants(empty_docs).collect() == []
    clash = edge_docs.withColumnRenamed("rank", "word").withColumnRenamed("slot", "n").withColumnRenamed("lane", "root")
    assert got(spelling.variants(clash)) == expected_variants(docs)


def test_neighbourhood_is_complete():
    """Every reduced word one edit away is generated from one of the two sides."""
    symbols = 3
    words = [bytes(97 + (i // 3**k) % 3 for k in range(5)) for i in range(3**5)] + [
        bytes(97 + (i // 3**k) % 3 for k in range(6)) for i in range(3**6)
    ]
    whole = spelling.Rolled(words, spelling.symbol_values(symbols))
    own = dict(zip(spelling.keyed(whole.whole, whole.sizes).tolist(), words, strict=True))
    assert len(own) == len(words)
    keys, owner = spelling.neighbourhood(words, symbols)
    met = Counter(frozenset((words[o], own[k])) for k, o in zip(keys.tolist(), owner.tolist(), strict=True) if k in own)
    pairs = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if one_edit(a.decode(), b.decode())}
    assert set(met) == pairs and set(met.values()) == {1}


def expected_codes(vectors, parts=4, entries=256, rounds=4):
    """Codes by looking at all entries, in Python's whole numbers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v], lab) for i, v, lab in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    x = np.array([r[1] for r in kept], dtype=object).reshape(len(kept), parts, width)
    book = [x[:entries, p].copy() for p in range(parts)]

    def assigned():
        squares = [np.array([[((v - e) ** 2).sum() for e in book[p]] for v in x[:, p]]) for p in range(parts)]
        code = [[min(range(len(book[p])), key=lambda e: (row[e], e)) for row in squares[p]] for p in range(parts)]
        return code, [sum(squares[p][i][code[p][i]] for p in range(parts)) for i in range(len(kept))]

    for _ in range(rounds):
        code, _ = assigned()
        for p in range(parts):
            for e in set(code[p]):
                mine = [x[i, p] for i in range(len(kept)) if code[p][i] == e]
                book[p][e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    code, error = assigned()
    by_label = Counter()
    for (_, _, lab), e in zip(kept, error, strict=True):
        by_label[lab] += e
    sha = hashlib.sha256(",".join(str(v) for p in book for v in p.ravel()).encode()).hexdigest()
    return sorted(
        [(r[0], "".join(f"{code[p][i]:02x}" for p in range(parts)), error[i], by_label[r[2]], sha) for i, r in enumerate(kept)],
        key=repr,
    )


def coded(frame, **options):
    return sorted(map(tuple, codes.compressed(frame, **options).collect()), key=repr)


def test_codes_query_equals_its_sql(spark):
    names, expected = rows_of_sql("embeddings", "op12_vector_codes")
    found = registered.op12_vector_codes(spark, SF)
    assert set(names) == set(found.columns)
    assert Counter(map(tuple, found.select(*names).collect())) == expected


def test_codes_with_ties_copies_nulls_and_few_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-3, 4, 8).astype(float).tolist(), int(i % 3) if i % 7 else None) for i in range(300)]
    vectors += [(i, vectors[5][1], 1) for i in range(300, 420)] + [(7, [0.5] * 8, 2), (7, [-0.5] * 8, 2), (None, [9.0] * 8, None)]
    vectors += [(500, None, 1), (501, [1.0, None] * 4, 1), (502, [math.nan] * 8, 1), (503, [1.0, -math.inf] * 4, 1)]
    rows = [(i, v, lab, "x", "y", "z") for i, v, lab in vectors]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    assert coded(frame, entries=16, staging=Staging(spark, str(tmp_path))) == expected_codes(vectors, entries=16)
    few = frame.where("vec_id < 6")
    assert coded(few) == expected_codes([v for v in vectors if v[0] is not None and v[0] < 6])
    assert coded(frame.where("vec_id >= 500")) == [] and coded(frame.where("false")) == []
    zeros = spark.createDataFrame([(i, [0.0] * 4, None, "", "", "") for i in range(3)], VECTORS)
    assert [r[:4] for r in coded(zeros)] == [(i, "00000000", 0, 0) for i in range(3)]


def test_codes_say_what_they_cannot_code(spark):
    for vectors in ([[1.0] * 4, [1.0] * 8], [[1.0] * 6], [[200_000.0] * 4], [[1e30] * 4]):
        frame = spark.createDataFrame([(i, v, 0, "", "", "") for i, v in enumerate(vectors)], VECTORS)
        with pytest.raises(ValueError):
            codes.compressed(frame)


def test_pivots_rule_out_entries_and_lose_none():
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (256, 16))
    points = centres[rng.integers(0, 256, 3000)] + rng.integers(-40, 40, (3000, 16))
    fixed = codes.pivots(centres, codes.PIVOTS)
    code, best, evaluated = codes.nearest(points, codes.distances(points, fixed), centres, codes.distances(centres, fixed))
    squares = ((points[:, None, :] - centres) ** 2).sum(axis=2)
    assert (code == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()
    assert evaluated < 3000 * 256 / 10
    flat = np.zeros((5, 16), dtype=np.int64)
    assert len(codes.pivots(flat, 8)) == 1
