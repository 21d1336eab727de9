"""Fingerprints and language-model scores against brute force, and on edge cases."""

import hashlib
import math
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowgate.llm import lm, minhash
from rowgate.llm import queries as registered

SF = "/root/testdata/sf0.001"


def in_order(rows):
    """Documents by descending id, nulls last, then by text; each with the one after it, the last with the first."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    return list(zip(rows, rows[1:] + rows[:1], strict=True))


def shingles(text, words=5):
    parts = text.lower().split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_minhash_query_against_exact_likeness(spark, documents):
    found = {r["doc_id"]: r for r in registered.op5_minhash_fingerprints(spark, SF).collect()}
    errors = []
    for (i, text), (j, following) in in_order([(r["doc_id"], r["text"]) for r in documents.collect()]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = found[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 2 * minhash.BINS
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        errors += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, following)]
        if text == following:
            assert r["fingerprint"] == found[j]["fingerprint"] and r["near_next"] == 1
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05 and max(map(abs, errors)) < 0.25


def test_equal_sets_and_short_texts(spark):
    texts = ["a b c d e f", "A  b\tc d e F", "one", "two", "", None, "  ", "a b", "b a"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = minhash.with_fingerprint(frame, "text", "print").collect()
    found = {r["id"]: r["print"] for r in rows}
    assert found[0] == found[1]
    assert found[4] == found[5] == found[6] == ""
    assert len({found[i] for i in (0, 2, 3, 7, 8)}) == 5
    pairs = spark.createDataFrame([(found[2], found[3]), (found[2], ""), ("", ""), (found[0], found[1])], "a string, b string")
    alike = [r[0] for r in pairs.select(minhash.likeness(F.col("a"), F.col("b"))).collect()]
    assert alike[0] < 0.05 and alike[1:] == [0.0, 1.0, 1.0]


def test_densified_bins_estimate_small_sets(spark):
    """Sets of a few shingles leave most bins empty; estimates must still have the right mean."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i : i + 24]), " ".join(words[i : i + 14] + ["x", "y", "z", *words[200 + i : 207 + i]])) for i in range(150)]
    frame = spark.createDataFrame(rows, "id long, left string, right string")
    both = minhash.with_fingerprint(minhash.with_fingerprint(frame, "left", "a"), "right", "b")
    found = [r[0] for r in both.select(minhash.likeness(F.col("a"), F.col("b"))).collect()]
    assert np.mean(found) == pytest.approx(jaccard(rows[0][1], rows[0][2]), abs=0.03)


@pytest.mark.parametrize("spread", [1, 1000, 10**12])
def test_next_document_over_gaps_in_the_ids(spark, spread):
    rows = [(i * spread - 5, f"text {i} of many") for i in range(150)] + [(None, "none"), (None, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["text"]: r["next_text"] for r in minhash.with_next(frame).collect()}
    assert found == {text: after for (_, text), (_, after) in in_order(rows)}


def test_minhash_edge_cases(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect()]
    found = minhash.with_next(edge_docs).collect()
    assert Counter((r["doc_id"], r["text"], r["next_text"]) for r in found) == Counter(
        (i, t, after) for (i, t), (_, after) in in_order(rows)
    )
    assert minhash.with_next(empty_docs).collect() == []
    one = edge_docs.where("doc_id = 0")
    assert [r["next_text"] for r in minhash.with_next(one).collect()] == [one.first()["text"]]


def test_minhash_plan_holds_no_python(spark, documents):
    plan = minhash.with_next(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_base(rows, learned):
    counts = Counter()
    for i, text in rows:
        if learned(i):
            counts.update([*text.encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    out = Counter()
    for i, text in rows:
        tokens = [*text.encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out[i, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)] += 1
    return out


def test_lm_query_equals_brute_base_and_beats_it(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = registered.op9_mixing_lm(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in found)
    expected = brute_base(rows, lambda i: zlib.crc32(str(i).encode()) % 10)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    learned = [r for r in found if not r["held_out"]]
    assert sum(r["score"] for r in learned) > sum(r["base_score"] for r in learned)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in found)
    # Held-out rows: the base gives all new words together the chance of one; with a uniform spelling of each,
    # it is a model of the same texts, and the mixing one beats it.
    seen = {w for i, text in rows if zlib.crc32(str(i).encode()) % 10 for w in text.encode().lower().split()}
    held = {i: text.encode() for i, text in rows if not zlib.crc32(str(i).encode()) % 10}
    spelled = sum((len(w) + 1) * math.log10(257) for text in held.values() for w in text.lower().split() if w not in seen)
    scores = [(r["score"], r["base_score"]) for r in found if r["held_out"]]
    assert len(scores) == len(held)
    total, base = (sum(x) for x in zip(*scores, strict=True))
    assert total > 0.8 * (base - spelled)
    assert -total * math.log2(10) / sum(map(len, held.values())) < 2.6


def test_chances_of_all_continuations_sum_to_one():
    """What the trees and the mix give to all words after a context is one in all."""
    coder = lm.Coder.over([(b"the", 9), (b"cat", 4), (b"on", 2)], 3, 30)
    random = np.random.default_rng(1)
    model = lm.Model(
        coder,
        random.integers(-4000, 4000, (lm.TABLES, lm.SLOTS)).astype(np.int16),
        lm.mixing_weights(random.normal(0, 0.5, (lm.GATES, lm.TABLES + 1))),
        lm.costs(random.uniform(0.1, 0.9, (lm.GATES, lm.MAP_CELLS))),
        30,
        5,
    )
    width = lm.MARKERS + 1
    keys = np.array([(s * width + 1) * width + 2 for s in range(5)])
    seen = lm.key_bits(keys, coder)
    chances = 2.0 ** np.bincount(seen.item, lm.log2_chances(model, seen))
    assert chances.sum() == pytest.approx(1, abs=1e-4)
    ends = [w for w in (bytes([b]) for b in range(256))]
    first = []
    for word in ends:
        seen = lm.spelled_bits([word], coder)
        bits = int(coder.byte_tree.size[word[0]])
        first.append(2.0 ** lm.log2_chances(model, seen)[:bits].sum())
    stop = coder.byte_tree
    seen = lm.spelled_bits([b""], coder)
    first.append(2.0 ** lm.log2_chances(model, seen)[: int(stop.size[lm.WORD_END])].sum())
    assert sum(first) == pytest.approx(1, abs=1e-3)


def test_scores_do_not_depend_on_the_lot():
    coder = lm.Coder.over([(b"a", 9), (b"b", 4)], 3, 30)
    model = lm.Model(
        coder,
        np.random.default_rng(2).integers(-4000, 4000, (lm.TABLES, lm.SLOTS)).astype(np.int16),
        lm.mixing_weights(np.full((lm.GATES, lm.TABLES + 1), 0.5)),
        lm.costs(np.full((lm.GATES, lm.MAP_CELLS), 0.5)),
        30,
        5,
    )

    def scores(texts):
        items = lm.itemized([lm.lowered_words(t) for t in texts], coder)
        keys, spelled = lm.item_scores(model, items)
        total = np.bincount(items.text, keys[items.key_at], len(texts))
        return total + np.bincount(items.text[items.symbols == lm.ESCAPE], spelled[items.spelled_at], len(texts))

    texts = [b"a b xyz a", b"", b"xyz", b"b b q b a xyz"]
    assert np.allclose(scores(texts), [scores([t])[0] for t in texts])


def test_lm_edge_cases(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect()]
    found = lm.scored(edge_docs, F.col("doc_id") >= 0, dictionary=8).collect()
    expected = brute_base(rows, lambda i: i is not None and i >= 0)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    assert all((r["bits_per_byte"] is None) == (r["n_tokens"] == 1 and not dict(rows)[r["doc_id"]]) for r in found)
    assert lm.scored(empty_docs, F.lit(True)).collect() == []
    untrained = lm.scored(edge_docs, F.lit(False)).collect()
    assert len(untrained) == len(rows) and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in untrained)


def test_words_out_of_context_keep_their_whole_counts():
    """The odds of table 0 at the nodes of a path are those of the counts, however large these are."""
    frequent = [(b"the", 3 * 10**10), (b"of", 10**7), (b"cat", 70_000), (b"mat", 9)]
    coder = lm.Coder.over(frequent, 10**6, 3 * 10**10 + 10**7 + 70_009 + 10**6 + 200_000)
    tables = np.zeros((lm.TABLES, 2 * lm.SLOTS), np.int64)
    lm._count_dictionary(tables, coder, 200_000)
    spelled = np.zeros_like(tables)
    lm._count_dictionary(spelled, lm.Coder(coder.words, np.zeros_like(coder.counts), coder.word_tree, coder.byte_tree), 0)
    counts = [10**6, 200_000, *[n for _, n in frequent]]
    zeros_ones = {}
    for symbol, n in enumerate(counts):
        at, _ = coder.word_tree.expand(np.array([symbol]))
        for slot, bit in zip(coder.word_tree.alone[at].tolist(), coder.word_tree.bits[at].tolist(), strict=True):
            zeros_ones[2 * slot + bit] = zeros_ones.get(2 * slot + bit, 0) + n
    assert {i: int((tables - spelled)[0, i]) for i in zeros_ones} == zeros_ones
    block = np.full(2 * lm.BLOCK, 10**12, np.int64)
    assert lm._fold_counts(iter([{"block": 0, "payload": lm._packed(block)}]))[0, 0] == 10**12


def test_only_texts_that_are_there_once_are_left_out_of_the_counts(spark, documents, monkeypatch):
    """A text much repeated under one id, or none, is counted whole though its text falls in the draw."""
    hot = "again and again the same words are said and written down"
    rows = [(None, hot)] * 60 + [(7, hot + " twice")] * 40 + [(r["doc_id"], r["text"]) for r in documents.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen, tuned = [], lm._tuned
    monkeypatch.setattr(lm, "_tuned", lambda tables, coder, texts: seen.extend(texts) or tuned(tables, coder, texts))
    found = lm.scored(frame, F.lit(True)).collect()
    assert seen and len(set(seen)) == len(seen) and not any(t.startswith(b"again") for t in seen)
    assert len(found) == len(rows)
    by_text = {r["bits_per_byte"] for r in found if r["doc_id"] is None}
    assert len(by_text) == 1 and by_text.pop() < np.median([r["bits_per_byte"] for r in found if (r["doc_id"] or 0) > 7])


def test_mixing_is_learned_from_every_training_text(spark, documents, monkeypatch):
    """Every copy of every training text adds all its bits to the cells that mixing is fitted to, and to the tables."""
    texts = [r["text"] or "" for r in documents.collect()] + ["the same words once more"] * 300 + ["", " "]
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found, fitted, compiled, tuned = {}, lm._fitted, lm._compiled, lm._tuned
    monkeypatch.setattr(lm, "_tuned", lambda tables, coder, texts: found.update(coder=coder) or tuned(tables, coder, texts))
    monkeypatch.setattr(lm, "_fitted", lambda cells, *begin: found.update(cells=cells.copy()) or fitted(cells, *begin))
    monkeypatch.setattr(lm, "_compiled", lambda tables: found.update(tables=tables.copy()) or compiled(tables))
    lm.scored(frame, F.col("doc_id") % 5 > 0)
    items = lm.itemized([lm.lowered_words(t.encode()) for i, t in rows if i % 5], found["coder"])
    bits, spelled = 0, np.zeros_like(found["tables"])
    for seen, part in lm._bit_lots(items, found["coder"]):
        bits += int((items.spelled_times if seen.kind else items.key_times)[part][seen.item].sum())
    lm._count_spellings(spelled, found["coder"])
    assert found["cells"].sum() == bits
    assert (found["tables"] - spelled)[1].sum() == (found["tables"] - spelled)[2].sum() == bits


def test_words_in_one_buffer_are_those_of_each_text():
    texts = [b"", b" \t\n\r\x0b\x0c", b"  The CAT\x1csat ", "\u00c9T\u00c9\u00a0x \u0130".encode(), b"\xff\xfeA \xc3", b"a\x00B", b"a" * 70_000]
    column = pa.array([b"cut off", *texts], pa.binary()).slice(1)
    words, sizes = lm.tokenized(column)
    ends = np.cumsum(sizes).tolist()
    found = [words[end - n : end].to_pylist() for end, n in zip(ends, sizes.tolist(), strict=True)]
    assert found == [lm.lowered_words(t) for t in texts]
    none, sizes = lm.tokenized(column.slice(0, 0))
    assert len(none) == len(sizes) == 0


def test_states_are_the_levels_and_experience_of_counts():
    counts = np.random.default_rng(4).choice(np.array([0, 1, 2, 3, 11, 12, 31, 32, 33, 1000, 2**31, 2**32 - 1], np.uint32), 20_000)
    zeros, ones = counts[0::2].astype(np.float32), counts[1::2].astype(np.float32)
    states = lm.states_of(counts)
    assert (states & 31 == lm._levels(lm._odds(zeros, ones))).all()
    assert (states >> 5 == lm._experience(zeros + ones)).all()


def test_a_lot_of_text_is_scored_in_little_memory():
    """An executor's two workers share what its heap leaves, and words as Python's objects take ten times their bytes."""
    random = np.random.default_rng(5)
    known = sorted({random.bytes(4).hex().encode() for _ in range(50_000)})
    coder = lm.Coder.over([(w, 2) for w in known], 9, 10**6)
    odds, weights = np.zeros((lm.TABLES, lm.SLOTS), np.int16), np.full((lm.GATES, lm.TABLES + 1), 0.3)
    model = lm.Model(coder, odds, lm.mixing_weights(weights), lm.costs(np.full((lm.GATES, lm.MAP_CELLS), 0.5)), 10**6, len(known))
    picked = [b" ".join(known[i] for i in random.zipf(1.3, 2000) % len(known)) for _ in range(220)]
    batch = pa.RecordBatch.from_arrays([pa.array(picked, pa.binary())], names=["text"])
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        (found,) = lm._scorer(SimpleNamespace(value=model))(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - held
    finally:
        tracemalloc.stop()
    assert found.column("n_tokens").to_pylist() == [2001] * len(picked)
    assert peak < 56e6, peak


def test_fitted_mixing_takes_all_bits_and_keeps_what_none_chose():
    """One gate's bits are foretold by its first table alone; the weights find that, whatever they begin with."""
    levels, random = len(lm.LEVELS), np.random.default_rng(3)
    cells = np.zeros(lm.CELL_BLOCKS * 2 * lm.BLOCK, np.int64)
    own = cells[: lm.CELLS].reshape(lm.GATES, levels, levels, levels, 2)
    for a in range(levels):
        own[5, a, :, :, 1] = 10_000 / (1 + np.exp(-lm.LEVELS[a]))
        own[5, a, :, :, 0] = 10_000 - own[5, a, :, :, 1]
    begin, corrections = random.normal(size=(lm.GATES, lm.TABLES + 1)), np.full((lm.GATES, lm.MAP_CELLS), 0.5)
    weights, shares = lm._fitted(cells, begin, corrections)
    assert np.allclose(weights[5], [1, 0, 0, 0], atol=0.02) and np.allclose(shares[5][[9, 16, 23]], [0.029, 0.5, 0.971], atol=0.01)
    others = np.arange(lm.GATES) != 5
    assert (weights[others] == begin[others]).all() and (shares[others] == 0.5).all()


def test_neighbours_of_sparse_ids_come_in_few_buckets(spark):
    """Ids like hashes: each bucket has some dozens of rows, so the list of buckets is far shorter than the table."""
    rows = [(int.from_bytes(hashlib.sha256(str(i).encode()).digest()[:8], "big", signed=True), f"text {i}") for i in range(3000)]
    rows += [(None, "no id"), (2**63 - 1, "last"), (-(2**63), "first")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.with_next(frame).select("doc_id", "text", "next_text").collect()
    assert Counter(map(tuple, found)) == Counter((i, t, after) for (i, t), (_, after) in in_order(rows))
    width = minhash._bucket_width(frame)
    buckets = {math.floor(i / width) for i, _ in rows if i is not None}
    assert 3000 / minhash.IDS_A_BUCKET / 2 < len(buckets) < 3000 / 20
