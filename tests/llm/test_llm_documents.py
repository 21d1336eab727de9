"""Operators on documents against brute force, and on edge cases."""

import unicodedata
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from random import Random

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from rowgate.llm import langid, mixing, packing, quality, simhash
from rowgate.llm import queries as registered
from rowgate.llm.common import fold, sums_before

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def remainder(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def brute_fingerprint(text, words):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows, distance, brute_roots):
    """``rows`` of (id, fingerprint): the smallest id linked to each fingerprint."""
    fps = sorted({f for _, f in rows})
    links = [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= distance]
    root = brute_roots(links, fps)
    lowest = {}
    for i, f in rows:
        if i is not None:
            lowest[root[f]] = min(i, lowest.get(root[f], i))
    return {f: lowest.get(root[f]) for f in fps}


def test_folds_count_nulls_as_empty(spark):
    rows = spark.createDataFrame([(None,), (0,), (-5,), (10**15,)], "doc_id long").select("doc_id", fold(F.col("doc_id"), 7).alias("f"))
    assert all(r["f"] == remainder(r["doc_id"], 7) for r in rows.collect())


def test_sums_before_in_two_levels(spark):
    random = Random(1)
    rows = [(g, o, random.randint(1, 9)) for g in ("x", None) for o in random.sample(range(5000), 60)]
    found = sums_before(spark.createDataFrame(rows, "g string, o long, n long"), ["g"], "o", "n", "before", width=64)
    assert {(r["g"], r["o"]): r["before"] for r in found.collect()} == {
        (g, o): sum(n for g2, o2, n in rows if g2 == g and o2 < o) for g, o, _ in rows
    }


def test_simhash_query_equals_brute_force(spark, documents, brute_roots):
    found = registered.op7_simhash_near_duplicates(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    prints = {i: brute_fingerprint(t, 4) for i, t in texts.items()}
    low = brute_components([*prints.items()], 4, brute_roots)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found} == {
        (i, f"{f:016x}", low[f]) for i, f in prints.items()
    }


@pytest.mark.parametrize(("rows", "distance"), [(1, 4), (10**4, 4), (10**7, 4), (10**10, 4), (10**6, 2), (50, 0)])
def test_close_fingerprints_share_a_key(rows, distance):
    masks = simhash.key_masks(rows, distance)
    random = Random(rows)
    for _ in range(2000):
        flips = sum(1 << b for b in random.sample(range(64), distance))
        assert any(flips & mask == 0 for mask in masks)


@pytest.mark.parametrize("cell", [3, 4096])
def test_links_of_a_dense_group_in_small_cells(spark, cell, brute_roots):
    random = Random(2)
    centre = random.getrandbits(64)
    values = {centre ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for _ in range(60)}
    values |= {random.getrandbits(64) for _ in range(60)}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.linked_fingerprints(frame, 4, cell).collect()]
    true = [(signed[a], signed[b]) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 4]
    assert brute_roots(links, signed.values()) == brute_roots(true, signed.values())
    assert {tuple(sorted(x)) for x in links} <= {tuple(sorted(x)) for x in true}


def test_simhash_edge_cases(spark, edge_docs, empty_docs, brute_roots):
    rows = edge_docs.collect()
    prints = [(r["doc_id"], brute_fingerprint(r["text"], 4)) for r in rows]
    low = brute_components(prints, 4, brute_roots)
    found = simhash.near_duplicates(edge_docs, 4, 4).collect()
    assert Counter((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in found) == Counter(
        (i, f, low[f]) for i, f in prints
    )
    kept = simhash.deduplicated(edge_docs, 4, 4)
    assert kept.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({low[f]: 1 for _, f in prints})
    assert simhash.near_duplicates(empty_docs, 4, 4).count() == 0
    assert simhash.deduplicated(empty_docs, 4, 4).collect() == []


def brute_schedule(units, blocks):
    """Earliest deadline first, slot by slot, over exact fractions, lanes leaving when they run out."""
    taken = dict.fromkeys((x for x, n in blocks.items() if n), 0)
    order = []
    while taken:
        begin, slot = dict(taken), 0
        total = sum(units[x] for x in taken)
        while all(taken[x] < blocks[x] for x in taken):
            ready = []
            for x in taken:
                k = taken[x] - begin[x]
                if k * total // units[x] <= slot:
                    ready.append((-(-(k + 1) * total // units[x]), x))
            due, lane = min(ready)
            assert slot < due
            order.append((lane, taken[lane]))
            taken[lane] += 1
            slot += 1
        taken = {x: n for x, n in taken.items() if n < blocks[x]}
    return order


def test_mix_equals_brute_force_and_keeps_the_shares(spark):
    random = Random(5)
    sources = random.choices(["a", "b", "c", None, "z"], [50, 20, 5, 10, 15], k=900)
    docs = spark.createDataFrame([(i, f"t{i}", None, s, 2) for i, s in enumerate(sources)], "doc_id long, text string, lang string, source string, n_chars long")
    weights, rest = {"a": 3, "b": 4, "c": 1}, 2
    found = sorted(mixing.mixed(docs, weights, rest, block_rows=4).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(900))
    assert sorted(r["__row"]["doc_id"] for r in found) == list(range(900))
    lanes = {"a": 0, "b": 1, "c": 2}
    assert all(r["lane"] == lanes.get(r["__row"]["source"], -1) for r in found)
    counts = Counter(r["lane"] for r in found)
    units = {0: 3, 1: 4, 2: 1, -1: 2}
    order = brute_schedule(units, {x: -(-n // 4) for x, n in counts.items()})
    assert list(dict.fromkeys((r["lane"], r["block"]) for r in found)) == order
    first_end = min(i for i, (x, b) in enumerate(order) if b == -(-counts[x] // 4) - 1)
    for t in range(first_end + 1):
        seen = Counter(x for x, _ in order[: t + 1])
        assert all(abs(seen[x] - (t + 1) * u / 10) < 1 for x, u in units.items())


def test_rows_without_an_id_are_dealt_to_many_runs(spark):
    """Half of the rows have no id and others share one: they are numbered in many runs, and none is lost."""
    ids = [None] * 3000 + [7] * 1500 + list(range(1500))
    docs = spark.createDataFrame([(i, f"t{n}", "en", f"src{n % 3}") for n, i in enumerate(ids)], "doc_id long, text string, lang string, source string")
    placed = mixing.mixed(docs, {"src0": 2}, 1)
    assert sorted(r["position"] for r in placed.select("position").collect()) == list(range(6000))
    assert Counter(r["__row"]["text"] for r in placed.collect()) == Counter(f"t{n}" for n in range(6000))
    draw, tie = F.xxhash64(F.lit("mix"), "doc_id"), F.xxhash64("doc_id", "text", "lang", "source")
    sizes = docs.groupBy(F.pmod(F.xxhash64(draw, tie), F.lit(6000 // mixing.RUN))).count().collect()
    assert max(r["count"] for r in sizes) < 3 * mixing.RUN


def test_mix_edge_cases(edge_docs, empty_docs):
    placed = mixing.mixed(edge_docs, {"src0": 2, "src1": 1}, 1, 2)
    ordered = mixing.in_order(placed)
    assert ordered.columns == edge_docs.columns
    assert Counter(ordered.collect()) == Counter(edge_docs.collect())
    assert mixing.in_order(mixing.mixed(empty_docs, {"src0": 2})).collect() == []
    only = mixing.mixed(edge_docs.where("source = 'src0'"), {"src0": 2, "gone": 5}, 1, 3)
    assert sorted(r["position"] for r in only.collect()) == list(range(only.count()))
    with pytest.raises(ValueError):
        mixing.mixed(edge_docs, {"src0": 0})


def check_packing(pieces, rows, capacity=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            expected[r["doc_id"], n, at, len(part) // 4, part] += 1
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], bytes(p["ids"])) for p in pieces) == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(p["length"] for p in pieces)


def test_packing_round_trip(documents):
    bins, tokens = check_packing(packing.packed(documents, TOKENIZER).collect(), documents.collect())
    assert bins <= tokens / 2048 * 1.02 + 1


def test_packing_edge_cases(edge_docs, empty_docs):
    check_packing(packing.packed(edge_docs, TOKENIZER, 64).collect(), edge_docs.collect(), 64)
    assert packing.packed(empty_docs, TOKENIZER).collect() == []


def test_encoder_forgets_words_and_stays_right():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    small = packing.Encoder(TOKENIZER, words_held=20)
    random = Random(3)
    letters = "abcZÉßÿÄ's're'll012.,!#<|> \n\t́éİΣσς中한\x1c\x85 ﬁ½ªº"
    for _ in range(1500):
        text = "".join(random.choices(letters, k=random.randint(0, 25))) + random.choice(["", "<|endoftext|>", " <|startoftext|>x"])
        ids = np.frombuffer(small.encode([text.encode()])[0], "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_fullest_combination_by_brute_force():
    random = Random(4)
    for _ in range(200):
        counts = Counter(random.choices(range(1, 12), k=6))
        room = random.randint(1, 30)
        flat = list(counts.elements())
        best = max(sum(c) for n in range(len(flat) + 1) for c in combinations(flat, n) if sum(c) <= room)
        found = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert sum(n * k for n, k in found.items()) == best
        assert all(k <= counts[n] for n, k in found.items())


def test_fillings_use_every_piece_once():
    random = Random(6)
    counts = Counter(random.choices(range(1, 101), k=3000))
    found = packing.minimum_slack(dict(counts), 100)
    used = Counter()
    for pattern in found:
        assert sum(n * k for n, k in pattern.pieces.items()) <= 100
        for n, k in pattern.pieces.items():
            used[n] += k * pattern.times
    assert used == counts
    assert sum(p.times for p in found) <= 1.01 * sum(counts.elements()) / 100


def test_language_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    given = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = registered.op10_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(given)
    assert all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == given[r["doc_id"]] for r in held) >= 0.98 * len(held)


def brute_language(rows, texts):
    """Naive Bayes over the same hashed grams, one gram at a time."""

    def grams(text):
        codes = [0, 0, *map(ord, text.lower())]
        for i in range(2, len(codes)):
            one = codes[i] * 0x9E3779B1 % 2**32
            two = one ^ ((codes[i - 1] + 1) * 0x85EBCA77 % 2**32)
            three = two ^ ((codes[i - 2] + 7) * 0xC2B2AE3D % 2**32)
            for h, m in ((one ^ one >> 15, 0x9E3779B1), (two, 0x85EBCA77), (three, 0xC2B2AE3D)):
                yield (h * m % 2**32) >> 17

    counts, docs = defaultdict(Counter), Counter()
    for text, lang in rows:
        counts[lang].update(grams(text))
        docs[lang] += 1
    out = []
    for text in texts:
        logs = {}
        for lang in sorted(docs):
            total = sum(counts[lang].values()) + 0.5 * 2**15
            logs[lang] = np.log(docs[lang] / sum(docs.values())) + sum(np.log((counts[lang][g] + 0.5) / total) for g in grams(text))
        out.append(max(sorted(logs), key=logs.get))
    return out


def test_language_edge_cases(edge_docs, empty_docs):
    rows = [r for r in edge_docs.collect() if r["text"] is not None]
    model = langid.train(edge_docs, F.lit(True))
    assert model.languages == ["de", "en", "xx"]
    texts = ["the cat", "die katze und der hund", "straße 'S", "the\x00dog " * 40]
    assert model.predict(texts)[0] == brute_language([(r["text"], r["lang"]) for r in rows if r["lang"]], texts)
    found = langid.predict(edge_docs.select("doc_id", "text"), model).collect()
    undetermined = Counter(r["doc_id"] for r in found if r["lang_pred"] == "und")
    assert undetermined == Counter([1, 2, 3, 4]) and len(found) == len(edge_docs.collect())
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    kept = langid.identified(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in found if r["lang_pred"] != "und")
    nothing = langid.train(empty_docs, F.lit(True))
    assert nothing.languages == []
    assert {r["lang_pred"] for r in langid.predict(edge_docs.select("doc_id", "text"), nothing).collect()} == {"und"}
    assert langid.identified(empty_docs, model).collect() == []


def test_long_texts_are_read_whole_in_pieces(edge_docs):
    model = langid.train(edge_docs, F.lit(True))
    old, texts = langid.PIECE, ["the cat sat on the mat " * 50, "x", "die katze"]
    whole = model.predict(texts)
    try:
        langid.PIECE = 7
        assert model.predict(texts)[0] == whole[0]
        assert np.allclose(model.predict(texts)[1], whole[1])
    finally:
        langid.PIECE = old


def test_quality_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = registered.op6_quality_rules(spark, sf).collect()
    assert len(found) == 1000
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


def brute_statistics(text):
    """The statistics, a character and a word at a time."""
    words, n, w = text.split(), max(1, len(text)), max(1, len(text.split()))
    lines = text.split("\n")

    def symbol(c):
        return not (c.isspace() or c in ".,;:!?'\"()-" or unicodedata.category(c)[0] in "LMN" and ord(c) < 0xFFFF)

    return {
        "length": np.log1p(len(text)),
        "words": np.log1p(len(words)),
        "word_length": len(text) / w if words else 0,
        "distinct_words": len(set(words)) / w if words else 1,
        "distinct_lines": len(set(lines)) / len(lines),
        "repeats": sum(a == b for a, b in zip(words, words[1:], strict=False)) / w,
        "short_words": sum(len(x) <= 3 for x in words) / w,
        "long_words": sum(len(x) >= 12 for x in words) / w,
        "symbol_ends": sum(symbol(x[-1]) for x in words) / w,
        "exclaim_ends": sum(x[-1] in "!?" for x in words) / w,
        "capital_words": sum(len(x) > 1 and all(unicodedata.category(c) == "Lu" for c in x[:2]) for x in words) / w,
        "bars": text.count("|") / w,
        "capitals": sum(unicodedata.category(c) == "Lu" for c in text) / n,
        "digits": sum(unicodedata.category(c) == "Nd" for c in text) / n,
        "symbols": sum(map(symbol, text)) / n,
        "exclaims": sum(c in "!?" for c in text) / n,
        "stops": sum(c in ".,;:" for c in text) / n,
        "spaces": sum(c.isspace() for c in text) / n,
        "breaks": text.count("\n") / n,
    }


@pytest.mark.parametrize("lot", [1 << 18, 9])
def test_statistics_by_brute_force(spark, monkeypatch, lot):
    monkeypatch.setattr(quality, "LOT", lot)
    random = Random(8)
    texts = ["A a a b | c|\nA a a b | c|\n12 %% !! x$$", "", "one", "  lead  twice twice\ntail ", "\n", " "]
    texts += ["".join(random.choices("abAB É ß 12.,!?|#\u00a0\n\t\U0001f600ٱ", k=random.randint(0, 40))) for _ in range(200)]
    for text, row in zip(texts, quality.measure(texts), strict=True):
        assert dict(zip(quality.NAMES, row, strict=True)) == pytest.approx(brute_statistics(text)), text
    frame = spark.createDataFrame([(0, texts[0]), (1, None)], "doc_id long, __text string")
    found = {r["doc_id"]: r["__stats"].asDict() for r in quality.with_statistics(frame, "__text").collect()}
    assert found[0] == pytest.approx(brute_statistics(texts[0])) and found[1] == pytest.approx(brute_statistics(""))


def test_rules_score_like_their_conditions(spark):
    described = "Tree\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    low, high = ("digits", "<=", 0.5), ("digits", ">", 0.5)
    assert quality.tree_rules(described, ["digits", "words"]) == [
        (low,), (low, ("words", "<=", 2.0)), (low, ("words", ">", 2.0)), (high,),
    ]
    model = quality.RuleModel(0.25, (((low, ("words", ">", 1.0)), 1.5), ((high,), -2.0)))
    frame = spark.createDataFrame([(0, "one two three"), (1, "1 2 3"), (2, "12345"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in quality.scored(frame, model).collect()}
    assert [found[i] for i in range(4)] == pytest.approx([1 / (1 + np.exp(-x)) for x in (1.75, -1.75, -1.75, 0.25)])


def test_quality_edge_cases(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(0, 1), (0, 1), (5, 1), (6, None), (4, 0), (None, 0), (99, 0)], "doc_id long, quality int")
    model = quality.train(edge_docs, labels, F.lit(True), trees=2)
    scores = quality.scored(edge_docs, model).collect()
    assert len(scores) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    everything = quality.accepted(edge_docs, model, 0.0)
    assert everything.columns == edge_docs.columns
    assert Counter(everything.collect()) == Counter(edge_docs.collect())
    assert quality.accepted(empty_docs, model).collect() == []
    constant = quality.train(edge_docs, labels.where("quality = 1"), F.lit(True))
    assert constant.rules == () and quality.scored(edge_docs, constant).first()["score"] > 0.9
    unknown = quality.train(empty_docs, labels, F.lit(True))
    assert quality.scored(edge_docs, unknown).first()["score"] == pytest.approx(0.5)


def test_letters_are_letters():
    assert not any(map(langid.has_letter, ["½", "²³", "①", "", "12 _ 3", "\u0661\u2167"]))
    assert all(map(langid.has_letter, ["a½", "① é", "漢", "1ª", "\U0001d400"]))


def test_packing_in_order_is_a_round_trip(spark, edge_docs, empty_docs, documents):
    path = TOKENIZER
    for docs in (edge_docs, empty_docs, documents):
        plain = packing.pieces(docs, path, 64).select("doc_id", "piece", "start", "length", "ids").collect()
        found = packing.packed_in_order(docs, path, 64, window=3).collect()
        assert Counter(plain) == Counter(r[:5] for r in found)
        spots = Counter((r["sequence_id"], r["offset"] + i) for r in found for i in range(r["length"]))
        assert not spots or max(spots.values()) == 1 and max(s for _, s in spots) < 64


def test_near_duplicates_go_by_stay_or_by_go(spark, edge_docs, documents, monkeypatch):
    for docs in (edge_docs, documents):
        expected = Counter(simhash.deduplicated(docs, 4, 4).collect())
        groups = {r["component_id"] for r in simhash.near_duplicates(docs, 4, 4).collect()}
        assert sum(expected.values()) == len(groups)
        for most in (1, 0, len(groups) - 1):
            monkeypatch.setattr(simhash, "BROADCAST_ROWS", most)
            assert Counter(simhash.deduplicated(docs, 4, 4).collect()) == expected
