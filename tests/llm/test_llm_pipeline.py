"""The pipeline: every stage against what its operator decides, and on edge cases."""

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowgate.llm import langid, packing, quality, simhash
from rowgate.llm import queries as settings
from rowgate.llm.common import fold
from rowgate.staging import Staging

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality", "simhash_near_dedup", "mix_sources", "pack_sequences",
    ]


def test_run_equals_the_operators_one_by_one(spark, documents):
    """Ids that each stage must keep, worked out from the operators' own reports, end up in the packed rows."""
    model = langid.train(documents, fold(F.col("doc_id"), 3) != 1)
    spoken = [r["doc_id"] for r in langid.predict(documents.select("doc_id", "text"), model).where("lang_pred <> 'und' AND score >= 0.5").collect()]
    docs = documents.where(F.col("doc_id").isin(spoken))
    scores = quality.scored(docs, settings.quality_model(docs, spark, SF))
    good = [r["doc_id"] for r in scores.where(F.col("score") >= settings.GOOD).collect()]
    docs = docs.where(F.col("doc_id").isin(good))
    groups = simhash.near_duplicates(docs, settings.SHINGLE_WORDS, settings.MOST_BITS).collect()
    first = sorted({r["component_id"] for r in groups})
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r["doc_id"] for r in found}) == first
    assert 0 < len(first) < documents.count()
    encoder = packing.encoder(settings.public_tokenizers.path(settings.TOKENIZER))
    lengths = {r["doc_id"]: len(encoder.encode([r["text"].encode()])[0]) // 4 + 1 for r in docs.collect() if r["doc_id"] in first}
    held = Counter()
    for r in found:
        held[r["doc_id"]] += r["length"]
    assert held == Counter(lengths)


@pytest.mark.parametrize("number", range(5))
def test_stages_on_edge_cases(spark, edge_docs, empty_docs, tmp_path, number):
    name, stage = corpus_pipeline.STAGES[number]
    shutil.copy(f"{SF}/labels.parquet", tmp_path / "labels.parquet")
    for docs in (edge_docs, empty_docs):
        rows = stage(spark, docs, str(tmp_path))
        if number < 4:
            assert rows.columns == docs.columns
            assert not Counter(rows.collect()) - Counter(docs.collect())
        else:
            pieces = rows.collect()
            assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r["doc_id"] for r in docs.collect())


def test_sequences_follow_the_mix(spark):
    """While all weighted sources last, the first sequences hold each by its weight; later ones follow in order."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    staging = Staging(spark)
    mixed = staging.keep(corpus_pipeline.mix_sources(spark, docs, folder), "mixed")
    packed = staging.keep(corpus_pipeline.pack(spark, mixed, folder), "packed")
    sources = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    pieces = packed.select("doc_id", "piece", "length", "sequence_id", "offset").collect()
    order = {s: i for i, s in enumerate(sorted({r["sequence_id"] for r in pieces}))}
    total, tokens = len(order), sum(r["length"] for r in pieces)
    assert total <= 1.01 * -(-tokens // settings.CAPACITY)
    first = Counter(sources[r["doc_id"]] for r in pieces if r["piece"] == 0 and order[r["sequence_id"]] < total // 10)
    units = sum(settings.WEIGHTS.values()) + settings.REST_UNITS
    for source, weight in settings.WEIGHTS.items():
        assert abs(first[source] / first.total() - weight / units) < 0.02
    filled = {}
    for r in pieces:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
        assert places[-1][0] + places[-1][1] <= settings.CAPACITY


def test_lean_encoder_reads_the_tokenizer_once_and_keeps_no_words():
    """A tokenizer made anew for each task took some MB more of the worker every time."""
    path = settings.public_tokenizers.path(settings.TOKENIZER)
    text = "the same words, and an odd one: 漢字".encode()
    with packing.lean_encoder(path) as first:
        ids, tokenizer = first.encode([text]), first.tokenizer
        assert first.parts or first.words
    assert not first.parts and not first.words
    with packing.lean_encoder(path) as second:
        assert second.tokenizer is tokenizer and second.encode([text]) == ids == packing.encoder(path).encode([text])
    assert packing.encoder(path).parts.most == 10 * second.parts.most > 0
