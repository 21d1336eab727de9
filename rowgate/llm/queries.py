"""One query for each operator, over its whole table, with the settings meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm import adaptive, codes, html, langid, lm, minhash, mixing, packing, quality, simhash, spelling, urlfilter, vectors
from rowgate.llm.common import fold

SHINGLE_WORDS, MOST_BITS = 4, 4
CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
GOOD = 0.7
#: Units of weight by source; all other sources share ``REST_UNITS``.
WEIGHTS = {"src0": 12, "src1": 6, "src2": 6, "src3": 4, "src4": 4, "src5": 3, "src6": 3, "src7": 2}
REST_UNITS = 10
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
URL_TERMS = urlfilter.Vocabulary(
    strict=("casino", "escort", "hentai", "jackpot", "porn", "viagra", "xxx"),
    soft={
        "ads": 1.0, "adult": 1.5, "bet": 1.0, "bets": 1.0, "bonus": 1.0, "cheap": 1.0, "farm": 1.0,
        "free": 1.0, "loan": 1.0, "pills": 1.5, "poker": 1.5, "spam": 1.5, "track": 1.0, "win": 1.0,
    },
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> quality.RuleModel:
    """The quality rules, learned from the labels of all documents outside the held-out fold."""
    return quality.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(table(spark, sf_dir, "pages"), "page_id", URL_RULES, URL_TERMS)


def url_filter_sql() -> str:
    """Host, path, rules and the vocabulary once more, for DuckDB."""
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    fits = {
        rule: f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{path}')"
        for _, rule in URL_RULES
        for name, _, path in [rule.partition("/")]
    }
    longest = sorted(URL_RULES, key=lambda r: (-len(r[1]), r[1]))
    rule = " ".join(f"WHEN {fits[r]} THEN '{r}'" for _, r in longest)
    said = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in longest)

    def found(term: str) -> str:
        return f"len(regexp_extract_all(lowered, '(^|[^a-z0-9]){term}($|[^a-z0-9])'))"

    strict = " + ".join(found(t) for t in URL_TERMS.strict)
    soft = " + ".join(f"CASE WHEN {found(t)} > 0 THEN 1 ELSE 0 END" for t in URL_TERMS.soft)
    weight = " + ".join(f"CASE WHEN {found(t)} > 0 THEN {w} ELSE 0.0 END" for t, w in URL_TERMS.soft.items())
    upper, lower = urlfilter.UPPER, urlfilter.LOWER
    return f"""
        WITH given AS (
            SELECT page_id, coalesce(url, '') AS url FROM pages
        ), cut AS (
            SELECT page_id, {rest} AS rest,
                   regexp_replace(translate(url, '{upper}', '{lower}'), '([^a-z0-9])', '\\1\\1', 'g') AS lowered
            FROM given
        ), named AS (
            SELECT page_id, lowered,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), counted AS (
            SELECT page_id, host, path, CASE {rule} END AS rule,
                   CAST({strict} AS INTEGER) AS strict_hits, CAST({soft} AS INTEGER) AS soft_hits,
                   CAST({weight} AS DOUBLE) AS soft_weight
            FROM named
        )
        SELECT page_id, host, path, rule,
               coalesce(CASE rule {said} END,
                        CASE WHEN strict_hits >= 1 OR (soft_hits >= {URL_TERMS.least_soft}
                                  AND soft_weight >= {URL_TERMS.least_weight})
                             THEN 'block' ELSE 'allow' END) AS verdict,
               strict_hits, soft_hits, soft_weight
        FROM counted
    """


def op3_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document goes in a mix of the sources."""
    placed = mixing.mixed(table(spark, sf_dir, "documents"), WEIGHTS, REST_UNITS)
    return placed.select("__row.doc_id", "__row.source", "lane", "block", "slot", "position")


def op5_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike it is to that and to the next document's."""
    paired = minhash.with_next(table(spark, sf_dir, "documents"))
    changed = paired.withColumn("edited", minhash.edited(F.col("text"), F.col("next_text")))
    known = changed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "next_fingerprint",
        "edited",
    )
    printed = minhash.with_fingerprint(known, "edited", "edited_fingerprint")
    return printed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        minhash.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        minhash.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality.scored(docs, quality_model(docs, spark, sf_dir))
    return scores.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op7_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MOST_BITS)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), CAPACITY)
    digests = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.placed(digests, CAPACITY)


def op9_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 10) == 0
    found = lm.scored(table(spark, sf_dir, "documents"), ~held_out)
    return found.withColumn("held_out", ~F.col("learned")).drop("learned")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = langid.train(docs, ~held_out)
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string")), model)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = adaptive.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *adaptive.BASE, "base_failed", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_main_text": op1_html_main_text,
        "op2_url_filter": op2_url_filter,
        "op3_embedding_near_duplicates": op3_embedding_near_duplicates,
        "op4_mix_sources": op4_mix_sources,
        "op5_minhash_fingerprints": op5_minhash_fingerprints,
        "op6_quality_rules": op6_quality_rules,
        "op7_simhash_near_duplicates": op7_simhash_near_duplicates,
        "op8_pack_sequences": op8_pack_sequences,
        "op9_mixing_lm": op9_mixing_lm,
        "op10_language_id": op10_language_id,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_vector_codes": op12_vector_codes,
        "op13_adaptive_quality": op13_adaptive_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": url_filter_sql(),
        "op11_spelling_variants": spelling.variants_sql(),
        "op12_vector_codes": codes.compressed_sql(),
        "op13_adaptive_quality": adaptive.judged_sql(),
    }
