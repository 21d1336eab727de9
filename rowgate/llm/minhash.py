"""One-permutation MinHash fingerprints in column expressions only.

Every word shingle is hashed once. The top bits of a hash choose its bin, and a bin keeps its
smallest hash. An empty bin takes over from the bin that comes first, among the full ones, in a
random order of its own (optimal densification). The low eight bits of each bin are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
VALUE_BITS = 63 - BIN_BITS
IDS_A_BUCKET = 64
BUCKETS_A_RUN = 4096
NO_ID_BUCKET = -(1 << 60)


def with_fingerprint(frame: DataFrame, text: str, name: str, words: int = 5) -> DataFrame:
    """``frame`` with ``name``: the packed bins of the text's ``words``-word shingles as hexadecimal digits.

    Texts are lower-cased and split at ASCII white space; fewer words are one shingle; a text without
    a word (null, empty, blank) has the empty string. Equal texts have equal fingerprints. The steps
    are projections that each use the last one's array more than once, which keeps Catalyst from
    putting one inside the other, where it would be computed again for every element.
    """
    kept = [c for c in frame.columns if c != name]
    split = F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+")
    hashed = frame.select(*kept, F.transform(F.array_remove(split, ""), lambda w: F.xxhash64(w)).alias("__words"))

    def shingle(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*[F.get("__words", i + k) for k in range(words)]), 1)

    starts = F.sequence(F.lit(0), F.greatest(F.size("__words") - words, F.lit(0)))
    none = F.array().cast("array<long>")
    ordered = hashed.select(
        *kept,
        F.when(F.size("__words") > 0, F.sort_array(F.transform(starts, shingle))).otherwise(none).alias("__hashes"),
    )
    before = F.concat(F.array(F.lit(-1).cast("long")), F.slice("__hashes", 1, F.greatest(F.size("__hashes") - 1, F.lit(0))))
    least = F.zip_with(
        F.col("__hashes"), before, lambda x, y: F.when(F.shiftright(x, VALUE_BITS) != F.shiftright(y, VALUE_BITS), x)
    )
    binned = ordered.select(*kept, F.filter(least, lambda x: x.isNotNull()).alias("__least"), F.size("__hashes").alias("__n"))
    low = (1 << LOW_BITS) - 1

    def entry(bin_: Column, value: Column) -> Column:
        return F.shiftleft(bin_.cast("long"), LOW_BITS).bitwiseOR(value.bitwiseAND(low))

    def taken_over(bin_: Column) -> Column:
        def ranked(x: Column) -> Column:
            rank = F.shiftrightunsigned(F.xxhash64(bin_, F.shiftright(x, VALUE_BITS)), LOW_BITS + 1)
            return F.shiftleft(rank, LOW_BITS).bitwiseOR(F.xxhash64(x, bin_).bitwiseAND(low))

        return entry(bin_, F.array_min(F.transform("__least", ranked)))

    full = F.transform("__least", lambda x: F.shiftright(x, VALUE_BITS).cast("int"))
    empty = F.array_except(F.sequence(F.lit(0), F.lit(BINS - 1)), full)
    own = F.transform("__least", lambda x: entry(F.shiftright(x, VALUE_BITS), x))
    entries = F.sort_array(F.concat(own, F.transform(empty, taken_over)))
    digits = F.array_join(F.transform(entries, lambda e: F.lpad(F.lower(F.hex(e.bitwiseAND(low))), 2, "0")), "")
    return binned.select(*kept, F.when(F.col("__n") > 0, digits).otherwise("").alias(name))


def likeness(left: Column, right: Column) -> Column:
    """The estimated Jaccard likeness of two fingerprints' shingle sets, 0 to 1.

    The share of equal bins, less what unequal bins agree in by chance. Two empty fingerprints are
    alike (1), an empty one is like no other (0).
    """
    chance = 1.0 / (1 << LOW_BITS)
    places = F.sequence(F.lit(0), F.lit(BINS - 1))
    equal = F.size(F.filter(places, lambda i: F.substring(left, i * 2 + 1, F.lit(2)) == F.substring(right, i * 2 + 1, F.lit(2))))
    estimate = (equal / BINS - chance) / (1 - chance)
    alike = F.least(F.greatest(estimate, F.lit(0.0)), F.lit(1.0))
    return F.when(left == right, 1.0).when((left == "") | (right == ""), 0.0).otherwise(alike)


def _next_buckets(ids: DataFrame) -> DataFrame:
    """``bucket, source``: the next lower bucket that has rows; for the lowest the highest."""
    buckets = ids.select("bucket").distinct().withColumn("run", F.floor(F.col("bucket") / BUCKETS_A_RUN))
    within = Window.partitionBy("run").orderBy(F.desc("bucket"))
    led = buckets.withColumn("lower", F.lead("bucket").over(within))
    tops = buckets.groupBy("run").agg(F.max("bucket").alias("top"))
    across = Window.orderBy(F.desc("run"))
    tops = tops.select(
        F.col("run").alias("of_run"), F.coalesce(F.lead("top").over(across), F.first("top").over(across)).alias("next_top")
    )
    joined = led.join(tops, led["run"] == tops["of_run"])
    return joined.select("bucket", F.coalesce("lower", "next_top").alias("source"))


def _bucket_width(docs: DataFrame) -> int:
    """How many numbers a bucket spans, such that evenly spread ids come some ``IDS_A_BUCKET`` to a bucket."""
    low, high, rows = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    return max(IDS_A_BUCKET, -(-(int(high) - int(low) + 1) * IDS_A_BUCKET // rows)) if rows else IDS_A_BUCKET


def with_next(docs: DataFrame, words: int = 5) -> DataFrame:
    """``doc_id, text, fingerprint, next_text, next_fingerprint``: each document with the next lower doc_id's.

    After the lowest id comes the highest; null ids come last; rows of one id go by their text. Texts
    are shuffled once, by buckets of neighbouring ids, as wide as the ids are sparse. The last row of a bucket
    gets the first one of the next bucket, of which there is one for some dozens of documents, also where ids
    are hashes over all 64 bits.
    """
    width = _bucket_width(docs)
    bucket = F.coalesce(F.floor(F.col("doc_id") / width), F.lit(NO_ID_BUCKET)).cast("long").alias("bucket")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    dealt = docs.select("doc_id", text, bucket).repartition("bucket")
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    heads = dealt.withColumn("place", F.row_number().over(order)).where("place = 1").select("bucket", "text")
    heads = with_fingerprint(heads, "text", "fingerprint", words)
    heads = heads.select(
        F.col("bucket").alias("source"), F.col("text").alias("head_text"), F.col("fingerprint").alias("head_fingerprint")
    )
    given = _next_buckets(docs.select(bucket)).join(heads, "source").select("bucket", "head_text", "head_fingerprint")
    printed = with_fingerprint(dealt, "text", "fingerprint", words)
    led = printed.select(
        "*", F.lead("text").over(order).alias("lead_text"), F.lead("fingerprint").over(order).alias("lead_fingerprint")
    )
    return led.join(given, "bucket").select(
        "doc_id",
        "text",
        "fingerprint",
        F.coalesce("lead_text", "head_text").alias("next_text"),
        F.coalesce("lead_fingerprint", "head_fingerprint").alias("next_fingerprint"),
    )


def edited(text: Column, following: Column, part: int = 3) -> Column:
    """``text`` with its last ``floor(length / part)`` characters replaced by the first as many of ``following``."""
    length = F.length(text)
    cut = F.floor(length / part).cast("int")
    return F.concat(F.substring(text, F.lit(1), length - cut), F.substring(following, F.lit(1), cut))
