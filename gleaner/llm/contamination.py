"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set, each partition with an
upper bound that doubles. An item is sketched by k of its shingle hashes, those
that the fewest items have and of these the least, k being one more than the
number of shingles that an item of the partition's bound may miss at the
threshold; so a shingle that many items share is looked up for none that has
others. An item contained in a document to the threshold or
more then has at least one sketched shingle in it, so the search loses nothing,
however long the document. Documents look their shingle hashes up in the
sketches, and candidates alone are verified by exact containment of the shingle
strings. DataFrame functions only.

Sketches and item shingles are broadcast while they have BROADCAST_ROWS rows and
BROADCAST_BYTES bytes of strings at most, and joined by shuffle beyond;
candidates, pairs of hashes, by their rows alone.

Defined cases: words are runs of letters and digits, lower-cased. Null and empty
texts, and texts or items of fewer words than a shingle, match nothing. Rows that
repeat doc_id and text give one row per item, as do repeated items; a null id is
returned as null. Empty tables give no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

SHINGLE, THRESHOLD = 5, 0.8
#: Rows, and bytes of their strings, of a frame that is broadcast, at most.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20


def words(text: Column) -> Column:
    """Array of the lower-cased words of a text; empty for null."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " "))
    return F.split(spaced, " ")


def _windows(own: str, make, shingle: int) -> Column:
    count = F.size(own)
    at = F.when(count >= shingle, F.sequence(F.lit(1), count - (shingle - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, make)


def shingle_hashes(own: str, shingle: int = SHINGLE) -> Column:
    """Hash of every shingle of an array of words."""
    return _windows(own, lambda i: F.xxhash64(*[F.element_at(F.col(own), i + j) for j in range(shingle)]), shingle)


def shingle_strings(own: str, shingle: int = SHINGLE) -> Column:
    """Distinct shingles of an array of words."""
    return F.array_distinct(_windows(own, lambda i: F.array_join(F.slice(F.col(own), i, shingle), " "), shingle))


def small(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, to be broadcast if its rows and the bytes of its strings are few."""
    wide = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"), F.lit(0))
    rows, size = df.agg(F.count("*"), F.sum(wide)).head()
    return F.broadcast(df) if rows <= most and (size or 0) <= most_bytes else df


def sketches(items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """``hash, ik``: the sketch of every item (ik: hash of item_id and text)."""
    own = items.withColumn("w", words(F.col("text"))).select("ik", F.explode(F.array_distinct(shingle_hashes("w", shingle))).alias("hash"))
    common = own.groupBy("hash").agg(F.count("*").alias("df"))
    listed = own.join(common, "hash").groupBy("ik").agg(F.array_sort(F.collect_list(F.struct("df", "hash"))).alias("h"))
    bound = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("h").cast("double"))))
    k = F.floor(F.lit(1 - threshold) * bound + F.lit(1e-9)).cast("int") + 1
    return listed.select("ik", F.explode(F.slice("h", F.lit(1), k)).alias("s")).select("ik", "s.hash")


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment, rk``: items of which a
    document holds the threshold's share of shingles or more. rk is the hash of
    doc_id and text."""
    scratch = scratch or Scratch(docs.sparkSession, "contamination")
    tests = scratch.write(items.select("item_id", "text").distinct().withColumn("ik", F.xxhash64("item_id", "text")), "items")
    sketch = scratch.write(sketches(tests, threshold, shingle), "sketches")
    pieces = tests.withColumn("w", words(F.col("text"))).select("ik", "item_id", shingle_strings("w", shingle).alias("all")).withColumn("n_item", F.size("all").cast("long"))
    pieces = scratch.write(pieces.select("ik", "item_id", "n_item", F.explode("all").alias("shingle")), "item-shingles")

    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rk"))
    looked = keyed.select("rk", words(F.col("text")).alias("w")).select("rk", F.explode(shingle_hashes("w", shingle)).alias("hash"))
    candidates = scratch.write(looked.join(small(sketch), "hash").select("rk", "ik").distinct(), "candidates")

    wanted = candidates.groupBy("rk").agg(F.collect_set("ik").alias("iks"))
    read = keyed.join(F.broadcast(wanted) if candidates.count() <= BROADCAST_ROWS else wanted, "rk")
    read = read.select("doc_id", "rk", "iks", words(F.col("text")).alias("w")).select("doc_id", "rk", "iks", F.explode(shingle_strings("w", shingle)).alias("shingle"))
    shared = read.join(small(pieces), "shingle").where(F.array_contains("iks", F.col("ik")))
    counted = shared.groupBy("doc_id", "rk", "ik", "item_id", "n_item").agg(F.countDistinct("shingle").alias("n_shared"))
    found = counted.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - F.lit(1e-9))
    return found.select("doc_id", "item_id", "n_shared", "n_item", "containment", "rk")


def without_items(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents that contain no item, all columns kept."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    hit = scratch.write(contained_items(docs, items, scratch=scratch, **how).select(F.col("rk").alias("_rk")).distinct(), "hit")
    clean = docs.withColumn("_rk", F.xxhash64("doc_id", "text")).join(small(hit), "_rk", "left_anti")
    return clean.select(*docs.columns)
