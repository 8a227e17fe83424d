"""Pairs of texts whose sets of word shingles are similar, exactly and without lists of
words on the wire.

Shingles are 64-bit hashes. Two sets whose Jaccard similarity reaches a threshold share
the first of their common shingles, in any one order of all shingles, within a prefix of
each that is only as long as the set may differ. The order is by document frequency,
rare ones first, so most texts have nothing but shingles of their own there and meet no
other. Frequencies need every shingle of every text in one shuffle: they travel packed,
sorted and as differences, some 8 bytes each; only shingles of two texts or more come
back. Texts with equal sets are one class, and sets are compared once for two classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

#: Ranges of hashes that are counted one by one, as a power of two.
PART_BITS = 12
#: Texts that are looked up by a broadcast of their ids; more are joined by a shuffle.
BROADCAST = 200_000


def hashes(text: bytes, n: int) -> np.ndarray:
    """Distinct hashes of the word n-grams, in order; of the whole text if it is shorter."""
    digest, cuts = xxhash.xxh64_digest, np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
    if len(cuts) < n:
        return np.frombuffer(digest(text), np.uint64)
    starts, ends = [0, *[c + 1 for c in cuts]], [*cuts, len(text)]
    return np.unique(np.frombuffer(b"".join([digest(text[s:e]) for s, e in zip(starts, ends[n - 1 :], strict=False)]), np.uint64))


def planes(values: np.ndarray) -> bytes:
    """Bytes of the numbers, all first ones before all second ones: what is zero stays together."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def joined(words: Column) -> Column:
    return F.array_join(words, " ").cast("binary")


def packed(items: DataFrame, n: int) -> DataFrame:
    """``part, base, ids, keys`` of (item_id, text): the shingles of a batch by ranges of
    their hashes; rows without keys hold sizes and classes of the batch's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = [hashes(t.as_py(), n) for t in batch.column(1)]
            ids, sizes = batch.column(0).to_numpy(), np.array([len(s) for s in sets])
            classes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
            base = int(ids.min())
            near = (ids - base).astype(np.uint64)
            near = near.astype(np.uint32) if int(near.max()) < 1 << 32 else near
            keys = np.concatenate(sets)
            order = np.argsort(keys, kind="stable")
            keys, who = keys[order], np.repeat(near, sizes)[order]
            cuts = np.searchsorted(keys >> np.uint64(64 - PART_BITS), np.arange((1 << PART_BITS) + 1))
            filled = np.flatnonzero(np.diff(cuts))
            rows = [(int(p), base, planes(who[s:e]), planes(np.diff(keys[s:e], prepend=np.uint64(0))), None, None) for p, s, e in zip(filled.tolist(), cuts[filled].tolist(), cuts[filled + 1].tolist(), strict=True)]
            rows.append((int(classes[0] >> np.uint64(64 - PART_BITS)), base, planes(near), None, planes(sizes.astype(np.uint32)), planes(classes)))
            for at in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 512], strict=True), PACKED_TYPES, strict=True)], names=PACKED_NAMES)

    return items.mapInArrow(run, "part int, base long, ids binary, keys binary, sizes binary, classes binary")


PACKED_NAMES = ["part", "base", "ids", "keys", "sizes", "classes"]
PACKED_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def counted(rows: DataFrame) -> DataFrame:
    """``item_id, key, df, size, cls``: each item once with the size and class of its set,
    and its shingles that another item has."""
    names = ["item_id", "key", "df", "size", "cls"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def out(*columns: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        n = len(columns[0])
        for at in range(0, n, 50_000):
            yield pa.RecordBatch.from_arrays([pa.nulls(min(50_000, n - at), t) if c is None else pa.array(c[at : at + 50_000], t) for c, t in zip(columns, types, strict=True)], names=names)

    def shared(ids: list[np.ndarray], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if keys:
            who, own = np.concatenate(ids), np.concatenate(keys)
            order = np.argsort(own, kind="stable")
            who, own = who[order], own[order]
            starts = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]))
            df = np.repeat(np.diff(starts), np.diff(starts))
            more = df > 1
            yield from out(who[more], own[more].view(np.int64), df[more].astype(np.int32), None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, keys = None, [], []
        for batch in batches:
            for p, base, near, own, sizes, classes in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if p != part:
                    yield from shared(ids, keys)
                    part, ids, keys = p, [], []
                count = len(own or classes) // 8
                who = from_planes(near, np.uint32 if len(near) == 4 * count else np.uint64).astype(np.int64) + base
                if own is None:
                    yield from out(who, None, None, from_planes(sizes, np.uint32).astype(np.int32), from_planes(classes, np.uint64).view(np.int64))
                else:
                    ids.append(who)
                    keys.append(np.cumsum(from_planes(own, np.uint64), dtype=np.uint64))
        yield from shared(ids, keys)

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, "item_id long, key long, df int, size int, cls long")


def prefixes(items: DataFrame, threshold: float, n: int, scratch: Scratch, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``item_id, key, size, cls`` of the shingles in the prefixes of the items (item_id,
    text), those in more than ``most`` items left out, and ``item_id, size, cls, heavy`` of
    every item: heavy if so many of its shingles are in more than ``most`` items that it
    may be similar to another through these alone."""
    of = Window.partitionBy("item_id")
    rows = counted(packed(items, n)).select(
        "item_id", "key", "df", F.max("size").over(of).alias("size"), F.max("cls").over(of).alias("cls"), F.count("key").over(of).alias("common"),
        F.count_if(F.col("df") > (most or 1 << 30)).over(of).alias("often"), (F.row_number().over(of.orderBy("df", "key")) - 1).alias("at"),  # the item's own row is first
    )
    need = F.ceil(F.col("size") * F.lit(threshold) - 1e-9)
    first = F.col("size") - F.col("common") + F.col("at") <= F.col("size") - need + 1
    kept = rows.where(F.col("key").isNull() | (first & (F.col("df") <= (most or 1 << 30))))
    kept = scratch.write(kept.select("item_id", "key", "size", "cls", (F.col("often") >= need).alias("heavy")), "prefixes")
    return kept.where("key is not null").drop("heavy"), kept.where("key is null").drop("key")


def sized(x: str, y: str, threshold: float) -> Column:
    """Whether two sets may be similar by their sizes."""
    return F.least(x, y) >= F.greatest(x, y) * F.lit(threshold) - 1e-9


def sets(classes: DataFrame, heads: DataFrame, items: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """``cls, sh``: the set of hashes of each of the classes (cls, distinct), of one item of it."""
    ids = scratch.write(heads.groupBy("cls").agg(F.min("item_id").alias("item_id")).join(classes, "cls", "left_semi").select("cls", F.col("item_id").alias("rep")), "representatives")
    hint = F.broadcast(ids) if ids.count() <= BROADCAST else ids.hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([hashes(t.as_py(), n).view(np.int64) for t in batch.column(1)], pa.list_(pa.int64()))], names=["cls", "sh"])

    met = items.join(hint, F.col("item_id") == F.col("rep")).select("cls", "text")
    return scratch.write(met.mapInArrow(run, "cls long, sh array<long>"), "sets")


def scored(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``ca, cb, similarity`` of the pairs of classes that reach the threshold."""
    left, right = sets.select(F.col("cls").alias("ca"), F.col("sh").alias("sa")), sets.select(F.col("cls").alias("cb"), F.col("sh").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    met = pairs.join(left, "ca").join(right, "cb").select("ca", "cb", both.alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
    return met.select("ca", "cb", (F.col("both") / (F.col("sum") - F.col("both"))).alias("similarity")).where(F.col("similarity") >= threshold)


def compared(pairs: DataFrame, heads: DataFrame, items: DataFrame, threshold: float, n: int, scratch: Scratch) -> DataFrame:
    """``ca, cb, similarity`` of the pairs of classes (ca < cb) that reach the threshold."""
    pairs = scratch.write(pairs, "class-pairs")
    used = pairs.select(F.explode(F.array("ca", "cb")).alias("cls")).distinct()
    return scored(pairs, sets(used, heads, items, n, scratch), threshold)
