"""Importance resampling of documents by hashed n-gram generative models.

Two bags of n-grams are modelled, the target's (documents labelled good) and the
raw corpus's (all documents): word 1- and 2-grams, in which a word that repeats
its predecessor becomes a repeat mark, and 4-grams of character classes. A
document's log importance weight is the sum of its n-grams' log ratios. The
Gumbel top-k of the weights is kept: weight plus seeded Gumbel noise, the k
largest, which samples without replacement in proportion to the weights. k is
the number of documents whose weight lies above the point that parts good from
bad best in the bounded labelled sample.

Raw counts are taken over whole texts of all documents; per partition they are
summed into fixed tables before they are shuffled, and only tables of a fixed
size reach the driver. The k-th largest value is found by narrowing histograms.

Defined cases: null and empty texts have no n-grams and weight 0. Rows that tie
with the k-th are kept too. Without good labels all weights are 0, and without
bad ones k is the number of all documents, so all are kept. An empty table gives
no rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.labels import LIMIT, labelled_texts, with_label
from gleaner.scratch import Scratch

WORD_BITS = 18
WORDS, CLASSES = 1 << WORD_BITS, 8**4
#: Counts that pull a rare n-gram's ratio towards one.
PRIOR = 8.0
#: Buckets summed per partition and sent to the driver: a fixed number.
BUCKETS = WORDS + CLASSES

_SYMBOLS = b"#*$%&|<>=+~^_@/\\[]{}"
_CLASS = np.full(256, 7, np.uint16)
_CLASS[list(range(ord("a"), ord("z") + 1))] = 0
_CLASS[list(range(ord("A"), ord("Z") + 1))] = 1
_CLASS[list(range(ord("0"), ord("9") + 1))] = 2
_CLASS[list(b" \t\n\r\x0b\x0c")] = 3
_CLASS[list(b".,;:'\"()-")] = 4
_CLASS[list(_SYMBOLS)] = 5
_CLASS[list(b"!?")] = 6


def features(text: bytes | None) -> np.ndarray:
    """Buckets of all n-grams of a text, with repeats."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.int64)
    crc = zlib.crc32
    own = np.array([crc(w) for w in words], np.uint64)
    own[1:][own[1:] == own[:-1].copy()] = 1
    two = own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    shift = np.uint64(64 - WORD_BITS)
    kinds = _CLASS[np.frombuffer(text, np.uint8)]
    parts = [(own * np.uint64(0x9E3779B97F4A7C15)) >> shift, (two * np.uint64(0xD6E8FEB86659FD93)) >> shift]
    if len(kinds) > 3:
        parts.append(WORDS + ((kinds[:-3].astype(np.uint64) * 8 + kinds[1:-2]) * 8 + kinds[2:-1]) * 8 + kinds[3:])
    return np.concatenate(parts).astype(np.int64)


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of every bucket over (doc_id, text, label): raw and target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = features(text.as_py())
                counts = np.bincount(found, minlength=BUCKETS) if len(found) > BUCKETS // 8 else None
                for table in (raw, target) if label == 1 else (raw,):
                    if counts is not None:
                        table += counts
                    else:
                        np.add.at(table, found, 1)
        seen = np.flatnonzero(raw)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

    found = docs.select("text", "label").mapInArrow(run, "bucket long, raw long, target long")
    rows = found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    counts = np.zeros((2, BUCKETS), np.int64)
    at = rows.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = rows.column("raw").to_numpy(), rows.column("target").to_numpy()
    return counts


def log_ratios(counts: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log target / raw of each bucket, each bag normalised by itself."""
    out = np.zeros(BUCKETS, np.float32)
    for part in (slice(0, WORDS), slice(WORDS, BUCKETS)):
        raw, target = counts[0, part], counts[1, part]
        if target.sum():
            out[part] = np.log((target + prior) / (raw * (target.sum() / raw.sum()) + prior))
    return out


def weight(text: Column, ratios: np.ndarray) -> Column:
    """Log importance weight of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([float(ratios[features(t)].sum(dtype=np.float64)) for t in texts])

    return score(text.cast("binary"))


def gumbel(seed: int = 11) -> Column:
    """Seeded Gumbel noise of a row, from its doc_id and text."""
    uniform = (F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / F.lit(float(1 << 52))
    return -F.log(-F.log(uniform))


def dividing_point(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap above which the sample's good and below which its
    bad rows lie with the greatest sum of rates; minus infinity without both."""
    good, bad = np.sort(scores[labels == 1]), np.sort(scores[labels == 0])
    if not len(good) or not len(bad):
        return float("-inf")
    values = np.unique(scores)
    points = np.concatenate(([values[0] - 1], (values[:-1] + values[1:]) / 2))
    rates = 1 - np.searchsorted(good, points) / len(good) + np.searchsorted(bad, points) / len(bad)
    best = np.flatnonzero(rates >= rates.max() - 1e-12)
    return float(points[best[np.argmin(np.abs(points[best]))]])


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024, few: int = 512) -> float:
    """Exact k-th largest value: histograms narrow the range to a few distinct values."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).head()
    if not n or k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    value, above = F.col(column), 0
    while True:
        inside = df.where((value >= low) & (value <= high))
        distinct = inside.groupBy(column).count().limit(few + 1).toPandas()
        if len(distinct) <= few or not low < low + (high - low) / bins < high:
            ordered = inside.groupBy(column).count().orderBy(F.desc(column)).toPandas() if len(distinct) > few else distinct.sort_values(column, ascending=False)
            reached = above + ordered["count"].cumsum()
            return float(ordered[column][reached >= k].iloc[0])
        width = (high - low) / bins
        slot = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        table = inside.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).toPandas().sort_values("slot", ascending=False)
        reached = above + table["n"].cumsum()
        row = table[reached >= k].iloc[0]
        above += int(table["n"][table["slot"] > row["slot"]].sum())
        low, high = float(row["low"]), float(row["high"])


class Sampler:
    """The fitted models, the weights of all documents and the value to reach."""

    def __init__(self, docs: DataFrame, labels: DataFrame, limit: int = LIMIT, seed: int = 11, scratch: Scratch | None = None):
        scratch = scratch or Scratch(docs.sparkSession, "importance")
        self.seed = seed
        self.ratios = log_ratios(ngram_counts(with_label(docs, labels, "quality", limit)))
        labelled = labelled_texts(docs, labels, "quality", limit).select(weight(F.col("text"), self.ratios).alias("w"), "label").toPandas()
        self.point = dividing_point(labelled["w"].to_numpy(), labelled["label"].to_numpy())
        self.scored = scratch.write(self.perturbed(docs.select("doc_id", "text")).drop("text"), "scored")
        self.k = self.scored.where(F.col("log_weight") > self.point).count()
        self.reach = kth_largest(self.scored, "key", self.k)

    def perturbed(self, docs: DataFrame) -> DataFrame:
        weighed = docs.withColumn("log_weight", weight(F.col("text"), self.ratios))
        return weighed.withColumn("key", F.col("log_weight") + gumbel(self.seed))

    def kept(self, docs: DataFrame) -> DataFrame:
        """The rows of docs that the sample holds, with the columns of docs."""
        names = docs.columns
        fresh = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])  # no clash with other columns
        doc_id, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
        scored = self.perturbed(fresh.withColumnsRenamed({doc_id: "doc_id", text: "text"}))
        scored = scored.where(F.col("key") >= self.reach).withColumnsRenamed({"doc_id": doc_id, "text": text})
        return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def resample(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, seed: int = 11) -> DataFrame:
    """``doc_id, log_weight, key, kept`` of each row of docs."""
    sampler = Sampler(docs, labels, limit, seed)
    return sampler.scored.withColumn("kept", F.col("key") >= F.lit(sampler.reach))
