"""Aggregates of areas, ordered counters, diverse top-k."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.python_text import token_set_ratio
from gleaner.scratch import Scratch


def counts_per_item(items: DataFrame, values: str, by: str = "area_id") -> DataFrame:
    """``area, value, n``: items that name a value; repeats within an item count once."""
    own = items.select(by, F.explode(F.array_distinct(values)).alias("value"))
    return own.groupBy(by, "value").agg(F.count("*").alias("n"))


def dominant(items: DataFrame, column: str, leave_out: str, by: str = "area_id") -> DataFrame:
    """The most frequent value but one; ties go to the value seen first by item_id."""
    n = items.where(F.col(column).isNotNull() & (F.col(column) != leave_out)).groupBy(by, column).agg(F.count("*").alias("n"), F.min("item_id").alias("first"))
    return n.groupBy(by).agg(F.max_by(F.struct(column, "n"), F.struct("n", -F.col("first"))).alias("best")).select(by, f"best.{column}", "best.n")


def first_examples(items: DataFrame, kind: str, example: str, most: int = 3, by: str = "area_id") -> DataFrame:
    """Up to ``most`` distinct examples of each kind, in first-seen order."""
    seen = items.where(F.col(kind).isNotNull()).groupBy(by, kind, example).agg(F.min("item_id").alias("first"))
    place = F.row_number().over(Window.partitionBy(by, kind).orderBy("first"))
    kept = seen.withColumn("place", place).where(F.col("place") <= most)
    listed = kept.groupBy(by, kind).agg(F.array_sort(F.collect_list(F.struct("place", F.col(example).alias("x")))).alias("all"))
    return listed.select(by, kind, F.array_join(F.transform("all", lambda x: x["x"].cast("string")), ",").alias("examples"))


def diverse_top(candidates: DataFrame, k: int, by: str = "area_id") -> DataFrame:
    """The k best of each area (source, score, item_id), the best of each source
    first: ``place`` orders the chosen by score."""
    of_source = F.row_number().over(Window.partitionBy(by, "source").orderBy(F.desc("score"), "item_id"))
    headed = candidates.withColumn("later", (of_source > 1).cast("int"))
    chosen = headed.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy("later", F.desc("score"), "item_id"))).where(F.col("n") <= k)
    return chosen.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "item_id"))).drop("later", "n")


def quote_scores(items: DataFrame, by: str = "area_id") -> DataFrame:
    """items (item_id, quote, strength 1 to 5, similarity) that have a quote, with
    ``score``: half strength, half similarity scaled to the range of the area."""
    own = items.where(F.trim(F.coalesce("quote", F.lit(""))) != "").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
    range_ = own.groupBy(F.col(by).alias("_area")).agg(F.min("similarity").alias("_low"), F.max("similarity").alias("_high"))
    met = own.join(range_, F.col(by).eqNullSafe(F.col("_area")))
    close = F.when(F.col("_high") > F.col("_low"), (F.col("similarity") - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(1.0)
    return met.withColumn("score", 0.5 * (F.coalesce("strength", F.lit(1)) - 1) / 4 + 0.5 * close).drop("_area", "_low", "_high")


def representative_quotes(items: DataFrame, scratch: Scratch, k: int = 5, alike: float = 85.0, by: str = "area_id") -> DataFrame:
    """``by, item_id, source, quote, score, place``: k quotes of each area, the best
    of each source first, none that is like one chosen before it; place orders
    them by score.

    Round by round every area takes its first candidate, an aggregate with
    map-side combine, and drops those like it, so no area meets in one task.
    Sources and areas that are null are values like any other."""
    own = quote_scores(items, by).select(F.col(by).alias("area"), "item_id", "source", "quote", "score")
    rest = scratch.write(own, "candidates")
    first = rest.groupBy(F.col("area").alias("_a"), F.col("source").alias("_s")).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("item_id").alias("i"))).alias("_head"))
    met = rest.join(first, F.col("area").eqNullSafe(F.col("_a")) & F.col("source").eqNullSafe(F.col("_s")))
    rest = scratch.write(met.withColumn("later", (F.col("item_id") != F.col("_head.i")).cast("int")).drop("_a", "_s", "_head"), "headed")

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    chosen = []
    for turn in range(k):
        order = F.struct("later", (-F.col("score")).alias("s"), "item_id")
        best = rest.groupBy("area").agg(F.min_by(F.struct("item_id", "source", "quote", "score"), order).alias("pick"))
        chosen.append(scratch.write(best.select("area", "pick.*"), "picks"))
        if turn + 1 < k:
            pick = chosen[-1].select(F.col("area").alias("_a"), F.col("item_id").alias("_i"), F.col("quote").alias("_q"))
            met = rest.join(pick, F.col("area").eqNullSafe(F.col("_a"))).where(F.col("item_id") != F.col("_i"))
            after = scratch.write(met.where(ratio("quote", "_q") < alike).drop("_a", "_i", "_q"), "rest")
            scratch.drop(rest)
            rest = after
    out = reduce(DataFrame.unionByName, chosen)
    place = F.row_number().over(Window.partitionBy("area").orderBy(F.desc("score"), "item_id"))
    return out.select(F.col("area").alias(by), "item_id", "source", "quote", "score", place.alias("place"))


def pack(items: DataFrame, size: str, most_items: int, most_size: int, by: str) -> DataFrame:
    """Greedy packing in id order into batches of at most so many items and so much
    size (null: 0). The fold is sequential within a group; its rows come sorted and
    stream through by Arrow batches, so a large group takes time but no memory."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, batch, n, total = object(), 0, 0, 0
        for part in batches:
            out = []
            for group, s in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                if group != own:
                    own, batch, n, total = group, 0, 0, 0
                elif n >= most_items or total + (s or 0) > most_size:
                    batch, n, total = batch + 1, 0, 0
                n, total = n + 1, total + (s or 0)
                out.append(batch)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.int64())], names=[by, "item_id", "batch"])

    rows = items.select(by, F.col("item_id").cast("long").alias("item_id"), size).repartition(by).sortWithinPartitions(by, "item_id")
    return rows.mapInArrow(fold, f"{by} {dict(items.dtypes)[by]}, item_id long, batch long")
