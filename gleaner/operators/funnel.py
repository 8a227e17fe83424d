"""The relevance funnel: keywords, margins, audit, tallies, budgets, watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import phrase_match

LOW_RATING = 3


def stage_a(text: Column, rating: Column, intent: list[str], feature: list[str]) -> Column:
    """An intent phrase, or a feature phrase under a low rating."""
    return phrase_match(text, intent) | (F.coalesce(rating <= LOW_RATING, F.lit(False)) & phrase_match(text, feature))


def keep_margin(margin: Column, tau: float) -> Column:
    """Strictly above the threshold."""
    return margin > tau


def audit_ids(rejected: DataFrame, rate: float, seed: str = "audit", key: str = "item_id") -> DataFrame:
    """round(n * rate) of the rejected ids, half to even, by a seeded order: a top-k,
    so only k rows of each partition are shuffled."""
    n = rejected.count()
    k = round(n * rate)
    order = F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string")))
    # bins of the order are counted, so that no task holds more than one bin's ids
    own = rejected.select(key, order.alias("_o")).withColumn("_bin", F.substring("_o", 1, 4))
    bins = own.groupBy("_bin").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_bin").orderBy("_o", key))
    return own.join(bins.where(F.col("_before") < k), "_bin").withColumn("_place", place).where(F.col("_place") <= k).select(key)


def enforce_scope(label: Column, excluded_topic: Column, blocks: Column) -> Column:
    """An excluded topic that does not block retrieval takes the label away."""
    return F.when(excluded_topic.isNotNull() & ~F.coalesce(blocks, F.lit(False)), F.lit("not")).otherwise(label)


def tallies(items: DataFrame) -> DataFrame:
    """Per source: items, eligible, kept by stage A, kept by stage B."""
    return items.groupBy("source").agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible"), F.count_if(F.col("eligible") & F.col("a")).alias("stage_a"), F.count_if(F.col("eligible") & F.col("a") & F.col("b")).alias("stage_b"))


def since_last(events: DataFrame, time: str, by: str, overlap_days: int) -> DataFrame:
    """Rows of each source from its last time less an overlap on. The last times are
    one row per source, found by a combined aggregate."""
    last = events.groupBy(by).agg((F.max(time) - F.make_dt_interval(F.lit(overlap_days))).alias("_since"))
    return events.join(last, by).where(F.col(time) >= F.col("_since")).drop("_since")


def within_budget(calls: DataFrame, cost: str, order: list[str], budget: float, by: str) -> DataFrame:
    """The calls of each group that a running worst-case sum admits."""
    running = F.sum(cost).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return calls.withColumn("running", running).where(F.col("running") <= budget)


def fresh_only(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that is not done yet for its prompt and model."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def tidy_list(values: Column, most: int | None = None) -> Column:
    """Blanks and repeats dropped, order kept."""
    out = F.array_distinct(F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))
    return F.slice(out, 1, most) if most else out


def round_robin(items: DataFrame, by: str, size: int, seed: str = "review", key: str = "item_id") -> DataFrame:
    """``size`` rows spread over the values of ``by``: the first of each value in a
    hashed order, then the second of each. Ranks beyond size are cut before the
    shuffle (a limit on the rank within a group), so a hot value costs no more."""
    order = Window.partitionBy(by).orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), key)
    ranked = items.withColumn("_turn", F.row_number().over(order)).where(F.col("_turn") <= size)
    return ranked.orderBy("_turn", F.col(by).asc_nulls_last(), key).limit(size).drop("_turn")
