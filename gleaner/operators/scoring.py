"""Scores of areas: six dimensions, composite, bands, ranks, sensitivity.

Every step is an aggregation over items or a window over areas, and nothing is
collected: areas are rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

DIMENSIONS = ("frequency", "severity", "strategic_fit", "evidence_quality", "product_leverage", "research_value")
WEIGHTS = {"frequency": 0.2, "severity": 0.2, "strategic_fit": 0.2, "evidence_quality": 0.2, "product_leverage": 0.1, "research_value": 0.1}
HIGH, MEDIUM = 3.8, 3.0
LEAST_ITEMS, LEAST_QUALITY = 10, 2.5
DAY_FRACTION = 0.1
#: Steps of the share from which 2, 3, 4 and 5 are given when there are few areas.
THRESHOLDS = (0.02, 0.05, 0.1, 0.2)
QUANTILE_AREAS = 5


def two(x: Column) -> Column:
    """Two decimals, half to even on the binary value, as scores are kept and shown."""
    return F.rint(x * 100) / 100


def clamp(x: Column) -> Column:
    """Into 1..5, with two decimals."""
    return two(F.least(F.lit(5.0), F.greatest(F.lit(1.0), x)))


def cap_by_day(items: DataFrame, fraction: float = DAY_FRACTION, by: str = "area_id") -> DataFrame:
    """At most max(1, floor(fraction * n)) items of an area per day, the first by
    item_id, n counting all of the area's items; undated ones stay. Rows get
    ``day_limit`` and ``kept``."""
    size = items.groupBy(F.col(by).alias("_by")).agg(F.greatest(F.lit(1), F.floor(F.count("*") * F.lit(fraction))).alias("day_limit"))
    sized = items.join(size, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    place = F.row_number().over(Window.partitionBy(by, "day").orderBy("item_id"))
    return sized.withColumn("kept", F.col("day").isNull() | (place <= F.col("day_limit")))


def engagement(items: DataFrame, cap: int, alpha: float) -> DataFrame:
    """``area_id, factor``: 1 + alpha * mean capped log engagement, 0..1 per item."""
    signal = F.log1p(F.least(F.col("quantity"), F.lit(cap)).cast("double")) / F.log1p(F.lit(float(cap)))
    return items.groupBy("area_id").agg((1 + F.lit(alpha) * F.avg(signal)).alias("factor"))


def source_shares(items: DataFrame) -> DataFrame:
    """``area_id, source, n, n_source, share`` for every area and corpus source,
    0 where an area has none."""
    own = items.groupBy("area_id", "source").agg(F.count("*").alias("n"))  # all that follows is of these few rows
    corpus = own.groupBy("source").agg(F.sum("n").alias("n_source"))
    grid = own.select("area_id").distinct().join(corpus)  # areas by sources: both are dimension-sized
    met = grid.join(own, ["area_id", "source"], "left").fillna(0, ["n"])
    return met.withColumn("share", F.col("n") / F.col("n_source"))


def quantile_scores(areas: DataFrame, value: str, into: str) -> DataFrame:
    """Mid-rank quantile 1..5 of a value among areas; 3 for one area."""
    all_areas, ties = Window.partitionBy(), Window.partitionBy(value)
    below = F.rank().over(Window.orderBy(value)) - 1
    n = F.count("*").over(all_areas)
    score = 1 + 4 * (below + (F.count("*").over(ties) - 1) / 2) / (n - 1)
    return areas.withColumn(into, F.when(n == 1, 3.0).otherwise(score))


def step_score(share: Column, thresholds: tuple[float, ...] = THRESHOLDS) -> Column:
    """1, and one more for every threshold that is reached."""
    return sum(((share >= t).cast("int") for t in thresholds), F.lit(1)).cast("double")


def area_sums(items: DataFrame) -> DataFrame:
    """One row of exact sums per area, from which four dimensions follow. Items are
    first summed by area, platform and category, so that what is counted distinct
    is counted over those few rows and a hot area is spread over many groups."""
    felt, sure = F.when(F.col("frustration") > 0, F.col("frustration")), F.when(F.col("strength") > 0, F.col("strength"))
    parts = {
        "felt": F.sum(felt), "n_felt": F.count(felt), "n_stakes": F.count_if("high_stakes"), "n_rated": F.count("rating"), "n_low": F.count_if(F.col("rating") <= 2),
        "relevance10": F.sum("relevance10"), "n_vague": F.count_if(F.col("retrieval_type") == "vague"), "sure": F.sum(sure), "n_sure": F.count(sure), "n_items": F.count("*"),
    }
    few = items.groupBy("area_id", "platform", "category").agg(*[c.alias(k) for k, c in parts.items()])
    return few.groupBy("area_id").agg(*[F.sum(k).alias(k) for k in parts], F.countDistinct("platform").alias("platforms"), F.countDistinct("category").alias("n_categories"))


def severity(sums: DataFrame) -> DataFrame:
    """area_sums with 0.5 intensity + 0.3 * 5 * stakes + 0.2 * 5 * low ratings; without
    ratings the first two count 0.625 and 0.375. Intensity leaves out 0 as it does null."""
    own = sums.withColumns({"intensity": F.coalesce(F.try_divide("felt", "n_felt").cast("double"), F.lit(0.0)), "stakes": F.col("n_stakes") / F.col("n_items"), "low_share": F.try_divide("n_low", "n_rated").cast("double")})
    rated = 0.5 * F.col("intensity") + 0.3 * 5 * F.col("stakes") + 0.2 * 5 * F.col("low_share")
    return own.withColumn("severity", clamp(F.when(F.col("low_share").isNull(), 0.625 * F.col("intensity") + 0.375 * 5 * F.col("stakes")).otherwise(rated)))


def strategic_fit(sums: DataFrame) -> DataFrame:
    """area_sums with 5 * mean relevance * share of vague items."""
    own = sums.withColumns({"relevance": F.col("relevance10") / (10 * F.col("n_items")), "vague_share": F.col("n_vague") / F.col("n_items")})
    return own.withColumn("strategic_fit", clamp(5 * F.col("relevance") * F.col("vague_share")))


def evidence_quality(sums: DataFrame) -> DataFrame:
    """area_sums with 0.4 strength + 0.3 * 5 * platforms (4 are enough) + 0.3 * 5 * log count (50 are enough)."""
    volume = F.when(F.col("n_items") < 2, 0.0).otherwise(F.least(F.lit(1.0), F.ln(F.col("n_items")) / F.ln(F.lit(50.0))))
    score = 0.4 * F.try_divide("sure", "n_sure") + 0.3 * 5 * F.least("platforms", F.lit(4)) / 4 + 0.3 * 5 * volume
    return sums.withColumn("evidence_quality", clamp(score))


def rubric(sums: DataFrame) -> DataFrame:
    """area_sums with heuristic leverage and research value from categories and vagueness."""
    leverage = F.when(F.col("n_categories") >= 8, 4.0).when(F.col("n_categories") >= 4, 3.0).otherwise(2.0)
    return sums.withColumns({"product_leverage": leverage, "research_value": clamp(1 + 4 * F.col("n_vague") / F.col("n_items"))})


def frequency(vague: DataFrame, cap: int = 200, alpha: float = 0.15, raw_weight: float = 0.5) -> DataFrame:
    """Adjusted share of the day-capped vague items, as quantile or steps."""
    capped = cap_by_day(vague).where("kept")
    shares = source_shares(capped).groupBy("area_id").agg(F.avg("share").alias("balanced"), F.sum("n").alias("n_capped"))
    total = Window.partitionBy()
    shares = shares.withColumn("raw", F.col("n_capped") / F.sum("n_capped").over(total)).join(engagement(vague, cap, alpha), "area_id")
    shares = shares.withColumn("adjusted", (raw_weight * F.col("raw") + (1 - raw_weight) * F.col("balanced")) * F.col("factor"))
    scored = quantile_scores(shares.withColumn("adjusted", F.round("adjusted", 9)), "adjusted", "quantile")
    score = F.when(F.count("*").over(total) >= QUANTILE_AREAS, F.col("quantile")).otherwise(step_score(F.col("adjusted")))
    return scored.withColumn("frequency", score).select("area_id", "adjusted", "frequency")


def normalize_weights(weights: dict[str, float]) -> dict[str, float]:
    """Shares of the weights, negative ones as 0."""
    own = {k: max(0.0, v) for k, v in weights.items()}
    total = sum(own.values())
    if total <= 0:
        raise ValueError("no weight is positive")
    return own if abs(total - 1) <= 1e-6 else {k: v / total for k, v in own.items()}


def composite(weights: dict[str, float]) -> Column:
    return two(sum((F.lit(w) * F.col(k) for k, w in normalize_weights(weights).items()), F.lit(0.0)))


def band(score: Column) -> Column:
    return F.when(score >= HIGH, "High").when(score >= MEDIUM, "Medium").otherwise("Low")


def low_evidence(items: Column, quality: Column) -> Column:
    return (items < LEAST_ITEMS) | (quality < LEAST_QUALITY)


def area_scores(items: DataFrame) -> DataFrame:
    """All six dimensions of each area, two decimals, with its number of items. The
    items are written once and read for the frequency and for all other dimensions."""
    items = Scratch(items.sparkSession, "scores").write(items, "items")
    sums = rubric(evidence_quality(strategic_fit(severity(area_sums(items)))))
    met = frequency(items.where("retrieval_type = 'vague'")).join(sums, "area_id")
    return met.select("area_id", "n_items", *[two(F.col(d)).alias(d) for d in DIMENSIONS])


def rank_areas(scores: DataFrame, weights: dict[str, float], then: tuple[Column, ...] | None = None) -> DataFrame:
    """Composite, band, guardrail and rank; areas of little evidence come last.
    ``then`` breaks ties: by default evidence quality, items, id."""
    ties = then if then is not None else (F.desc("evidence_quality"), F.desc("n_items"), F.asc("area_id"))
    scored = scores.withColumn("composite", composite(weights))
    scored = scored.withColumn("band", band(F.col("composite"))).withColumn("low_evidence", low_evidence(F.col("n_items"), F.col("evidence_quality")))
    return scored.withColumn("rank", F.row_number().over(Window.orderBy("low_evidence", F.desc("composite"), *ties)))


def sensitivity(scores: DataFrame, weights: dict[str, float], shift: float = 0.2) -> DataFrame:
    """``scenario, top3``: the first three areas when each weight is raised and
    lowered in turn; one join with twelve rows of weights."""
    spark = scores.sparkSession
    rows = []
    for name in weights:
        for sign in (1, -1):
            own = normalize_weights(weights | {name: weights[name] * (1 + sign * shift)})
            rows.append((f"{name}{'+' if sign > 0 else '-'}", *(own[d] for d in DIMENSIONS)))
    scenarios = spark.createDataFrame(rows, ["scenario", *(f"w_{d}" for d in DIMENSIONS)])
    total = two(sum((F.col(f"w_{d}") * F.col(d) for d in DIMENSIONS), F.lit(0.0)))
    met = scores.join(F.broadcast(scenarios)).withColumn("composite", total)
    order = Window.partitionBy("scenario").orderBy(low_evidence(F.col("n_items"), F.col("evidence_quality")), F.desc("composite"), F.desc("evidence_quality"), F.desc("n_items"), "area_id")
    top = met.withColumn("place", F.row_number().over(order)).where("place <= 3")
    named = top.groupBy("scenario").agg(F.array_sort(F.collect_list(F.struct("place", "area_id"))).alias("top"))
    return named.select("scenario", F.array_join(F.transform("top", lambda x: x["area_id"]), ",").alias("top3"))
