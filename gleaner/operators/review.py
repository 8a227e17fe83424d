"""What reviewers and readers see of items and areas: views with corrections, dossiers,
curation, banners, exports and their audiences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import redact_names
from gleaner.operators.filters import Filters, latest_overrides


def in_window(day: Column, as_of: Column, days: int | None) -> Column:
    """Undated items always, others from so many days before on; without days all."""
    return F.lit(True) if days is None else day.isNull() | (day >= F.date_sub(as_of, days))


def decorated(items: DataFrame, key: str, fields: dict[str, str], log: DataFrame) -> DataFrame:
    """items with each column of ``fields`` (column: field of the log) as its latest
    correction says, the engine's own value as ``ai_<column>``, and ``corrected``. A
    correction to nothing clears the value. The corrections of an item are one row, so
    one join serves all fields."""
    own = latest_overrides(log.where(F.col("field").isin(*fields.values())))
    wide = own.groupBy(F.col("target_id").alias("_t")).agg(F.map_from_entries(F.collect_list(F.struct("field", F.coalesce("value", F.lit("")).alias("value")))).alias("_all"))
    met = items.join(wide, F.col(key) == F.col("_t"), "left")
    has = lambda f: F.coalesce(F.map_contains_key("_all", f), F.lit(False))
    for column, field in fields.items():
        kind = items.schema[column].dataType
        value = F.nullif(F.try_element_at("_all", F.lit(field)), F.lit("")).try_cast(kind)
        met = met.withColumn(f"ai_{column}", F.col(column)).withColumn(column, F.when(has(field), value).otherwise(F.col(column)))
    return met.withColumn("corrected", sum((has(f).cast("int") for f in fields.values()), F.lit(0)) > 0).drop("_t", "_all")


def floor(value: Column, least: float) -> Column:
    """At least so much; no floor of 0 leaves out what has no value."""
    return F.lit(True) if least <= 0 else F.coalesce(value >= least, F.lit(False))


def exported(items: DataFrame, key: str, log: DataFrame, filters: Filters, vague_min: float = 0, severity: tuple[int, int] = (1, 5)) -> DataFrame:
    """The items that an export of these filters holds, corrections applied first."""
    own = decorated(items, key, {"category": "view", "relevance10": "click"}, log)
    band = F.lit(True) if severity == (1, 5) else F.coalesce(F.col("frustration").between(*severity), F.lit(False))
    return own.where(filters.evidence() & floor(F.col("relevance10"), vague_min) & band)


def external(items: DataFrame, texts: list[str]) -> DataFrame:
    """For readers outside: nothing of high stakes or grief, and no names of kin."""
    own = items.where(~F.coalesce("high_stakes", F.lit(False)) & ~F.coalesce(F.col("emotion") == "sad_loss", F.lit(False)))
    return own.withColumns({t: redact_names(F.col(t)) for t in texts})


def ordered_counts(rows: DataFrame, by: str, value: Column, order: list[str] | None = None) -> DataFrame:
    """``by, value, n, place``: counts of each value by number and name, or those that a
    given order names first, in that order."""
    counts = rows.groupBy(by, value.alias("value")).agg(F.count("*").alias("n"))
    listed = F.array_position(F.array(*map(F.lit, order)), F.col("value")) if order else F.lit(0)
    first = F.when(listed > 0, listed).otherwise(F.lit(len(order or []) + 1))
    ranked = counts.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(first.alias("l"), (-F.col("n")).alias("c"), "value"))).alias("all"))
    return ranked.select(by, F.posexplode("all").alias("at", "x")).select(by, "x.value", (-F.col("x.c")).alias("n"), (F.col("at") + 1).alias("place"))


def share(part: Column, whole: Column) -> Column:
    """Four decimals, null of nothing."""
    return F.round(F.try_divide(part, F.nullif(whole, F.lit(0))), 4)


def area_bundle(items: DataFrame, by: str = "area_id") -> DataFrame:
    """The plain measures of each area in one aggregate."""
    n, felt = F.count("*"), F.when(F.col("frustration") > 0, F.col("frustration"))
    return items.groupBy(by).agg(
        n.alias("items"), F.count_if(F.col("retrieval_type") == "vague").alias("vague_items"), F.count_if(F.col("retrieval_type") == "general").alias("general_items"),
        share(F.count_if(F.col("retrieval_type") == "vague"), n).alias("vague_share"), share(F.sum("relevance10"), F.count("relevance10")).alias("mean_relevance"),
        share(F.sum(felt), F.count(felt)).alias("mean_frustration"), share(F.count_if("high_stakes"), n).alias("high_stakes_share"), F.count("rating").alias("rated_items"),
        share(F.count_if(F.col("rating") <= 2), F.count("rating")).alias("low_rating_share"), share(F.sum("strength"), F.count("strength")).alias("mean_strength"),
        F.sum("quantity").alias("engagement"), F.countDistinct("source").alias("n_sources"), F.countDistinct("platform").alias("n_platforms"),
        F.date_format(F.min("day"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("day"), "yyyy-MM-dd").alias("last_day"),
    )


def top_values(items: DataFrame, value: Column, raw: Column, k: int = 10, examples: int = 3, by: str = "area_id") -> DataFrame:
    """``by, value, n, place, examples``: the k most frequent values of each area (items
    counted once for each) with the first distinct wordings by item_id."""
    own = items.select(by, "item_id", value.alias("value"), raw.alias("raw")).where("value != ''")
    wordings = own.groupBy(by, "value", "raw").agg(F.min("item_id").alias("first"), F.count_distinct("item_id").alias("m"))
    counted = own.groupBy(by, "value").agg(F.count_distinct("item_id").alias("n"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "value"))
    best = counted.withColumn("place", place).where(F.col("place") <= k)
    nth = F.row_number().over(Window.partitionBy(by, "value").orderBy("first", "raw"))
    few = wordings.join(best.select(by, "value"), [by, "value"], "left_semi").withColumn("nth", nth).where(F.col("nth") <= examples)
    listed = few.groupBy(by, "value").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "raw"))), lambda x: x["raw"]), "|").alias("examples"))
    return best.join(listed, [by, "value"]).select(by, "value", "n", "place", "examples")


def curation(log: DataFrame, fields: list[str]) -> DataFrame:
    """``target_id, field, value``: what is in force after all entries in order of time
    and id; an empty value takes a field back."""
    last = log.where(F.col("field").isin(*fields)).groupBy("target_id", "field").agg(F.max(F.struct("created_at", "override_id", "value")).alias("m"))
    return last.select("target_id", "field", F.col("m.value").alias("value")).where("value is not null and value != ''")


def splits(log: DataFrame, field: str) -> DataFrame:
    """``area_id, target_id, clusters``: every split entry makes an area of its own, its
    id taken from the entry and the clusters that it names."""
    own = log.where(F.col("field") == field)
    seed = F.concat_ws("|", "target_id", F.col("override_id").cast("string"), "value")
    return own.select(F.concat(F.lit("oa-"), F.substring(F.sha2(seed, 256), 1, 8)).alias("area_id"), "target_id", F.split("value", ",").alias("clusters"))


def banner(stages: DataFrame, published: DataFrame) -> DataFrame:
    """``run_id, kind`` of the newest run (run_id, stage, status, started_at) that began
    after the published one, or no row: running, failed, or unpublished (shown as
    running) while nothing of it is published."""
    newer = stages.join(F.broadcast(published.select(F.col("run_id").alias("_p"), "published_at")), (F.col("run_id") != F.col("_p")) & (F.col("started_at") > F.col("published_at")))
    runs = newer.groupBy("run_id").agg(
        F.max("started_at").alias("at"), F.bool_or(F.col("status") == "running").alias("running"), F.bool_or(F.col("status").isin("failed", "partial")).alias("failed"),
        F.bool_or((F.col("stage") == "score") & (F.col("status") == "published")).alias("published"),
    )
    kind = F.when(F.col("running"), "running").when(F.col("failed"), "failed").when(~F.col("published"), "running")
    return runs.orderBy(F.desc("at"), F.desc("run_id")).limit(1).select("run_id", kind.alias("kind")).where("kind is not null")


def first_error(stages: DataFrame, limit: int = 300) -> DataFrame:
    """``run_id, error``: the first message of each run, cut."""
    return stages.where("error is not null").groupBy("run_id").agg(F.substring(F.min_by("error", F.struct("started_at", "stage")), 1, limit).alias("error"))


def parent_status(stages: DataFrame) -> DataFrame:
    """``run_id, status``: failed if all parts failed, partial if some did or were
    partial, else success."""
    bad, odd = F.count_if(F.col("status") == "failed"), F.count_if(F.col("status").isin("failed", "partial"))
    return stages.groupBy("run_id").agg(F.when(bad == F.count("*"), "failed").when(odd > 0, "partial").otherwise("success").alias("status"))


def checked_rows(rows: DataFrame, required: list[str], numbers: dict[str, tuple[int, int]], choices: dict[str, tuple[str, ...]]) -> DataFrame:
    """rows with ``problems``: what is missing, no number in its range, or no choice."""
    found = [F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.lit(f"{c} is missing")) for c in required]
    for c, (low, high) in numbers.items():
        given = F.trim(F.coalesce(c, F.lit(""))) != ""
        found.append(F.when(given & ~F.coalesce(F.col(c).try_cast("int").between(low, high), F.lit(False)), F.lit(f"{c} is not {low} to {high}")))
    for c, allowed in choices.items():
        given = F.lower(F.trim(F.coalesce(c, F.lit(""))))
        found.append(F.when((given != "") & ~given.isin(*allowed), F.lit(f"{c} is unknown")))
    return rows.withColumn("problems", F.array_compact(F.array(*found)))


def stamped(rows: DataFrame, **stamp: str) -> DataFrame:
    """rows with the facts of an export on each."""
    return rows.withColumns({k: F.lit(v) for k, v in stamp.items()})
