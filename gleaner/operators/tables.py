"""Upserts, histories, run-scoped writes, the publish gate."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.scalars import keep_last


def classify_upsert(stored: DataFrame, batch: DataFrame, key: str, content: list[str], order: str) -> DataFrame:
    """``key, change``: new, updated, unchanged or kept (not in the batch). The last
    of a batch's rows with one key wins."""
    last = batch.groupBy(key).agg(F.max_by(F.struct(*content), order).alias("fresh"))
    met = stored.select(key, F.struct(*content).alias("old")).join(last, key, "full_outer")
    change = F.when(F.col("old").isNull(), "new").when(F.col("fresh").isNull(), "kept").when(F.col("old").eqNullSafe(F.col("fresh")), "unchanged").otherwise("updated")
    return met.select(key, change.alias("change"))


HISTORY = 5


def upsert_items(stored: DataFrame, batch: DataFrame, key: str, content: list[str], order: str, derived: list[str]) -> DataFrame:
    """The table after a batch: stored (key, content, derived, history) with its rows
    updated where the content differs, and new rows. An update puts the old content
    into the history, of which the last HISTORY entries stay, and clears the derived
    columns. ``change`` says what happened to each row."""
    last = batch.groupBy(key).agg(F.max_by(F.struct(*content), order).alias("_fresh"))
    old = F.struct(*content)
    met = stored.withColumn("_old", old).join(last, key, "full_outer")
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_fresh").isNull(), "kept").when(F.col("_old").eqNullSafe(F.col("_fresh")), "unchanged").otherwise("updated")
    met = met.withColumn("change", change)
    updated = F.col("change") == "updated"
    empty = F.array().cast(stored.schema["history"].dataType)
    history = F.coalesce("history", empty)
    pushed = F.when(updated, keep_last(F.concat(history, F.array(F.to_json("_old"))), HISTORY)).otherwise(history)
    now = [F.coalesce(F.col("_fresh"), F.col("_old"))[c].alias(c) for c in content]
    return met.select(key, *now, *[F.when(~updated, F.col(c)).alias(c) for c in derived], pushed.alias("history"), "change")


def replace_rows(stored: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """stored without the keys of fresh, and fresh."""
    return stored.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def only_in_scope(stored: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """stored without the keys that are out of scope now."""
    return stored.join(scope.select(key).distinct(), key, "left_semi")


def insert_absent(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """stored and the rows of fresh whose keys it lacks, each once."""
    return stored.unionByName(fresh.join(stored.select(*keys), keys, "left_anti").dropDuplicates(keys))


def repoint(bridge: DataFrame, dropped: DataFrame, key: str = "item_id") -> DataFrame:
    """bridge with the items that merges dropped (key, canonical_id) replaced by those
    they ended in."""
    ends = dropped.select(F.col(key).alias("_gone"), F.col("canonical_id").alias("_end"))
    return bridge.join(ends, F.col(key) == F.col("_gone"), "left").withColumn(key, F.coalesce("_end", key)).drop("_gone", "_end")


def without_parents(children: DataFrame, dropped: DataFrame, key: str = "item_id") -> DataFrame:
    """Rows that belong to no dropped item."""
    return children.join(dropped.select(key).distinct(), key, "left_anti")


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Replace one run's partition and leave the others."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def append_snapshot(raw: DataFrame, path: str, source: str, run_id: str) -> None:
    """Append a run's raw rows as JSON lines below its source and run."""
    raw.withColumn("source", F.lit(source)).withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("source", "run_id").json(path)


def publish(spark: SparkSession, path: str, run_id: str, at: str) -> None:
    """Move the published pointer: one more numbered row; the last one counts, so that
    a reader sees the old run or the new one."""
    try:
        number = (spark.read.schema("number long, run_id string, published_at string").json(path).agg(F.max("number")).head()[0] or 0) + 1
    except AnalysisException:
        number = 1
    spark.createDataFrame([(number, run_id, at)], "number long, run_id string, published_at string").coalesce(1).write.mode("append").json(path)


def published(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, published_at`` of the pointer, no row when nothing is published."""
    rows = spark.read.schema("number long, run_id string, published_at string").json(path)
    last = rows.agg(F.max_by(F.struct("run_id", "published_at"), "number").alias("p"))
    return last.where("p is not null").select("p.run_id", F.to_timestamp("p.published_at").alias("published_at"))


REQUIRED_STAGES = ("prep", "funnel", "extract", "cluster", "score")


def publish_reasons(stages: dict[str, str], active_areas: int, scored_areas: int, quoted_areas: int, evidence: int, evidence_before: int | None, heuristic: bool, most_drop: float = 0.9) -> list[str]:
    """Why a run must not be published; empty if it may."""
    out = [f"stage {s} is {stages.get(s, 'missing')}" for s in REQUIRED_STAGES if stages.get(s) not in ("success", "partial")]
    if not active_areas:
        out.append("no active area")
    if scored_areas < active_areas:
        out.append(f"{active_areas - scored_areas} areas have no score")
    if quoted_areas < active_areas:
        out.append(f"{active_areas - quoted_areas} areas have no quote")
    if evidence_before and evidence < (1 - most_drop) * evidence_before:
        out.append(f"evidence fell from {evidence_before} to {evidence}")
    if heuristic:
        out.append("scores are heuristic")
    return out


def run_status(error: bool, errors: int, final: str | None = None) -> str:
    """failed on an exception, the explicit status if there is one, partial with errors."""
    return "failed" if error else final or ("partial" if errors else "success")
