"""Structured Streaming counterparts of the incremental batch behaviour."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.scratch import Scratch


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream, late by three days at most."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "3 days")


def daily_counts(events: DataFrame) -> DataFrame:
    own = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return own.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def last_write_wins(events: DataFrame, key: str) -> DataFrame:
    return events.dropDuplicatesWithinWatermark([key])


def daily_counts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream over what is there, and return what it wrote."""
    return run_once(spark, daily_counts(event_stream(spark, sf_dir)), ["day", "event_type"], "complete")


def run_once(spark: SparkSession, stream: DataFrame, key: list[str], mode: str) -> DataFrame:
    """Run a stream over what is there; every batch is written as Parquet, and of rows
    that several batches have for a key that of the last one counts."""
    at, path = Scratch(spark, "stream"), None
    path = at.place("out")
    schema = stream.schema

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", at.place("checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    written = spark.read.schema(schema.add("_batch", "long")).option("recursiveFileLookup", "true").parquet(path)
    last = written.groupBy(*key).agg(F.max_by(F.struct(*[c for c in schema.names if c not in (*key, "_batch")]), "_batch").alias("_last"))
    return last.select(*key, "_last.*")


def last_events(events: DataFrame, key: str) -> DataFrame:
    """The last write of each key so far: a streaming aggregate by event time and id."""
    return events.groupBy(key).agg(F.max(F.struct("ts", "event_id")).alias("_m")).select(key, F.col("_m.event_id").alias("event_id"))


def histories(events: DataFrame, key: str, value: str, most: int = 5) -> DataFrame:
    """``key, last5``: the last values of each key by value, as state between batches;
    the state of a key holds ``most`` values."""
    kind = dict(events.dtypes)

    def run(own, frames, state):
        held = list(state.get[0]) if state.exists else []
        for frame in frames:
            held = sorted({*held, *frame[value].tolist()})[-most:]
        state.update((held,))
        yield pd.DataFrame({key: [own[0]], "last5": [",".join(map(str, held))]})

    grouped = events.select(key, value).groupBy(key)
    return grouped.applyInPandasWithState(run, f"{key} {kind[key]}, last5 string", f"held array<{kind[value]}>", "update", "NoTimeout")
