"""Calls to a model, as batches inside Spark tasks with an injected client.

A client takes the texts of one batch and gives (number, label, confidence) for each;
a rule-based one stands in where there is no network. What was answered before is
looked up by its key, never asked again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Answer = tuple[int, str, float]
Client = Callable[[list[str]], list[Answer]]


def call_key(model: str, prompt: str, text: Column) -> Column:
    """What makes two calls the same."""
    return F.sha2(F.concat_ws("\x1f", F.lit(model), F.lit(prompt), text), 256)


def ask(client: Client, texts: list[str]) -> list[tuple[str | None, float | None]]:
    """Answers in the order of the texts. A batch whose numbers do not match is asked
    again in halves; a single text without an answer gets none."""
    answers = client(texts)
    found = {n: (label, confidence) for n, label, confidence in answers}
    if len(answers) == len(texts) and set(found) == set(range(len(texts))):
        return [found[i] for i in range(len(texts))]
    if len(texts) == 1:
        return [(None, None)]
    half = len(texts) // 2
    return ask(client, texts[:half]) + ask(client, texts[half:])


def classify(items: DataFrame, client: Client, most_items: int, most_chars: int, key: str = "item_id") -> DataFrame:
    """``key, label, confidence`` of items (key, text): batches of a task's rows, of at
    most so many items and characters, a longer text alone. A null text is an empty one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            held: list[tuple[object, str]] = []
            out: list[tuple] = []

            def flush() -> None:
                out.extend((k, *a) for (k, _), a in zip(held, ask(client, [x for _, x in held]), strict=True))  # noqa: B023
                held.clear()  # noqa: B023

            for k, text in zip(frame[key], frame["text"].fillna(""), strict=True):
                if held and (len(held) >= most_items or sum(len(x) for _, x in held) + len(text) > most_chars):
                    flush()
                held.append((k, text))
            if held:
                flush()
            yield pd.DataFrame(out, columns=[key, "label", "confidence"])

    return items.select(key, "text").mapInPandas(run, f"{key} {dict(items.dtypes)[key]}, label string, confidence double")


def with_cache(items: DataFrame, cache: DataFrame, model: str, prompt: str, call: Callable[[DataFrame], DataFrame], labels: tuple[str, ...], key: str = "item_id") -> DataFrame:
    """``key, label, confidence, cached``: answers of the cache (call_key, label,
    confidence) that are valid labels, and calls for the rest."""
    keyed = items.withColumn("call_key", call_key(model, prompt, F.coalesce("text", F.lit(""))))
    valid = cache.where(F.col("label").isin(*labels)).dropDuplicates(["call_key"])
    known = keyed.join(valid, "call_key").select(key, "label", "confidence", F.lit(True).alias("cached"))
    fresh = call(keyed.join(valid, "call_key", "left_anti").select(key, "text"))
    return known.unionByName(fresh.select(key, "label", "confidence", F.lit(False).alias("cached")))


def escalate(items: DataFrame, small: DataFrame, large: Callable[[DataFrame], DataFrame], least: float, longest: int, key: str = "item_id") -> DataFrame:
    """``key, label, confidence, model``: long texts and unsure answers of the small model
    go to the large one."""
    met = items.join(small, key, "left")
    hard = (F.length(F.coalesce("text", F.lit(""))) > longest) | F.coalesce(F.col("confidence") < least, F.lit(True))
    sure = met.where(~hard).select(key, "label", "confidence", F.lit("small").alias("model"))
    return sure.unionByName(large(met.where(hard).select(key, "text")).select(key, "label", "confidence", F.lit("large").alias("model")))


def cost(items: DataFrame, text: str, prompt_tokens: int, output_tokens: int, most_items: int, input_price: float, output_price: float) -> DataFrame:
    """One row: calls, tokens in and out, and dollars for a million tokens at these prices."""
    tokens = F.sum(F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 4)))
    sums = items.agg(F.count("*").alias("n"), F.coalesce(tokens, F.lit(0)).alias("own"))
    calls = F.ceil(F.col("n") / most_items)
    out = sums.select("n", calls.alias("calls"), (F.col("own") + calls * prompt_tokens).alias("tokens_in"), (F.col("n") * output_tokens).alias("tokens_out"))
    return out.withColumn("usd", F.round((F.col("tokens_in") * input_price + F.col("tokens_out") * output_price) / 1e6, 6))


def cited(answers: DataFrame, refs: DataFrame) -> DataFrame:
    """answers (call_id, refs: names of what was cited) with the items that the names
    stand for (refs: call_id, ref, item_id); names that stand for nothing are counted."""
    rows = answers.select("call_id", F.posexplode_outer("refs").alias("at", "ref")).join(refs, ["call_id", "ref"], "left")
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("item_id").isNotNull(), F.struct("at", "item_id")))), lambda x: x["item_id"])
    return rows.groupBy("call_id").agg(listed.alias("items"), F.count_if(F.col("ref").isNotNull() & F.col("item_id").isNull()).alias("unknown"))
