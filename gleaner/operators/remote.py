"""Batches of model calls that a remote service answers later, over an injected transport."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from gleaner.operators.model import call_key
from gleaner.operators.service import retried

#: Calls of one batch, at most: they pass the driver.
MOST_CALLS = 10_000


class Transport(Protocol):
    """The service: ``submit`` takes (call_key, text) and names the batch, ``ended`` says
    whether all is answered, ``results`` gives (call_key, label, confidence, error)."""

    def submit(self, calls: list[tuple[str, str]]) -> str: ...
    def ended(self, batch: str) -> bool: ...
    def results(self, batch: str) -> Iterable[tuple[str, str | None, float | None, str | None]]: ...


class Pending(RuntimeError):
    """A batch that is not answered in time; ``batch`` takes it up again later."""

    def __init__(self, batch: str):
        super().__init__(f"batch {batch} is still being answered")
        self.batch = batch


def retryable(error: Exception) -> bool:
    """Lost connections, and answers that say to come back: too many requests or a server's
    own fault (``status_code``). A refused key or a bad request is not."""
    status = getattr(error, "status_code", None)
    return isinstance(error, (ConnectionError, TimeoutError)) or status in (408, 429) or (isinstance(status, int) and 500 <= status < 600)


def prepare(items: DataFrame, model: str, prompt: str, most_chars: int, output_tokens: int, input_price: float, output_price: float) -> DataFrame:
    """``call_key, text, usd``: each call once, with its cost at worst (prices for a million
    tokens). A null text is an empty one; a longer text than ``most_chars`` is an error of
    the caller, who shortens texts, and fails the query."""
    text = F.coalesce("text", F.lit(""))
    tokens = F.ceil((F.length(text) + len(prompt)) / 4)
    own = items.select(call_key(model, prompt, text).alias("call_key"), F.when(F.length(text) <= most_chars, text).otherwise(F.raise_error(F.lit(f"a text has more than {most_chars} characters"))).alias("text"))
    return own.dropDuplicates(["call_key"]).withColumn("usd", (tokens * input_price + output_tokens * output_price) / 1e6)


def fitting(calls: DataFrame, room: float, discount: float = 1.0, most: int = MOST_CALLS) -> DataFrame:
    """The first ``most`` calls by key, as far as their worst costs fit into the room. What
    is left goes into the next batch."""
    first = calls.orderBy("call_key").limit(most)  # a top-k, so the window below is of ``most`` rows
    total = F.sum(F.col("usd") * discount).over(Window.orderBy("call_key").rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("_total", total).where(F.col("_total") <= room).drop("_total")


def answered(
    calls: DataFrame, transport: Transport, room: float, discount: float = 0.5, batch: str | None = None, on_submit: Callable[[str], None] = lambda _: None,
    poll: float = 30.0, longest: float = 3600.0, most: int = MOST_CALLS, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``call_key, label, confidence, error`` of one batch of prepared calls: submitted (or
    taken up by its name, with the same calls and room), waited for, collected. Answers
    to other calls are left out, a call without an answer has an error; nothing to submit gives no rows."""
    spark, shape = calls.sparkSession, "call_key string, label string, confidence double, error string"
    wait = lambda n, error: min(30.0, 2.0**n) if retryable(error) else None
    sent: list[Row] = fitting(calls, room, discount, most).select("call_key", "text").collect()
    if not sent:
        return spark.createDataFrame([], shape)
    if batch is None:
        batch = transport.submit([(r["call_key"], r["text"]) for r in sent])  # once: a lost answer may have been taken
        on_submit(batch)
    began = clock()
    while not retried(lambda: transport.ended(batch), wait, sleep=sleep):
        if clock() - began >= longest:
            raise Pending(batch)
        sleep(poll)
    found = {key: (label, confidence, error) for key, label, confidence, error in retried(lambda: list(transport.results(batch)), wait, sleep=sleep)}
    return spark.createDataFrame([(r["call_key"], *found.get(r["call_key"], (None, None, "no answer"))) for r in sent], shape)
