"""Linking of rows that share a bucket key, without emitting all pairs of a bucket.

Rows are (key, id, payload). Buckets of one row are dropped after a count; the
rows of the others are brought together in sorted partitions and a kernel
verifies them group by group in numpy, returning the edges of a spanning forest
of each group's true links: components stay exact and output stays linear. A
bucket of more than ``block`` rows is cut into chunks and each pair of chunks
becomes a group of its own, so that no task ever holds more than two chunks of
it and every pair of rows still meets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

Kernel = Callable[[np.ndarray, pa.Table], "tuple[np.ndarray, np.ndarray]"]


def shared_keys(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """``key, n`` of the buckets that hold two rows or more."""
    return scratch.write(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")


def whole_groups(batches: Iterator[pa.RecordBatch], column: str = "grp") -> Iterator[pa.Table]:
    """Regroup sorted batches so that each table holds whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column(column).to_numpy()
        last = int(np.searchsorted(groups, groups[-1], side="left")) if groups[0] <= groups[-1] else 0
        if last == 0 and held and held[-1].column(column)[-1].as_py() == int(groups[0]):
            held.append(batch)
            continue
        if last == 0:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def bounds(table: pa.Table, column: str = "grp") -> np.ndarray:
    """Starts of the groups, and the number of rows."""
    groups = table.column(column).to_numpy()
    return np.concatenate(([0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]))


def link(shared: DataFrame, kernel: Kernel, block: int) -> DataFrame:
    """Distinct edges ``a, b`` found by the kernel. ``shared``: key, n, id and any
    payload columns, n being the number of rows of the key."""
    payload = [c for c in shared.columns if c not in ("key", "n", "id")]
    chunks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    row = shared.withColumn("_n", chunks).withColumn("_c", F.pmod(F.xxhash64("id", F.lit(7)), F.col("_n")).cast("int"))
    others = F.when(F.col("_n") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda j: j != F.col("_c")))
    row = row.withColumn("_o", F.explode(others))
    grouped = row.select(F.xxhash64("key", F.least("_c", "_o"), F.greatest("_c", "_o")).alias("grp"), "id", *payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            a, b = kernel(bounds(table), table)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return grouped.repartition("grp").sortWithinPartitions("grp", "id").mapInArrow(run, "a long, b long").distinct()
