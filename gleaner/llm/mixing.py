"""Mixing of sources to target weights by capped water-filling.

Every source gets a share of the mix in proportion to its weight, but no more
than ``epochs`` times its own size: sources above that are clamped and their
excess goes to the others by weight, again and again until none is above. The
table of sources stays distributed; each round brings three sums to the driver.
Documents then get the whole repetitions that their source's ratio allows, and
the fraction left is met by the first documents of a seeded order, up to the
fraction's words: per source, sizes are summed into bins of the order, whole
bins before the boundary are taken, and only the boundary bin is ranked. The
order is that of a hash of doc_id and text, so that rows without doc_id, or with
one of many, are spread like any others; rows that agree in both are counted
together, and at the boundary as many of them are taken as fit.

Defined cases: a null text has size 0 and is never copied beyond the whole
repetitions; the null source is a source of its own, last in order. An empty
table gives no rows; sources without words get target 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

WORD = "[^\\x20\\x09-\\x0D]+"
SEED = "mix-1"
#: Bins of the seeded order of each source: the first three hex digits.
DIGITS = 3
#: Sources, and bytes of their names, that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null. Every word becomes one letter and what is between
    the words goes, so that no array of words is built."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORD, "w"), "[^w]+", "")).cast("long"), F.lit(0).cast("long"))


def cyclic_weights(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``weight`` for each source, the cycle dealt out by code point order, null
    last. Sources are range-partitioned and numbered by partition, so their
    number is not bounded."""
    spread = sizes.withColumn("_null", F.col("source").isNull()).repartitionByRange("_null", "source").sortWithinPartitions("_null", "source")
    spread = spread.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    scratch = Scratch(sizes.sparkSession, "mix-order")
    spread = scratch.write(spread, "order")
    parts = spread.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", "_first", "_before")
    rank = F.col("_before") + F.col("_row") - F.col("_first")
    weights = F.array(*[F.lit(w) for w in cycle])
    return spread.join(offset, "_part").select("source", "source_size", F.element_at(weights, (rank % len(cycle)).cast("int") + 1).cast("long").alias("weight"))


def fill(sources: DataFrame, epochs: int = 3, share: float = 1.0) -> DataFrame:
    """``target`` for each source of (source, source_size, weight). The targets
    add up to ``share`` of all sizes, as far as the caps allow it."""
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).head()[0] * share
    cap = F.col("source_size") * F.lit(epochs)
    level, clamped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        full, weight, now = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)), F.count_if(over)
        ).head()
        if now == clamped or not weight:
            break
        clamped, level = now, (total - full) / weight
    return sources.withColumn("target", F.when(over, cap.cast("double")).otherwise(F.col("weight") * F.lit(level)))


def seeded(seed: str = SEED) -> Column:
    """The seeded order of doc_id and text: hex digits that any engine can compute."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))


def decide(docs: DataFrame, epochs: int, cycle: tuple[int, ...], seed: str, scratch: Scratch) -> DataFrame:
    """``doc_id, source, size, order, n, source_size, target, whole, n_extra``: n rows
    that agree in doc_id, source and text get ``whole`` repetitions each, and n_extra
    of them one more."""
    own = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), seeded(seed).alias("order"))
    own = scratch.write(own.groupBy("doc_id", "source", "size", "order").agg(F.count("*").alias("n")).withColumn("bin", F.substring("order", 1, DIGITS)), "sizes")
    bins = scratch.write(own.groupBy("source", "bin").agg(F.sum(F.col("size") * F.col("n")).alias("bin_size")), "bins")
    sizes = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    sources = scratch.write(fill(cyclic_weights(sizes, cycle), epochs), "targets").drop("weight")
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", ratio).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    reach = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)))
    reach = reach.join(sources, reach.source.eqNullSafe(sources.source)).drop(sources.source)
    end = F.col("before") + F.col("bin_size")
    fate = F.when(end <= F.col("part"), "in").when(F.col("before") >= F.col("part"), "out").otherwise("boundary")
    reach = scratch.write(reach.select(F.col("source").alias("s"), F.col("bin").alias("b"), "source_size", "target", "whole", "part", "before", fate.alias("fate")), "bins-met")
    met = own.join(reach, own.source.eqNullSafe(reach.s) & (own.bin == reach.b)).drop("s", "b")
    within = Window.partitionBy("source", "bin").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = met.where("fate = 'boundary'").withColumn("inner", F.coalesce(F.sum(F.col("size") * F.col("n")).over(within), F.lit(0)))
    # the k-th of equal rows (from 0) is taken while 2 * (its words before + k * size) + size <= 2 * part
    room = 2 * (F.col("part") - F.col("before") - F.col("inner")) - F.col("size")
    fit = F.when(room < 0, 0).otherwise(F.least(F.col("n"), F.floor(room / (2 * F.greatest("size", F.lit(1)))) + 1))
    edge = edge.withColumn("n_extra", F.when(F.col("size") > 0, fit).otherwise(0).cast("long")).drop("inner")
    plain = met.where("fate != 'boundary'").withColumn("n_extra", F.when((F.col("fate") == "in") & (F.col("size") > 0), F.col("n")).otherwise(0).cast("long"))
    return plain.unionByName(edge).select("doc_id", "source", "size", "order", "n", "source_size", "target", "whole", "n_extra")


def counted(df: DataFrame, n: str, number: str, step: int = 1 << 16) -> DataFrame:
    """Every row n times, with ``number`` counting from 1, in steps so that no long
    array is built."""
    df = df.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(step).cast("long"))))
    last = F.least(F.col(n), F.col("_from") + step)
    return df.withColumn(number, F.explode(F.sequence(F.col("_from") + 1, last))).drop("_from")


def mix(docs: DataFrame, epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3), seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row:
    copies is the number of times that the mix takes it, taken its words."""
    rows = counted(decide(docs, epochs, cycle, seed, Scratch(docs.sparkSession, "mix")), "n", "_number")
    rows = rows.withColumn("copies", F.col("whole") + (F.col("_number") <= F.col("n_extra")).cast("long"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3), seed: str = SEED) -> DataFrame:
    """The mix itself: every row of docs as many times as the mix takes it, with
    ``copy`` counting from 1 (in place of a column of that name). The decisions of a
    source come down to its whole repetitions and the first place of the seeded order
    that gets none more, so no text is shuffled. Of rows that agree in doc_id and text
    and of which the mix takes some only, at most one such lot for a source, those
    that come first by their other columns are taken."""
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.write(decide(docs, epochs, cycle, seed, scratch), "decided")
    some = (F.col("n_extra") > 0) & (F.col("n_extra") < F.col("n"))
    limits = rows.groupBy(F.col("source").alias("_source")).agg(
        F.max("whole").alias("_whole"), F.max(F.when((F.col("n_extra") > 0) & (F.col("n_extra") == F.col("n")), F.col("order"))).alias("_upto"),
        F.max(F.when(some, F.col("order"))).alias("_some"), F.max(F.when(some, F.col("n_extra"))).alias("_n_some"),
    )
    limits = scratch.write(limits, "limits")
    met = docs.join(small(limits), F.col("source").eqNullSafe(F.col("_source"))).withColumn("_order", seeded(seed))
    split = F.col("_some").isNotNull() & (F.col("_order") == F.col("_some"))
    extra = F.when(F.col("text").rlike(WORD) & (F.col("_order") <= F.col("_upto")), 1).otherwise(0)
    plain = met.where(~split).withColumn("_copies", (F.col("_whole") + extra).cast("int")).where("_copies > 0")
    names = [c for c in docs.columns if c != "copy"]
    out = plain.select(*names, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    if not limits.where("_some is not null").head(1):
        return out
    # equal rows are one with a count; the counts run on over those that differ in other columns
    alike = met.where(split).groupBy("_source", "_whole", "_n_some", *names).agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_source").orderBy(*[F.col(c) for c in names if c != "text"]).rowsBetween(Window.unboundedPreceding, -1)
    alike = counted(alike.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0))), "_n", "_number")
    copies = (F.col("_whole") + (F.col("_before") + F.col("_number") <= F.col("_n_some")).cast("int")).cast("int")
    alike = alike.withColumn("_copies", copies).where("_copies > 0")
    return out.unionByName(alike.select(*names, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy")))


def small(limits: DataFrame) -> DataFrame:
    """The sources, to be broadcast if their rows and the bytes of their names are few."""
    rows, size = limits.agg(F.count("*"), F.sum(F.coalesce(F.octet_length("_source"), F.lit(0)))).head()
    return F.broadcast(limits) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else limits
