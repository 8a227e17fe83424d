"""Gold samples and the metrics of labels against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import phrase_match
from gleaner.operators import similar
from gleaner.scratch import Scratch


def stratum(text: Column, rating: Column, intent: list[str], vague: list[str], content: list[str], feature: list[str], low: int = 3) -> Column:
    """likely_relevant with an intent and a vague or content phrase, borderline with an
    intent or a feature under a low rating, else likely_irrelevant."""
    wants = phrase_match(text, intent)
    likely = wants & (phrase_match(text, vague) | phrase_match(text, content))
    border = wants | (phrase_match(text, feature) & F.coalesce(rating <= low, F.lit(False)))
    return F.when(likely, "likely_relevant").when(border, "borderline").otherwise("likely_irrelevant")


def gold_sample(items: DataFrame, size: int, per_stratum: int, overlap: int, seed: str = "gold") -> DataFrame:
    """``item_id, stratum, source, overlap``: of each stratum ``per_stratum`` items, its
    sources by turns in a seeded order; what is short of ``size`` is topped up from the
    rest in that order, and ``overlap`` items, the strata by turns, go to both labelers.
    Ranks are cut at ``size`` before they meet, so a hot source costs no more."""
    order = F.md5(F.concat(F.lit(seed + ":"), F.col("item_id").cast("string")))
    turn = F.row_number().over(Window.partitionBy("stratum", "source").orderBy("o", "item_id"))
    own = items.select("item_id", "stratum", "source", order.alias("o")).withColumn("turn", turn).where(F.col("turn") <= size)
    place = F.row_number().over(Window.partitionBy("stratum").orderBy("turn", F.col("source").asc_nulls_last(), "item_id"))
    own = own.withColumn("place", place).where(F.col("place") <= size)
    own = own.withColumn("later", (F.col("place") > per_stratum).cast("int"))
    chosen = own.orderBy("later", F.when(F.col("later") == 1, F.col("place")).otherwise(0), "stratum", "place").limit(size)
    among = F.row_number().over(Window.partitionBy("stratum").orderBy("place"))
    both = F.row_number().over(Window.orderBy(among, "stratum"))  # of ``size`` rows
    return chosen.withColumn("overlap", both <= overlap).select("item_id", "stratum", "source", "overlap")


def rate(hits: Column, total: Column) -> Column:
    return F.round(F.try_divide(hits, F.nullif(total, F.lit(0))), 6)


def funnel_metrics(rows: DataFrame) -> DataFrame:
    """``source, n, recall_a, recall_ab, precision_c, recall_c, end_to_end, pending`` by
    source and over all (null) of gold rows (source, gold, a, b, c): gold is relevant,
    not or ambiguous (left out), a and b whether a stage kept the row, c its label or
    null where that is pending."""
    good = F.col("gold") == "relevant"
    kept, said = F.col("a") & F.col("b"), F.coalesce(F.col("c") == "relevant", F.lit(False))
    judged = F.col("c").isNotNull()
    return rows.where("gold != 'ambiguous'").groupingSets([["source"], []], "source").agg(
        F.count("*").alias("n"), rate(F.count_if(good & F.col("a")), F.count_if(good)).alias("recall_a"), rate(F.count_if(good & kept), F.count_if(good)).alias("recall_ab"),
        rate(F.count_if(good & said), F.count_if(said)).alias("precision_c"), rate(F.count_if(good & said), F.count_if(good & judged)).alias("recall_c"),
        rate(F.count_if(good & kept & said), F.count_if(good)).alias("end_to_end"), F.count_if(kept & ~judged).alias("pending"),
    )


def target_gaps(metrics: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``metric, value, target`` of the overall metrics that miss their target."""
    rows = metrics.where("source is null").unpivot(["n"], list(targets), "metric", "value")
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in targets.items() for x in pair]), F.col("metric"))
    return rows.select("metric", "value", wanted.alias("target")).where(F.col("value").isNotNull() & (F.col("value") < F.col("target")))


def extraction_metrics(rows: DataFrame) -> DataFrame:
    """One row of rates of gold rows with predictions: category, content and strength
    (a difference of 1 is fine), grounding, things rightly not stated, and precision and
    recall over sets of cues (gold_*, pred_*, pred_second, grounded)."""
    known = F.col("gold_category").isNotNull()
    hit = F.col("pred_category") == F.col("gold_category")
    second = hit | F.coalesce(F.col("pred_second") == F.col("gold_category"), F.lit(False))
    shared = F.sum(F.size(F.array_intersect("gold_cues", "pred_cues")))
    none = F.size("gold_cues") == 0
    return rows.agg(
        F.count("*").alias("n"), rate(F.count_if(known & hit), F.count_if(known)).alias("top1"), rate(F.count_if(known & second), F.count_if(known)).alias("top2"),
        rate(F.count_if(F.abs(F.col("gold_strength") - F.col("pred_strength")) <= 1), F.count("gold_strength")).alias("strength_within_one"),
        rate(F.count_if("grounded"), F.count("*")).alias("grounding"), rate(F.count_if(none & (F.size("pred_cues") == 0)), F.count_if(none)).alias("not_stated"),
        rate(shared, F.sum(F.size("pred_cues"))).alias("cue_precision"), rate(shared, F.sum(F.size("gold_cues"))).alias("cue_recall"),
    )


def area_review(verdicts: DataFrame, areas: DataFrame, top: int = 8, target: float = 4.0) -> DataFrame:
    """One row: mean coherence of the first areas by rank, how many of them have a
    verdict, and whether the target is met by a complete review."""
    first = areas.orderBy("rank").limit(top).join(verdicts, "area_id", "left")
    mean = F.round(F.avg("coherence"), 4)
    return first.agg(F.count("*").alias("n"), F.count("coherence").alias("reviewed"), mean.alias("coherence"), ((F.count("coherence") == F.count("*")) & (mean >= target)).alias("passed"))


def near_exemplars(texts: DataFrame, exemplars: DataFrame, threshold: float, n: int = 5) -> DataFrame:
    """``item_id, exemplar_id``: texts (item_id, words) that are near copies of exemplars
    (exemplar_id, words), by the Jaccard similarity of their shingles. Both sides may have
    any size: classes of equal sets that share a shingle in their prefixes are compared
    once (``similar``), and their members are paired at the end. Ids have 62 bits."""
    scratch, text = Scratch(texts.sparkSession, "exemplars"), similar.joined(F.col("words")).alias("text")
    both = texts.select((F.col("item_id") * 2).alias("item_id"), text).union(exemplars.select((F.col("exemplar_id") * 2 + 1).alias("item_id"), text))
    tokens, heads = similar.prefixes(both, threshold, n, scratch)
    odd = F.col("item_id").bitwiseAND(F.lit(1)) == 1
    of = tokens.groupBy("key", "cls").agg(F.max("size").alias("size"), F.max((~odd).cast("int")).alias("own"), F.max(odd.cast("int")).alias("exemplar"))
    of = scratch.write(of, "class-prefixes")
    met = of.alias("x").join(of.alias("y"), F.expr("x.key = y.key and x.cls < y.cls and (x.own + y.exemplar = 2 or x.exemplar + y.own = 2)"))
    met = met.where(similar.sized("x.size", "y.size", threshold)).select(F.col("x.cls").alias("ca"), F.col("y.cls").alias("cb")).distinct()
    found = scratch.write(similar.compared(met, heads, both, threshold, n, scratch).select("ca", "cb"), "found")
    members = heads.where(~odd).select(F.expr("item_id div 2").alias("item_id"), F.col("cls").alias("c"))
    known = heads.where(odd).select(F.expr("(item_id - 1) div 2").alias("exemplar_id"), F.col("cls").alias("e"))
    linked = found.select(F.col("ca").alias("l"), F.col("cb").alias("r")).union(found.select("cb", "ca"))
    equal = members.join(known, F.col("c") == F.col("e")).select("item_id", "exemplar_id")
    return equal.union(members.join(linked, F.col("c") == F.col("l")).join(known, F.col("r") == F.col("e")).select("item_id", "exemplar_id"))
