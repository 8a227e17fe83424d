"""Published views, filters, pages, overrides, run log and quality."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.operators import filters as f
from gleaner.operators import scoring as s
from gleaner.plans.domain import EV, OV, evidence, overrides
from gleaner.plans.registry import query
from gleaner.plans.scoring import _SCORES
from gleaner.scratch import Scratch
from gleaner.session import table

_W = f"WITH {EV}"
FILTERS = f.Filters(sources=("BUILDING", "MACHINERY"), since=date(1993, 1, 1), ratings=(1, 2, 3), min_confidence=20)
_FSQL = "NOT is_spam AND source IN ('BUILDING', 'MACHINERY') AND day >= DATE '1993-01-01' AND (rating IN (1, 2, 3) OR rating IS NULL) AND least(confidence100, relevance10 * 10) >= 20"


@query("source_trend", f"{_W} SELECT strftime(day, '%Y-%m') AS month, source, count(*) AS n FROM ev WHERE NOT is_spam AND day IS NOT NULL GROUP BY 1, 2")
def source_trend(spark, sf_dir):
    own = evidence(spark, sf_dir).where("not is_spam and day is not null")
    return own.groupBy(F.date_format("day", "yyyy-MM").alias("month"), "source").agg(F.count("*").alias("n"))


@query("source_trend_dense", f"""{_W}, t AS (SELECT strftime(day, '%Y-%m') AS month, source, count(*) AS n FROM ev WHERE NOT is_spam AND day IS NOT NULL GROUP BY 1, 2)
  SELECT m.month, s.source, coalesce(t.n, 0) AS n FROM (SELECT DISTINCT month FROM t) m CROSS JOIN (SELECT DISTINCT source FROM t) s LEFT JOIN t ON t.month = m.month AND t.source = s.source""")
def source_trend_dense(spark, sf_dir):
    """Month by source with zeros: the grid of both, and what is there."""
    trend = Scratch(spark, "trend").write(source_trend(spark, sf_dir), "trend")
    grid = trend.select("month").distinct().join(trend.select("source").distinct())  # months by sources: the rows of a chart
    return grid.join(trend, ["month", "source"], "left").fillna(0, ["n"])


@query("overview_funnel", f"""{_W} SELECT (SELECT count(*) FROM orders) AS raw, count(*) AS items, count_if(NOT is_spam)::BIGINT AS ready,
  count_if(NOT is_spam AND retrieval_type <> 'not')::BIGINT AS retrieval, count_if(NOT is_spam AND retrieval_type = 'vague')::BIGINT AS vague,
  count(DISTINCT CASE WHEN NOT is_spam THEN area_id END) AS areas FROM ev""")
def overview_funnel(spark, sf_dir):
    ok = ~F.col("is_spam")
    own = evidence(spark, sf_dir).agg(
        F.count("*").alias("items"), F.count_if(ok).alias("ready"), F.count_if(ok & (F.col("retrieval_type") != "not")).alias("retrieval"),
        F.count_if(ok & (F.col("retrieval_type") == "vague")).alias("vague"), F.countDistinct(F.when(ok, F.col("area_id"))).alias("areas"),
    )
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("raw")).join(own)


@query("category_counts", f"""WITH {EV}, {OV}, last AS (SELECT target_id, arg_max(value, override_id) AS v FROM ov WHERE field = 'view' GROUP BY 1)
  SELECT coalesce(nullif(v, ''), category, 'unknown') AS category, count(*) AS n FROM ev LEFT JOIN last ON author = target_id WHERE NOT is_spam GROUP BY 1""")
def category_counts(spark, sf_dir):
    latest = f.latest_overrides(overrides(spark, sf_dir))
    own = f.corrected(evidence(spark, sf_dir).where("not is_spam"), "author", "category", "view", latest)
    return own.groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(F.count("*").alias("n"))


@query("published_areas", f"""WITH {_SCORES} SELECT sc.area_id, n_items, severity, p.run_id FROM sc JOIN (SELECT 'run-1' AS run_id) p ON true""")
def published_areas(spark, sf_dir):
    """Scores of the one published run: the pointer is a one-row table."""
    pointer = spark.createDataFrame([("run-1",)], "run_id string")
    runs = s.area_scores(evidence(spark, sf_dir).where("not is_spam")).withColumn("run_id", F.explode(F.array(F.lit("run-0"), F.lit("run-1"))))
    return runs.join(F.broadcast(pointer), "run_id").select("area_id", "n_items", "severity", "run_id")


@query("published_evidence", f"""WITH {EV}, {OV}, rel AS (SELECT target_id, count(*) AS n_over FROM ov GROUP BY 1)
  SELECT item_id, ev.area_id, source, platform, strftime(day, '%Y-%m-%d') AS day, n_over FROM ev JOIN region ON area_id = r_name LEFT JOIN rel ON author = target_id WHERE retrieval_type = 'vague' AND NOT is_spam""")
def published_evidence(spark, sf_dir):
    areas = table(spark, sf_dir, "region").select(F.col("r_name").alias("area_id"))
    corrected = overrides(spark, sf_dir).groupBy("target_id").agg(F.count("*").alias("n_over"))
    own = evidence(spark, sf_dir).where("retrieval_type = 'vague' and not is_spam")
    met = own.join(areas, "area_id").join(corrected, F.col("author") == F.col("target_id"), "left")
    return met.select("item_id", "area_id", "source", "platform", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_over")


@query("area_match_counts", f"{_W} SELECT area_id, count(*) AS n, count_if(retrieval_type = 'vague')::BIGINT AS n_vague FROM ev WHERE {_FSQL} GROUP BY 1")
def area_match_counts(spark, sf_dir):
    return evidence(spark, sf_dir).where(FILTERS.evidence()).groupBy("area_id").agg(F.count("*").alias("n"), F.count_if(F.col("retrieval_type") == "vague").alias("n_vague"))


@query("filtered_evidence_page", f"{_W} SELECT item_id, area_id, strftime(day, '%Y-%m-%d') AS day, rating FROM ev WHERE {_FSQL} ORDER BY day DESC NULLS LAST, item_id LIMIT 25 OFFSET 50")
def filtered_evidence_page(spark, sf_dir):
    own = f.page(evidence(spark, sf_dir).where(FILTERS.evidence()), [F.desc_nulls_last("day"), F.asc("item_id")], 3, 25)
    return own.select("item_id", "area_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "rating")


@query("evidence_search", "SELECT doc_id, source, lang FROM documents WHERE lower(coalesce(text, '')) LIKE '%idiot%' OR lower(coalesce(source, '')) LIKE '%idiot%'")
def evidence_search(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(f.search(["text", "source"], "Idiot")).select("doc_id", "source", "lang")


@query("low_confidence_top30", f"{_W} SELECT item_id, confidence100, source FROM ev WHERE confidence100 < 60 ORDER BY confidence100, item_id LIMIT 30")
def low_confidence_top30(spark, sf_dir):
    return evidence(spark, sf_dir).where("confidence100 < 60").orderBy("confidence100", "item_id").limit(30).select("item_id", "confidence100", "source")


@query("distinct_languages", "SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL")
def distinct_languages(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("lang is not null").select("lang").distinct()


@query("latest_override", f"WITH {OV} SELECT target_id, field, arg_max(value, override_id) AS value, max(override_id) AS override_id FROM ov GROUP BY 1, 2")
def latest_override(spark, sf_dir):
    return f.latest_overrides(overrides(spark, sf_dir))


@query("override_facet", f"""WITH {EV}, {OV}, last AS (SELECT target_id, arg_max(value, override_id) AS v FROM ov WHERE field = 'click' GROUP BY 1)
  SELECT item_id, coalesce(nullif(v, ''), category) AS category FROM ev LEFT JOIN last ON author = target_id WHERE coalesce(nullif(v, ''), category) IN ('cat1', 'cat2')""")
def override_facet(spark, sf_dir):
    own = f.corrected(evidence(spark, sf_dir), "author", "category", "click", f.latest_overrides(overrides(spark, sf_dir)))
    return own.where(F.col("category").isin("cat1", "cat2")).select("item_id", "category")


@query("hidden_items", f"WITH {EV}, {OV} SELECT item_id FROM ev WHERE author NOT IN (SELECT target_id FROM ov WHERE field = 'error')")
def hidden_items(spark, sf_dir):
    """Items whose author was not marked: an anti-join, ids are never null."""
    marked = overrides(spark, sf_dir).where("field = 'error'").select(F.col("target_id").alias("author"))
    return evidence(spark, sf_dir).join(marked, "author", "left_anti").select("item_id")


@query("quality_report", """SELECT source, count(*) AS n, round(median(length(text)), 6) AS median_length, round(avg((text IS NULL)::INT), 6) AS missing_text,
  min(doc_id) AS first_id, max(doc_id) AS last_id, count(DISTINCT lang) AS n_langs FROM documents GROUP BY 1""")
def quality_report(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.round(F.median(F.length("text")), 6).alias("median_length"), F.round(F.avg(F.col("text").isNull().cast("int")), 6).alias("missing_text"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.countDistinct("lang").alias("n_langs"),
    )


_LOG = "log AS (SELECT user_id AS run_id, event_type AS stage, ts AS started, event_id AS seq, value FROM events)"


def _log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), F.col("ts").alias("started"), F.col("event_id").alias("seq"), "value")


@query("run_log_summary", f"""WITH {_LOG} SELECT run_id, count(*) AS n_stages, count_if(stage = 'error')::BIGINT AS n_errors, round(sum(value), 4) AS cost, date_diff('second', min(started), max(started)) AS wall_s,
  arg_max(stage, seq) AS last_stage FROM log GROUP BY 1""")
def run_log_summary(spark, sf_dir):
    seconds = F.unix_seconds(F.date_trunc("second", F.max("started"))) - F.unix_seconds(F.date_trunc("second", F.min("started")))
    return _log(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("n_stages"), F.count_if(F.col("stage") == "error").alias("n_errors"), F.round(F.sum("value"), 4).alias("cost"), seconds.alias("wall_s"), F.max_by("stage", "seq").alias("last_stage"))


@query("purge_plan", f"""WITH {_LOG}, runs AS (SELECT run_id, min(started) AS first FROM log GROUP BY 1), pub AS (SELECT max(run_id) AS run_id FROM log)
  SELECT run_id, strftime(first, '%Y-%m-%d') AS first_day FROM runs WHERE first < TIMESTAMP '2024-01-02 00:00:00' AND run_id NOT IN (SELECT run_id FROM pub)""")
def purge_plan(spark, sf_dir):
    """Runs that began before the cutoff, but not the published one."""
    log = _log(spark, sf_dir)
    runs = log.groupBy("run_id").agg(F.min("started").alias("first")).where(F.col("first") < F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return runs.join(log.agg(F.max("run_id").alias("run_id")), "run_id", "left_anti").select("run_id", F.date_format("first", "yyyy-MM-dd").alias("first_day"))


@query("latest_stage", f"WITH {_LOG} SELECT stage, arg_max(run_id, seq) AS run_id, max(seq) AS seq FROM log GROUP BY 1")
def latest_stage(spark, sf_dir):
    first = Window.partitionBy("stage").orderBy(F.desc("seq"))
    return _log(spark, sf_dir).withColumn("n", F.row_number().over(first)).where("n = 1").select("stage", "run_id", "seq")


@query("semi_in_scope", f"{_W} SELECT DISTINCT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT author FROM ev WHERE retrieval_type IN ('vague', 'general'))")
def semi_in_scope(spark, sf_dir):
    scoped = evidence(spark, sf_dir).where(F.col("retrieval_type").isin("vague", "general")).select(F.col("author").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(scoped, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("anti_pending", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_pending(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("left_outer_relevance", "SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def left_outer_relevance(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")


@query("set_union_candidates", "SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1")
def set_union_candidates(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return labels.where("quality = 0").select("doc_id").union(labels.where("toxic = 1").select("doc_id")).distinct()


@query("set_except_ids", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_except_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("set_intersect_ids", "SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM documents WHERE lang = 'en'")
def set_intersect_ids(spark, sf_dir):
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").intersect(table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id"))


@query("spend_since", f"WITH {_LOG} SELECT stage, round(sum(value), 4) AS spend, count(*) AS n FROM log WHERE started >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1")
def spend_since(spark, sf_dir):
    return _log(spark, sf_dir).where(F.col("started") >= F.lit("2024-01-15 00:00:00").cast("timestamp")).groupBy("stage").agg(F.round(F.sum("value"), 4).alias("spend"), F.count("*").alias("n"))
