"""Reviews and threads as they come from their sources, corrections and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import curated
from gleaner.plans.dashboard import _LOG, _STG, _curation_log, _stages
from gleaner.plans.registry import query
from gleaner.scratch import Scratch
from gleaner.session import table
from gleaner.sources import cards, reviews


@query("store_reviews", "WITH r AS (SELECT event_id % 300 AS id, 'c' || (user_id % 5) AS country, strftime(ts, '%Y-%m-%d') AS at_, event_id FROM events) SELECT 'v' || id AS review_id, string_agg(DISTINCT country, ',' ORDER BY country) AS countries, arg_min(event_id, (country, event_id))::VARCHAR AS score FROM r GROUP BY id")
def store_reviews(spark, sf_dir):
    """Reviews that several countries show, each once with its countries."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.concat(F.lit("v"), (F.col("event_id") % 300).cast("string")).alias("review_id"), F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("country"), F.col("event_id").cast("int").alias("page"),
        F.date_format("ts", "yyyy-MM-dd").alias("at"), F.col("event_id").cast("string").alias("score"), F.lit("x").alias("content"))
    return reviews.one_per_review(rows).select("review_id", F.array_join("countries", ",").alias("countries"), "score")


@query("thread_replies", """WITH p AS (SELECT DISTINCT conv_id AS thread_id, role AS author, turn AS at_, coalesce(text, '') AS body, CASE WHEN role = 'assistant' THEN 'expert' ELSE 'user' END AS role FROM conversations WHERE turn > 0),
  f AS (SELECT conv_id AS thread_id, min(role) AS first_author FROM conversations WHERE turn = 0 GROUP BY 1), k AS (SELECT p.*, CASE WHEN author IS NOT DISTINCT FROM first_author THEN 'op_followup' WHEN role = 'expert' THEN 'expert' ELSE 'user' END AS kind FROM p JOIN f USING (thread_id)),
  n AS (SELECT *, row_number() OVER (PARTITION BY thread_id, kind = 'op_followup' ORDER BY at_, author, body) AS n FROM k) SELECT thread_id, kind, row_number() OVER (PARTITION BY thread_id ORDER BY at_, author, body)::INT AS place FROM n WHERE n <= 2""")
def thread_replies(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    first = turns.where("turn = 0").groupBy(F.col("conv_id").alias("thread_id")).agg(F.min("role").alias("first_author"))
    posts = turns.where("turn > 0").select(F.col("conv_id").alias("thread_id"), F.col("role").alias("author"), F.when(F.col("role") == "assistant", "expert").otherwise("user").alias("role"), F.col("turn").alias("at"), F.coalesce("text", F.lit("")).alias("body"))
    return reviews.typed_replies(posts.join(first, "thread_id"), 2).select("thread_id", "kind", "place")


@query("thread_list", "SELECT page_id, page_id % 3 + 1 AS thread_id, 0 AS place FROM pages UNION ALL SELECT page_id, 70, 1 FROM pages")
def thread_list(spark, sf_dir):
    key = (F.col("page_id") % 3 + 1).cast("string")
    html = F.concat(F.lit('<a href="/thread/'), key, F.lit('">x</a><a href="/thread/70"></a><a href="/thread/'), key, F.lit('?h"></a>'))
    return reviews.thread_list(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "html").select("page_id", F.col("thread_id").cast("long").alias("thread_id"), "place")


@query("appended_corrections", f"WITH {_LOG}, a AS (SELECT target_id, field, value, override_id FROM lg UNION ALL SELECT 3, 'view', 'fixed', 1000000000) SELECT target_id, field, arg_max(value, override_id) AS value FROM a GROUP BY 1, 2")
def appended_corrections(spark, sf_dir):
    """A correction is one more row of the log; the last one of a field counts."""
    scratch = Scratch(spark, "log")
    path = scratch.place("log")
    log = _curation_log(spark, sf_dir).select("target_id", "field", "value", "override_id")
    log.write.parquet(path)
    spark.createDataFrame([(3, "view", "fixed", 1_000_000_000)], "target_id long, field string, value string, override_id long").write.mode("append").parquet(path)
    now = spark.read.schema("target_id long, field string, value string, override_id long").parquet(path)
    return now.groupBy("target_id", "field").agg(F.max_by("value", "override_id").alias("value"))


@query("latest_cluster_run", f"WITH {_STG} SELECT run_id FROM st WHERE stage = 'view' AND status IN ('success', 'partial') AND run_id <> 'run-5' AND run_id IN (SELECT DISTINCT run_id FROM st WHERE stage = 'click') ORDER BY started_at DESC, run_id DESC LIMIT 1")
def latest_cluster_run(spark, sf_dir):
    """The newest usable run of a stage that wrote rows of another."""
    own = _stages(spark, sf_dir)
    wrote = own.where("stage = 'click'").select("run_id").distinct()
    usable = own.where("stage = 'view' and status in ('success', 'partial') and run_id != 'run-5'").join(wrote, "run_id", "left_semi")
    return usable.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1).select("run_id")


@query("review_cards", r"""SELECT doc_id::VARCHAR AS review_id, 'T' || doc_id AS title, trim(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g')) AS content, (1 + doc_id % 5)::INT AS rating, source AS author FROM documents""")
def review_cards(spark, sf_dir):
    """Pages that show each text twice, cut in the list and whole in a dialog, read back."""
    d = table(spark, sf_dir, "documents").withColumn("plain", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z0-9]+", " ")))
    card = lambda text: F.concat(
        F.format_string('<div aria-labelledby="review-%d-title"><h3>T%d</h3><ol aria-label="%d Stars"></ol>', "doc_id", "doc_id", 1 + F.col("doc_id") % 5),
        F.coalesce(F.concat(F.lit('<p class="author">'), "source", F.lit("</p>")), F.lit("")), F.lit('<p class="content">'), text, F.lit("</p></div>"),
    )
    pages = d.select("doc_id", F.concat(card(F.substring("plain", 1, 20)), F.lit("<dialog>"), card(F.col("plain")), F.lit("</dialog>")).alias("html"))
    return cards.review_cards(pages, "doc_id").select("review_id", "title", "content", "rating", "author")


_CURATED = [("a1", "merge", "a2"), ("a2", "merge", "a5"), ("a3", "merge", "a4"), ("a4", "merge", "a3"), ("a6", "status", "archived"), ("a0", "name", "zero"), ("a1", "name", "one")]


@query("curated_areas", """WITH k AS (SELECT n_nationkey::VARCHAR AS cluster_id, n_regionkey AS category, count(c_custkey) AS size, 'a' || (n_nationkey % 12) AS home FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
  h AS (SELECT *, CASE WHEN home IN ('a1', 'a2') THEN 'a5' ELSE home END AS area_id FROM k), w AS (SELECT area_id, category, sum(size) AS w, max(size) AS largest FROM h GROUP BY 1, 2),
  c AS (SELECT area_id, arg_max(category, (w, largest, -category)) AS category FROM w GROUP BY 1), a AS (SELECT area_id, string_agg(cluster_id, ',' ORDER BY size DESC, cluster_id) AS clusters, sum(size)::BIGINT AS size FROM h GROUP BY 1)
  SELECT area_id, clusters, category, size, CASE area_id WHEN 'a6' THEN 'archived' ELSE 'active' END AS status, CASE area_id WHEN 'a0' THEN 'zero' END AS name, CASE area_id WHEN 'a5' THEN 'a1,a2' ELSE '' END AS merged_from, NULL AS merged_into FROM a JOIN c USING (area_id)
  UNION ALL SELECT home, '', category, 0, 'merged', CASE home WHEN 'a1' THEN 'one' END, '', area_id FROM (SELECT DISTINCT home, area_id FROM h WHERE home <> area_id) JOIN c USING (area_id)""")
def curated_areas(spark, sf_dir):
    """Nations as clusters, dealt to areas that corrections merge, name and archive."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("size"))
    clusters = n.join(c, "n_nationkey", "left").select(F.col("n_nationkey").cast("string").alias("cluster_id"), F.col("n_regionkey").alias("category"), F.coalesce("size", F.lit(0)).alias("size"), F.concat(F.lit("a"), (F.col("n_nationkey") % 12).cast("string")).alias("area_id"))
    own = curated.areas(clusters, spark.createDataFrame(_CURATED, "target_id string, field string, value string"), 10)
    return own.select("area_id", F.array_join("clusters", ",").alias("clusters"), "category", "size", "status", "name", F.array_join("merged_from", ",").alias("merged_from"), "merged_into")
