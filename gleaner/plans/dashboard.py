"""Dossiers, corrections, curation, banners and exports over the evidence items."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import text
from gleaner.operators import review as r
from gleaner.operators.filters import Filters
from gleaner.operators.funnel import since_last
from gleaner.plans.domain import EV, OV, evidence, overrides
from gleaner.plans.readside import FILTERS
from gleaner.plans.registry import query
from gleaner.plans.scoring import _SCORES
from gleaner.operators import scoring as s
from gleaner.session import table

_W = f"WITH {EV}"
_DEC = f"""WITH {EV}, {OV}, lastv AS (SELECT target_id, arg_max(value, override_id) AS v FROM ov WHERE field = 'view' GROUP BY 1), lastc AS (SELECT target_id, arg_max(value, override_id) AS v FROM ov WHERE field = 'click' GROUP BY 1),
  dec AS (SELECT ev.* EXCLUDE (category, relevance10), category AS ai_category, relevance10 AS ai_relevance10, CASE WHEN a.target_id IS NOT NULL THEN nullif(a.v, '') ELSE category END AS category,
  CASE WHEN b.target_id IS NOT NULL THEN try_cast(nullif(b.v, '') AS BIGINT) ELSE relevance10 END AS relevance10, a.target_id IS NOT NULL OR b.target_id IS NOT NULL AS corrected
  FROM ev LEFT JOIN lastv a ON author = a.target_id LEFT JOIN lastc b ON author = b.target_id)"""


def _log(spark, sf_dir):
    """Corrections whose numeric field is clicked in whole numbers."""
    return overrides(spark, sf_dir)


@query("analysis_window", f"{_W} SELECT area_id, count(*) AS n FROM ev WHERE NOT is_spam AND (day IS NULL OR day >= DATE '1998-01-01' - 365) GROUP BY 1")
def analysis_window(spark, sf_dir):
    own = evidence(spark, sf_dir).where(~F.col("is_spam") & r.in_window(F.col("day"), F.lit("1998-01-01").cast("date"), 365))
    return own.groupBy("area_id").agg(F.count("*").alias("n"))


@query("decorated_items", f"{_DEC} SELECT item_id, category, ai_category, relevance10, ai_relevance10, corrected FROM dec")
def decorated_items(spark, sf_dir):
    own = r.decorated(evidence(spark, sf_dir), "author", {"category": "view", "relevance10": "click"}, _log(spark, sf_dir))
    return own.select("item_id", "category", "ai_category", "relevance10", "ai_relevance10", "corrected")


@query("vague_floor", f"{_DEC} SELECT item_id FROM dec WHERE relevance10 >= 6")
def vague_floor(spark, sf_dir):
    own = r.decorated(evidence(spark, sf_dir), "author", {"relevance10": "click"}, _log(spark, sf_dir))
    return own.where(r.floor(F.col("relevance10"), 6)).select("item_id")


_EXPORT = Filters(sources=("BUILDING", "MACHINERY"), ratings=(1, 2, 3), min_confidence=20, categories=("cat1", "cat2", "cat3"))


@query("export_filter", f"""{_DEC} SELECT item_id, category FROM dec WHERE NOT is_spam AND source IN ('BUILDING', 'MACHINERY') AND (rating IN (1, 2, 3) OR rating IS NULL) AND category IN ('cat1', 'cat2', 'cat3')
  AND least(confidence100, relevance10 * 10) >= 20 AND relevance10 >= 2 AND frustration BETWEEN 2 AND 4""")
def export_filter(spark, sf_dir):
    return r.exported(evidence(spark, sf_dir), "author", _log(spark, sf_dir), _EXPORT, vague_min=2, severity=(2, 4)).select("item_id", "category")


@query("external_evidence", f"{_W} SELECT item_id, 'my aunt [name] in ' || platform AS quote FROM ev WHERE NOT high_stakes AND item_id % 6 <> 1")
def external_evidence(spark, sf_dir):
    own = evidence(spark, sf_dir).withColumn("quote", F.concat(F.lit("my aunt Mary in "), "platform")).withColumn("emotion", F.when(F.col("item_id") % 6 == 1, "sad_loss"))
    return r.external(own, ["quote"]).select("item_id", "quote")


@query("area_bundle", f"""{_W} SELECT area_id, count(*) AS items, count_if(retrieval_type = 'vague')::BIGINT AS vague_items, count_if(retrieval_type = 'general')::BIGINT AS general_items, round(count_if(retrieval_type = 'vague') / count(*), 4) AS vague_share,
  round(sum(relevance10) / count(relevance10), 4) AS mean_relevance, round(sum(CASE WHEN frustration > 0 THEN frustration END) / count(CASE WHEN frustration > 0 THEN 1 END), 4) AS mean_frustration, round(count_if(high_stakes) / count(*), 4) AS high_stakes_share,
  count(rating) AS rated_items, round(count_if(rating <= 2) / nullif(count(rating), 0), 4) AS low_rating_share, round(sum(strength) / count(strength), 4) AS mean_strength, sum(quantity)::BIGINT AS engagement, count(DISTINCT source) AS n_sources,
  count(DISTINCT platform) AS n_platforms, strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day FROM ev GROUP BY 1""")
def area_bundle(spark, sf_dir):
    return r.area_bundle(evidence(spark, sf_dir))


@query("top_cues", f"""{_W}, c AS (SELECT area_id, item_id, 'the ' || platform || '!' AS raw, lower(platform) AS value FROM ev), n AS (SELECT area_id, value, count(DISTINCT item_id) AS n FROM c GROUP BY 1, 2),
  k AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, value)::INT AS place FROM n) SELECT k.area_id, value, n, place, 'the ' || upper(value) || '!' AS examples FROM k WHERE place <= 3""")
def top_cues(spark, sf_dir):
    raw = F.concat(F.lit("the "), "platform", F.lit("!"))
    return r.top_values(evidence(spark, sf_dir), text.normalize_cue(raw), raw, k=3)


@query("ordered_counter", f"{_W}, n AS (SELECT area_id, coalesce(category, 'unknown') AS value, count(*) AS n FROM ev GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, value)::INT AS place FROM n")
def ordered_counter(spark, sf_dir):
    return r.ordered_counts(evidence(spark, sf_dir), "area_id", F.coalesce("category", F.lit("unknown")))


@query("breakdown_order", f"""{_W}, n AS (SELECT area_id, coalesce(category, 'not_stated') AS value, count(*) AS n FROM ev GROUP BY 1, 2)
  SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY CASE value WHEN 'cat5' THEN 1 WHEN 'cat2' THEN 2 WHEN 'cat7' THEN 3 ELSE 4 END, n DESC, value)::INT AS place FROM n""")
def breakdown_order(spark, sf_dir):
    """Stages in the order of the journey, others after them."""
    return r.ordered_counts(evidence(spark, sf_dir), "area_id", F.coalesce("category", F.lit("not_stated")), ["cat5", "cat2", "cat7"])


@query("area_dossier", f"""{_W}, m AS (SELECT * FROM ev WHERE area_id = 'ASIA' AND NOT is_spam) SELECT 'source' AS facet, source AS value, count(*) AS n FROM m GROUP BY 2 UNION ALL SELECT 'platform', platform, count(*) FROM m GROUP BY 2
  UNION ALL SELECT 'category', coalesce(category, 'unknown'), count(*) FROM m GROUP BY 2 UNION ALL SELECT 'retrieval', retrieval_type, count(*) FROM m GROUP BY 2 UNION ALL SELECT 'match_count', '', count(*) FROM m""")
def area_dossier(spark, sf_dir):
    """All counters of one area from one reading of its members."""
    own = evidence(spark, sf_dir).where("area_id = 'ASIA' and not is_spam")
    facets = {"source": F.col("source"), "platform": F.col("platform"), "category": F.coalesce("category", F.lit("unknown")), "retrieval": F.col("retrieval_type"), "match_count": F.lit("")}
    rows = own.select(F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), v.alias("value")) for k, v in facets.items()])).alias("f"))
    return rows.groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


@query("dossier_quotes", f"{_W} SELECT item_id, strength FROM ev WHERE area_id = 'ASIA' AND NOT is_spam AND retrieval_type = 'vague' ORDER BY strength DESC, item_id LIMIT 8")
def dossier_quotes(spark, sf_dir):
    return evidence(spark, sf_dir).where("area_id = 'ASIA' and not is_spam and retrieval_type = 'vague'").orderBy(F.desc("strength"), "item_id").limit(8).select("item_id", "strength")


_LOG = f"lg AS (SELECT event_id AS override_id, user_id % 20 AS target_id, event_type AS field, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'v' || (event_id % 6) END AS value, ts AS created_at FROM events)"


def _curation_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.lit("v"), (F.col("event_id") % 6).cast("string")))
    return e.select(F.col("event_id").alias("override_id"), (F.col("user_id") % 20).alias("target_id"), F.col("event_type").alias("field"), value.alias("value"), F.col("ts").alias("created_at"))


@query("curation_replay", f"WITH {_LOG}, k AS (SELECT *, row_number() OVER (PARTITION BY target_id, field ORDER BY created_at DESC, override_id DESC) AS n FROM lg WHERE field IN ('view', 'click')) SELECT target_id, field, value FROM k WHERE n = 1 AND value <> ''")
def curation_replay(spark, sf_dir):
    return r.curation(_curation_log(spark, sf_dir), ["view", "click"])


@query("split_areas", f"WITH {_LOG} SELECT 'oa-' || left(sha256(target_id || '|' || override_id || '|' || value), 8) AS area_id, target_id, len(string_split(value, ','))::INT AS n FROM lg WHERE field = 'view'")
def split_areas(spark, sf_dir):
    return r.splits(_curation_log(spark, sf_dir), "view").select("area_id", "target_id", F.size("clusters").alias("n"))


_STG = """st AS (SELECT 'run-' || (event_id % 40) AS run_id, event_type AS stage, CASE WHEN event_id % 40 = 7 THEN 'running' WHEN event_id % 11 = 0 THEN 'failed' WHEN event_id % 13 = 0 THEN 'partial' ELSE 'success' END AS status, ts AS started_at,
  CASE WHEN event_id % 11 = 0 THEN 'error ' || event_id END AS error FROM events)"""


def _stages(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    status = F.when(key % 40 == 7, "running").when(key % 11 == 0, "failed").when(key % 13 == 0, "partial").otherwise("success")
    return e.select(F.concat(F.lit("run-"), (key % 40).cast("string")).alias("run_id"), F.col("event_type").alias("stage"), status.alias("status"), F.col("ts").alias("started_at"), F.when(key % 11 == 0, F.concat(F.lit("error "), key.cast("string"))).alias("error"))


@query("run_banner", f"""WITH {_STG}, p AS (SELECT 'run-3' AS run_id, min(ts) + INTERVAL 1 DAY AS since FROM events), n AS (SELECT st.run_id, max(started_at) AS newest, bool_or(status = 'running') AS running, bool_or(status IN ('failed', 'partial')) AS failed FROM st, p WHERE st.run_id <> p.run_id AND started_at > p.since GROUP BY 1)
  SELECT run_id, CASE WHEN running THEN 'running' WHEN failed THEN 'failed' ELSE 'running' END AS kind FROM n ORDER BY newest DESC, run_id DESC LIMIT 1""")
def run_banner(spark, sf_dir):
    pointer = table(spark, sf_dir, "events").agg((F.min("ts") + F.expr("interval 1 day")).alias("published_at")).withColumn("run_id", F.lit("run-3"))
    return r.banner(_stages(spark, sf_dir), pointer)


@query("first_errors", f"WITH {_STG} SELECT run_id, left(arg_min(error, (started_at, stage)), 300) AS error FROM st WHERE error IS NOT NULL GROUP BY 1")
def first_errors(spark, sf_dir):
    return r.first_error(_stages(spark, sf_dir))


@query("parent_statuses", f"WITH {_STG} SELECT run_id, CASE WHEN count_if(status = 'failed') = count(*) THEN 'failed' WHEN count_if(status IN ('failed', 'partial')) > 0 THEN 'partial' ELSE 'success' END AS status FROM st GROUP BY 1")
def parent_statuses(spark, sf_dir):
    return r.parent_status(_stages(spark, sf_dir))


@query("verdict_rows", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'area_id is missing;' ELSE '' END || CASE WHEN o_orderkey % 9 IN (0, 6, 7, 8) THEN 'coherence is not 1 to 5;' ELSE '' END
  || CASE WHEN o_orderstatus = 'P' THEN 'decision is unknown;' ELSE '' END AS problems FROM orders""")
def verdict_rows(spark, sf_dir):
    """Rows of a filled-in review sheet with what is wrong in each."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(key % 5 == 0, " ").otherwise("a").alias("area_id"), F.when(key % 9 == 6, "six").otherwise((key % 9).cast("string")).alias("coherence"), F.col("o_orderstatus").alias("decision"))
    checked = r.checked_rows(rows, ["area_id"], {"coherence": (1, 5)}, {"decision": ("o", "f")})
    return checked.select("o_orderkey", F.concat_ws("", F.transform("problems", lambda p: F.concat(p, F.lit(";")))).alias("problems"))


@query("stamped_export", f"{_W} SELECT item_id, area_id, 'run-1' AS run_id, '2024-01-01' AS exported_on, 'vague only' AS filters FROM ev WHERE retrieval_type = 'vague' AND NOT is_spam")
def stamped_export(spark, sf_dir):
    own = evidence(spark, sf_dir).where("retrieval_type = 'vague' and not is_spam").select("item_id", "area_id")
    return r.stamped(own, run_id="run-1", exported_on="2024-01-01", filters="vague only")


@query("quality_snapshot", f"""{_W} SELECT count(*) AS items, count_if(confidence100 < 40)::BIGINT AS low_confidence, count_if(strength < 2)::BIGINT AS ungrounded, sum(quantity)::BIGINT AS tokens,
  (SELECT count(*) FROM events WHERE event_type = 'view') AS overrides, (SELECT strftime(max(ts), '%Y-%m-%d') FROM events) AS last_ingest FROM ev""")
def quality_snapshot(spark, sf_dir):
    own = evidence(spark, sf_dir).agg(F.count("*").alias("items"), F.count_if(F.col("confidence100") < 40).alias("low_confidence"), F.count_if(F.col("strength") < 2).alias("ungrounded"), F.sum("quantity").alias("tokens"))
    log = table(spark, sf_dir, "events").agg(F.count_if(F.col("event_type") == "view").alias("overrides"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_ingest"))
    return own.join(log)  # one row by one row


@query("insight_summary", f"""{_W} SELECT 'category' AS facet, coalesce(category, 'none') AS value, count(*) AS n, count_if(coalesce(confidence100 < 40, false))::BIGINT AS n_low FROM ev GROUP BY 2 UNION ALL SELECT 'platform', platform, count(*), count_if(coalesce(confidence100 < 40, false))::BIGINT FROM ev GROUP BY 2
  UNION ALL SELECT 'strength', strength::VARCHAR, count(*), count_if(coalesce(confidence100 < 40, false))::BIGINT FROM ev GROUP BY 2""")
def insight_summary(spark, sf_dir):
    facets = {"category": F.coalesce("category", F.lit("none")), "platform": F.col("platform"), "strength": F.col("strength").cast("string")}
    rows = evidence(spark, sf_dir).select("confidence100", F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), v.alias("value")) for k, v in facets.items()])).alias("f"))
    return rows.groupBy("f.facet", "f.value").agg(F.count("*").alias("n"), F.count_if(F.col("confidence100") < 40).alias("n_low"))


_REL = "rel AS (SELECT doc_id, quality, toxic FROM labels)"


@query("extraction_scope", f"WITH {_REL} SELECT d.doc_id, quality FROM documents d JOIN rel USING (doc_id) WHERE quality = 1 AND trim(coalesce(text, '')) <> ''")
def extraction_scope(spark, sf_dir):
    """Items whose label is in scope and that have text, for extraction."""
    rel = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", "quality")
    return table(spark, sf_dir, "documents").where(F.trim(F.coalesce("text", F.lit(""))) != "").select("doc_id").join(rel, "doc_id")


@query("review_rows", f"{_W} SELECT item_id, source, category, n_name AS place, confidence100 FROM ev JOIN nation ON platform = n_name LEFT JOIN (SELECT DISTINCT user_id FROM events) u ON author = u.user_id WHERE confidence100 < 10")
def review_rows(spark, sf_dir):
    own = evidence(spark, sf_dir).where("confidence100 < 10")
    places = table(spark, sf_dir, "nation").select(F.col("n_name").alias("place"))
    seen = table(spark, sf_dir, "events").select("user_id").distinct()
    return own.join(places, F.col("platform") == F.col("place")).join(seen, F.col("author") == F.col("user_id"), "left").select("item_id", "source", "category", "place", "confidence100")


@query("low_confidence_items", f"{_W} SELECT item_id, confidence100, category, source, platform, o_orderpriority AS link FROM ev JOIN orders ON item_id = o_orderkey WHERE confidence100 < 50 ORDER BY confidence100, item_id LIMIT 30")
def low_confidence_items(spark, sf_dir):
    best = evidence(spark, sf_dir).where("confidence100 < 50").orderBy("confidence100", "item_id").limit(30)
    links = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_k"), F.col("o_orderpriority").alias("link"))
    return links.join(F.broadcast(best), F.col("item_id") == F.col("_k")).select("item_id", "confidence100", "category", "source", "platform", "link")


@query("evidence_star", f"""WITH {EV}, {OV}, rel AS (SELECT target_id, count(*) AS n FROM ov GROUP BY 1), p AS (SELECT 'run-1' AS run_id) SELECT item_id, p.run_id, r_regionkey AS area_key, n_nationkey AS place_key, rel.n AS n_corrections, l.n_lines AS n_insights FROM ev JOIN p ON true
  JOIN region ON area_id = r_name JOIN nation ON platform = n_name LEFT JOIN rel ON author = rel.target_id LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) l ON item_id = l_orderkey WHERE NOT is_spam""")
def evidence_star(spark, sf_dir):
    """Published evidence from its six tables; dimensions are broadcast by their size."""
    region = table(spark, sf_dir, "region").select(F.col("r_name").alias("area_id"), F.col("r_regionkey").alias("area_key"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("platform"), F.col("n_nationkey").alias("place_key"))
    rel = overrides(spark, sf_dir).groupBy(F.col("target_id").alias("author")).agg(F.count("*").alias("n_corrections"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.count("*").alias("n_insights"))
    own = evidence(spark, sf_dir).where("not is_spam").select("item_id", "area_id", "platform", "author").withColumn("run_id", F.lit("run-1"))
    met = own.join(region, "area_id").join(nation, "platform").join(rel, "author", "left").join(lines, "item_id", "left")
    return met.select("item_id", "run_id", "area_key", "place_key", "n_corrections", "n_insights")


@query("export_evidence", f"{_W} SELECT ev.item_id, ev.area_id, count(l_orderkey) AS n_insights FROM ev JOIN region ON area_id = r_name LEFT JOIN lineitem ON l_orderkey = ev.item_id AND l_returnflag = 'R' GROUP BY 1, 2")
def export_evidence(spark, sf_dir):
    own = evidence(spark, sf_dir).select("item_id", "area_id").join(table(spark, sf_dir, "region").select(F.col("r_name").alias("area_id")), "area_id")
    found = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.count("*").alias("n"))
    return own.join(found, "item_id", "left").select("item_id", "area_id", F.coalesce("n", F.lit(0)).alias("n_insights"))


@query("evidence_scan", f"{_W} SELECT source, count_if(strength > 1)::BIGINT AS useful, count_if(strength <= 1)::BIGINT AS skipped FROM ev WHERE NOT is_spam GROUP BY 1")
def evidence_scan(spark, sf_dir):
    """What clustering takes and what it passes over."""
    useful = F.col("strength") > 1
    return evidence(spark, sf_dir).where("not is_spam").groupBy("source").agg(F.count_if(useful).alias("useful"), F.count_if(~useful).alias("skipped"))


@query("taxonomy_check", f"""{_W}, tax AS (SELECT 'cat' || i AS category FROM range(0, 12) t(i)) SELECT tax.category, count(item_id) AS n_items, count(DISTINCT area_id) AS n_areas FROM tax LEFT JOIN ev USING (category) GROUP BY 1""")
def taxonomy_check(spark, sf_dir):
    """Every category of the taxonomy, those without items too."""
    names = spark.createDataFrame([(f"cat{i}",) for i in range(12)], "category string")
    counts = evidence(spark, sf_dir).groupBy("category").agg(F.count("*").alias("n_items"), F.countDistinct("area_id").alias("n_areas"))
    return names.join(counts, "category", "left").fillna(0, ["n_items", "n_areas"])


@query("radar_rows", f"WITH {_SCORES}, u AS (UNPIVOT (SELECT area_id, {', '.join(s.DIMENSIONS)} FROM sc) ON {', '.join(s.DIMENSIONS)} INTO NAME dimension VALUE score) SELECT area_id, dimension, score FROM u")
def radar_rows(spark, sf_dir):
    """One row for each corner of the chart."""
    scores = s.area_scores(evidence(spark, sf_dir).where("not is_spam"))
    return scores.unpivot(["area_id"], list(s.DIMENSIONS), "dimension", "score")


@query("score_inputs", f"WITH {_SCORES} SELECT area_id, n_items, 'Composite of ' || n_items || ' items: severity ' || printf('%.2f', severity) AS explanation FROM sc")
def score_inputs(spark, sf_dir):
    """The sentence under each score."""
    scores = s.area_scores(evidence(spark, sf_dir).where("not is_spam"))
    said = F.format_string("Composite of %d items: severity %.2f", "n_items", "severity")
    return scores.select("area_id", "n_items", said.alias("explanation"))


@query("named_areas", f"""WITH {_LOG}, a AS (SELECT DISTINCT area_id, dense_rank() OVER (ORDER BY area_id) AS k FROM (SELECT r_name AS area_id FROM region)), l AS (SELECT target_id, arg_max(value, override_id) AS v FROM lg WHERE field = 'view' GROUP BY 1)
  SELECT area_id, coalesce(nullif(v, ''), CASE WHEN k % 2 = 0 THEN 'model ' || lower(area_id) END, 'heuristic ' || area_id) AS name, CASE WHEN coalesce(v, '') <> '' THEN 'pm' WHEN k % 2 = 0 THEN 'llm' ELSE 'heuristic' END AS named_by FROM a LEFT JOIN l ON k = target_id""")
def named_areas(spark, sf_dir):
    """Names by who gave them: a reviewer before the model before the heuristic."""
    from pyspark.sql import Window

    areas = table(spark, sf_dir, "region").select(F.col("r_name").alias("area_id")).withColumn("k", F.row_number().over(Window.orderBy("area_id")))
    log = _curation_log(spark, sf_dir).where("field = 'view'").groupBy("target_id").agg(F.max_by("value", "override_id").alias("v"))
    met = areas.join(log, F.col("k") == F.col("target_id"), "left")
    pm, llm = F.nullif("v", F.lit("")), F.when(F.col("k") % 2 == 0, F.concat(F.lit("model "), F.lower("area_id")))
    return met.select("area_id", F.coalesce(pm, llm, F.concat(F.lit("heuristic "), "area_id")).alias("name"), F.when(pm.isNotNull(), "pm").when(llm.isNotNull(), "llm").otherwise("heuristic").alias("named_by"))


@query("embedding_texts", "SELECT conv_id, turn, trim(CASE WHEN turn % 2 = 0 THEN coalesce(text, '') || ' ' ELSE '' END || CASE WHEN turn % 3 = 0 THEN 'Looking for: ' || role || ' ' ELSE '' END || 'Breaks at: t' || turn) AS text FROM conversations")
def embedding_texts(spark, sf_dir):
    """Problem, goal and breakdown in one text, without those that are missing."""
    turn = F.col("turn")
    parts = [F.when(turn % 2 == 0, F.coalesce("text", F.lit(""))), F.when(turn % 3 == 0, F.concat(F.lit("Looking for: "), "role")), F.concat(F.lit("Breaks at: t"), turn.cast("string"))]
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.trim(F.concat_ws(" ", *parts)).alias("text"))


@query("filters_round_trip", f"{_W} SELECT count(*) AS n FROM ev WHERE NOT is_spam AND source IN ('BUILDING', 'MACHINERY') AND day >= DATE '1993-01-01' AND (rating IN (1, 2, 3) OR rating IS NULL) AND least(confidence100, relevance10 * 10) >= 20")
def filters_round_trip(spark, sf_dir):
    """Filters written as a key and read back select the same items."""
    return evidence(spark, sf_dir).where(Filters.from_key(FILTERS.key()).evidence()).agg(F.count("*").alias("n"))


@query("recent_events", "SELECT event_id FROM events JOIN (SELECT event_type, max(ts) - INTERVAL 1 DAY AS since FROM events GROUP BY 1) USING (event_type) WHERE ts >= since")
def recent_events(spark, sf_dir):
    return since_last(table(spark, sf_dir, "events"), "ts", "event_type", 1).select("event_id")
