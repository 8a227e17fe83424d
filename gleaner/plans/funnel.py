"""Funnel, watermark, budget and freshness queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import funnel as f
from gleaner.plans.registry import query
from gleaner.session import table
from gleaner.sources import sheets

_B = r"(^|[^\p{L}\p{Mn}\p{Nd}\p{Pc}])(%s)($|[^\p{L}\p{Mn}\p{Nd}\p{Pc}])"
_INTENT, _FEATURE = ["idiot", "worthless"], ["the", "der", "les"]
_FUN = rf"""fn AS (SELECT doc_id AS item_id, source, n_chars >= 400 AS eligible,
  regexp_matches(lower(coalesce(text, '')), '{_B % 'worthless|idiot'}') OR ((1 + doc_id % 5) <= 3 AND regexp_matches(lower(coalesce(text, '')), '{_B % 'the|der|les'}')) AS a,
  (doc_id % 10) / 10.0 - 0.3 > 0.05 AS b FROM documents)"""


def _funnel(spark, sf_dir):
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        key.alias("item_id"), "source", (F.col("n_chars") >= 400).alias("eligible"), f.stage_a(F.col("text"), (1 + key % 5).cast("int"), _INTENT, _FEATURE).alias("a"),
        f.keep_margin((key % 10) / F.lit(10.0) - 0.3, 0.05).alias("b"),
    )


@query("stage_a_keywords", f"WITH {_FUN} SELECT item_id, a FROM fn")
def stage_a_keywords(spark, sf_dir):
    return _funnel(spark, sf_dir).select("item_id", "a")


@query("funnel_tallies", f"WITH {_FUN} SELECT source, count(*) AS n, count_if(eligible)::BIGINT AS eligible, count_if(eligible AND a)::BIGINT AS stage_a, count_if(eligible AND a AND b)::BIGINT AS stage_b FROM fn GROUP BY 1")
def funnel_tallies(spark, sf_dir):
    return f.tallies(_funnel(spark, sf_dir))


@query("audit_sample", f"WITH {_FUN}, r AS (SELECT item_id FROM fn WHERE a AND NOT b) SELECT item_id FROM r ORDER BY md5('audit:' || item_id), item_id LIMIT (SELECT round_even(count(*) * 0.05, 0)::BIGINT FROM r)")
def audit_sample(spark, sf_dir):
    return f.audit_ids(_funnel(spark, sf_dir).where("a and not b"), 0.05)


@query("since_watermark", "WITH l AS (SELECT event_type, max(ts) - INTERVAL 3 DAY AS since FROM events GROUP BY 1) SELECT event_id FROM events JOIN l USING (event_type) WHERE ts >= since")
def since_watermark(spark, sf_dir):
    return f.since_last(table(spark, sf_dir, "events"), "ts", "event_type", 3).select("event_id")


@query("budget_guard", "WITH r AS (SELECT user_id, event_id, sum(1 + event_id % 7) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM events) SELECT * FROM r WHERE running <= 40")
def budget_guard(spark, sf_dir):
    calls = table(spark, sf_dir, "events").select("user_id", "event_id", (1 + F.col("event_id") % 7).alias("cost"))
    return f.within_budget(calls, "cost", ["event_id"], 40, "user_id").select("user_id", "event_id", "running")


@query("fresh_work", "SELECT doc_id, lang FROM documents WHERE (doc_id, lang) NOT IN (SELECT doc_id, 'en' FROM labels)")
def fresh_work(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select("doc_id", F.lit("en").alias("lang"))
    return f.fresh_only(table(spark, sf_dir, "documents").select("doc_id", "lang"), done, ["doc_id", "lang"])


@query("known_pages", "SELECT page_id FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0)")
def known_pages(spark, sf_dir):
    """Pages that an incremental crawl still has to fetch."""
    known = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("page_id"))
    return table(spark, sf_dir, "pages").join(known, "page_id", "left_anti").select("page_id")


@query("review_sample", "WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('review:' || doc_id), doc_id) AS turn FROM documents) SELECT doc_id, source FROM r ORDER BY turn, source NULLS LAST, doc_id LIMIT 50")
def review_sample(spark, sf_dir):
    return f.round_robin(table(spark, sf_dir, "documents"), "source", 50, key="doc_id").select("doc_id", "source")


@query("sheet_mapping", r"""WITH k AS (SELECT doc_id, 'tab0:' || CASE WHEN doc_id % 3 = 0 THEN 'n' || (doc_id % 10) ELSE left(sha256(trim(coalesce(text, ''), ' ') || '|' || trim(coalesce(lang, ''), ' ')), 20) END AS k,
  CASE WHEN lang IN ('en', 'de') THEN 'west' WHEN starts_with(lower(lang), 'f') THEN 'forum' ELSE 'other' END AS platform, coalesce(lang NOT IN ('en', 'de') AND NOT starts_with(lower(lang), 'f'), false) AS is_unknown FROM documents)
SELECT doc_id, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY k) THEN k ELSE k || '~' || doc_id END AS raw_id, platform, is_unknown FROM k""")
def sheet_mapping(spark, sf_dir):
    """Documents as the rows of a tab: one in three has an id of its own, few of them distinct."""
    docs = table(spark, sf_dir, "documents")
    native = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("n"), F.col("doc_id") % 10))
    place, unknown = sheets.platform(F.col("lang"), {"en": "west", "de": "west"}, {"f": "forum"}, "other")
    keyed = sheets.row_keys(docs, F.lit("tab0"), native, [F.col("text"), F.col("lang")], "doc_id")
    return keyed.select("doc_id", "raw_id", place.alias("platform"), unknown.alias("is_unknown"))
