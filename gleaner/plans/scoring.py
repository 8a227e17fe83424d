"""Scoring, ranking and sensitivity over the evidence items."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import scoring as s
from gleaner.plans.domain import EV, evidence
from gleaner.plans.registry import query

_V = EV + ", vg AS (SELECT * FROM ev WHERE NOT is_spam AND retrieval_type = 'vague'), it AS (SELECT * FROM ev WHERE NOT is_spam)"
_CAP = _V + """, lim AS (SELECT *, greatest(1, floor(count(*) OVER (PARTITION BY area_id) * 0.1))::BIGINT AS day_limit,
  row_number() OVER (PARTITION BY area_id, day ORDER BY item_id) AS rn FROM vg),
capd AS (SELECT *, (day IS NULL OR rn <= day_limit) AS kept FROM lim)"""
_SHARE = _CAP + """, k AS (SELECT * FROM capd WHERE kept),
corp AS (SELECT source, count(*) AS n_source FROM k GROUP BY 1),
own AS (SELECT area_id, source, count(*) AS n FROM k GROUP BY 1, 2),
grid AS (SELECT a.area_id, c.source, c.n_source, coalesce(o.n, 0) AS n FROM (SELECT DISTINCT area_id FROM k) a CROSS JOIN corp c
  LEFT JOIN own o ON o.area_id = a.area_id AND o.source = c.source)"""
_SEV = """, sv AS (SELECT area_id, coalesce(sum(CASE WHEN frustration > 0 THEN frustration END) / count(CASE WHEN frustration > 0 THEN 1 END), 0.0) AS intensity,
  count_if(high_stakes) / count(*) AS stakes, count_if(rating <= 2) / nullif(count(rating), 0) AS low_share FROM it GROUP BY 1),
svs AS (SELECT *, round_even(least(5.0, greatest(1.0, CASE WHEN low_share IS NULL THEN 0.625::DOUBLE * intensity + 0.375::DOUBLE * 5 * stakes ELSE 0.5::DOUBLE * intensity + 0.3::DOUBLE * 5 * stakes + 0.2::DOUBLE * 5 * low_share END)) * 100, 0) / 100 AS severity FROM sv)"""
_FIT = """, fitr AS (SELECT area_id, sum(relevance10) / (10 * count(*)) AS relevance, count_if(retrieval_type = 'vague') / count(*) AS vague_share FROM it GROUP BY 1),
fit AS (SELECT *, round_even(least(5.0, greatest(1.0, 5 * relevance * vague_share)) * 100, 0) / 100 AS strategic_fit FROM fitr)"""
_EQ = """, eqr AS (SELECT area_id, avg(strength) AS mean_strength, count(DISTINCT platform) AS platforms, count(*) AS n_items FROM it GROUP BY 1),
eq AS (SELECT *, round_even(least(5.0, greatest(1.0, 0.4::DOUBLE * mean_strength + 0.3::DOUBLE * 5 * least(platforms, 4) / 4 + 0.3::DOUBLE * 5 * CASE WHEN n_items < 2 THEN 0.0 ELSE least(1.0, ln(n_items) / ln(50.0)) END)) * 100, 0) / 100 AS evidence_quality FROM eqr)"""
_ENG = """, eng AS (SELECT area_id, 1 + 0.15 * avg(ln(1 + least(quantity, 200)) / ln(201.0)) AS factor FROM vg GROUP BY 1)"""
_FREQ = _ENG + """, shr AS (SELECT area_id, avg(n / n_source) AS balanced, sum(n) AS n_capped FROM grid GROUP BY 1),
adj AS (SELECT shr.area_id, round((0.5 * n_capped / sum(n_capped) OVER () + 0.5 * balanced) * factor, 9) AS adjusted FROM shr JOIN eng USING (area_id)),
frq AS (SELECT area_id, adjusted, CASE WHEN count(*) OVER () = 1 THEN 3.0 WHEN count(*) OVER () >= 5 THEN
    1 + 4 * (rank() OVER (ORDER BY adjusted) - 1 + (count(*) OVER (PARTITION BY adjusted) - 1) / 2) / (count(*) OVER () - 1)
    ELSE 1.0 + (adjusted >= 0.02)::INT + (adjusted >= 0.05)::INT + (adjusted >= 0.1)::INT + (adjusted >= 0.2)::INT END AS frequency FROM adj)"""
_RUB = """, rb AS (SELECT area_id, CASE WHEN count(DISTINCT category) >= 8 THEN 4.0 WHEN count(DISTINCT category) >= 4 THEN 3.0 ELSE 2.0 END AS product_leverage,
  round_even(least(5.0, greatest(1.0, 1 + 4 * (count_if(retrieval_type = 'vague') / count(*)))) * 100, 0) / 100 AS research_value FROM it GROUP BY 1)"""
_SCORES = _SHARE + _SEV + _FIT + _EQ + _FREQ + _RUB + """, sc AS (SELECT area_id, n_items, (round_even(frequency::DOUBLE * 100, 0) / 100)::DOUBLE AS frequency, severity::DOUBLE AS severity, strategic_fit::DOUBLE AS strategic_fit,
  evidence_quality::DOUBLE AS evidence_quality, product_leverage::DOUBLE AS product_leverage, research_value::DOUBLE AS research_value
  FROM frq JOIN svs USING (area_id) JOIN fit USING (area_id) JOIN eq USING (area_id) JOIN rb USING (area_id))"""


def _ranked(ties: str, weights: tuple[float, ...] = (0.2, 0.2, 0.2, 0.2, 0.1, 0.1)) -> str:
    w = dict(zip(s.DIMENSIONS, weights, strict=True))
    total = " + ".join(f"{v}::DOUBLE * {k}" for k, v in w.items())
    return f"WITH {_SCORES}, cp AS (SELECT *, round_even(({total}) * 100, 0) / 100 AS composite, (n_items < 10 OR evidence_quality < 2.5) AS low_evidence FROM sc) SELECT area_id, n_items, {', '.join(s.DIMENSIONS)}, composite, CASE WHEN composite >= 3.8 THEN 'High' WHEN composite >= 3.0 THEN 'Medium' ELSE 'Low' END AS band, low_evidence, row_number() OVER (ORDER BY low_evidence, composite DESC, {ties})::INT AS rank FROM cp"


def _items(spark, sf_dir):
    return evidence(spark, sf_dir).where("not is_spam")


@query("day_cap_kept", f"WITH {_CAP} SELECT area_id, strftime(day, '%Y-%m-%d') AS day, count_if(kept)::BIGINT AS n_kept, count_if(NOT kept)::BIGINT AS n_dropped FROM capd GROUP BY 1, 2")
def day_cap_kept(spark, sf_dir):
    capped = s.cap_by_day(_items(spark, sf_dir).where("retrieval_type = 'vague'"))
    return capped.groupBy("area_id", F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept")).alias("n_dropped"))


@query("source_balanced_share", f"WITH {_SHARE} SELECT area_id, source, n, n_source, round(n / n_source, 9) AS share FROM grid")
def source_balanced_share(spark, sf_dir):
    capped = s.cap_by_day(_items(spark, sf_dir).where("retrieval_type = 'vague'")).where("kept")
    return s.source_shares(capped).withColumn("share", F.round("share", 9)).select("area_id", "source", "n", "n_source", "share")


@query("engagement_factor", f"WITH {_V}{_ENG} SELECT area_id, round(factor, 6) AS factor FROM eng")
def engagement_factor(spark, sf_dir):
    return s.engagement(_items(spark, sf_dir).where("retrieval_type = 'vague'"), 200, 0.15).withColumn("factor", F.round("factor", 6))


@query("frequency_quantile", f"WITH {_SHARE}{_FREQ} SELECT area_id, round(adjusted, 6) AS adjusted, frequency::DOUBLE AS frequency FROM frq")
def frequency_quantile(spark, sf_dir):
    return s.frequency(_items(spark, sf_dir).where("retrieval_type = 'vague'")).withColumn("adjusted", F.round("adjusted", 6))


@query("severity_score", f"WITH {_V}{_SEV} SELECT area_id, round(intensity, 6) AS intensity, round(stakes, 6) AS stakes, round(low_share, 6) AS low_share, round(severity, 6) AS severity FROM svs")
def severity_score(spark, sf_dir):
    return s.severity(s.area_sums(_items(spark, sf_dir))).select("area_id", *[F.round(c, 6).alias(c) for c in ("intensity", "stakes", "low_share", "severity")])


@query("strategic_fit", f"WITH {_V}{_FIT} SELECT area_id, round(relevance, 6) AS relevance, round(vague_share, 6) AS vague_share, round(strategic_fit, 6) AS strategic_fit FROM fit")
def strategic_fit(spark, sf_dir):
    return s.strategic_fit(s.area_sums(_items(spark, sf_dir))).select("area_id", *[F.round(c, 6).alias(c) for c in ("relevance", "vague_share", "strategic_fit")])


@query("evidence_quality", f"WITH {_V}{_EQ} SELECT area_id, platforms, n_items, round(evidence_quality, 6) AS evidence_quality FROM eq")
def evidence_quality(spark, sf_dir):
    return s.evidence_quality(s.area_sums(_items(spark, sf_dir))).select("area_id", "platforms", "n_items", F.round("evidence_quality", 6).alias("evidence_quality"))


@query("composite_rank", f"SELECT area_id, composite, band, low_evidence, rank FROM ({_ranked('evidence_quality DESC, n_items DESC, area_id')})")
def composite_rank(spark, sf_dir):
    return s.rank_areas(s.area_scores(_items(spark, sf_dir)), s.WEIGHTS).select("area_id", "composite", "band", "low_evidence", "rank")


@query("opportunity_ranking", _ranked("evidence_quality DESC, n_items DESC, area_id"))
def opportunity_ranking(spark, sf_dir):
    return s.rank_areas(s.area_scores(_items(spark, sf_dir)), s.WEIGHTS)


_LIVE = {"frequency": 0.4, "severity": 0.1, "strategic_fit": 0.1, "evidence_quality": 0.2, "product_leverage": 0.1, "research_value": 0.1}


@query("live_rank", f"SELECT area_id, composite, rank FROM ({_ranked('n_items DESC, area_id', tuple(_LIVE.values()))})")
def live_rank(spark, sf_dir):
    """Re-rank under other weights; ties by the number of matching items."""
    return s.rank_areas(s.area_scores(_items(spark, sf_dir)), _LIVE, (F.desc("n_items"), F.asc("area_id"))).select("area_id", "composite", "rank")


@query("export_rank", f"SELECT area_id, composite, rank FROM ({_ranked('area_id')})")
def export_rank(spark, sf_dir):
    return s.rank_areas(s.area_scores(_items(spark, sf_dir)), s.WEIGHTS, (F.asc("area_id"),)).select("area_id", "composite", "rank")


def _sensitivity_sql() -> str:
    rows = []
    for name in s.WEIGHTS:
        for sign in (1, -1):
            own = s.normalize_weights(s.WEIGHTS | {name: s.WEIGHTS[name] * (1 + sign * 0.2)})
            rows.append(f"('{name}{'+' if sign > 0 else '-'}', " + ", ".join(f"{own[d]!r}::DOUBLE" for d in s.DIMENSIONS) + ")")
    names = ", ".join(f"w_{d}" for d in s.DIMENSIONS)
    total = " + ".join(f"w_{d} * {d}" for d in s.DIMENSIONS)
    return f"""WITH {_SCORES}, wt(scenario, {names}) AS (VALUES {', '.join(rows)}),
    p AS (SELECT scenario, area_id, row_number() OVER (PARTITION BY scenario ORDER BY (n_items < 10 OR evidence_quality < 2.5), round_even(({total}) * 100, 0) / 100 DESC, evidence_quality DESC, n_items DESC, area_id) AS place FROM sc, wt)
    SELECT scenario, string_agg(area_id, ',' ORDER BY place) AS top3 FROM p WHERE place <= 3 GROUP BY 1"""


@query("weight_sensitivity", _sensitivity_sql())
def weight_sensitivity(spark, sf_dir):
    return s.sensitivity(s.area_scores(_items(spark, sf_dir)), s.WEIGHTS)
