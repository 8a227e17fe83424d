"""Gold samples, metrics, model calls, clusters and streams with state."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import clusters as c
from gleaner.operators import evaluation as e
from gleaner.operators import model as m
from gleaner.operators.dedup import LONG
from gleaner.operators.funnel import audit_ids
from gleaner.plans.domain import EV, evidence
from gleaner.plans.funnel import _FUN, _funnel
from gleaner.plans.registry import query
from gleaner.plans.texts import _ITEMS, items
from gleaner.session import table
from gleaner.streaming import counts

_B = r"(^|[^\p{L}\p{Mn}\p{Nd}\p{Pc}])(%s)($|[^\p{L}\p{Mn}\p{Nd}\p{Pc}])"
_HAS = lambda words: f"regexp_matches(lower(coalesce(text, '')), '{_B % words}')"
_STR = f"""st AS (SELECT doc_id AS item_id, source, CASE WHEN {_HAS('the|der')} AND ({_HAS('of')} OR {_HAS('und')}) THEN 'likely_relevant' WHEN {_HAS('the|der')} OR ({_HAS('les')} AND 1 + doc_id % 5 <= 3) THEN 'borderline' ELSE 'likely_irrelevant' END AS stratum FROM documents)"""


def _strata(spark, sf_dir):
    key = F.col("doc_id")
    own = e.stratum(F.col("text"), (1 + key % 5).cast("int"), ["the", "der"], ["of"], ["und"], ["les"])
    return table(spark, sf_dir, "documents").select(key.alias("item_id"), "source", own.alias("stratum"))


@query("strata", f"WITH {_STR} SELECT item_id, stratum FROM st")
def strata(spark, sf_dir):
    return _strata(spark, sf_dir).select("item_id", "stratum")


@query("gold_sample", f"""WITH {_STR}, a AS (SELECT *, row_number() OVER (PARTITION BY stratum, source ORDER BY md5('gold:' || item_id), item_id) AS turn FROM st),
  b AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY turn, source NULLS LAST, item_id) AS place FROM a),
  d AS (SELECT *, (place > 12)::INT AS later FROM b ORDER BY later, CASE WHEN place > 12 THEN place ELSE 0 END, stratum, place LIMIT 50),
  f AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY place) AS among FROM d)
  SELECT item_id, stratum, source, row_number() OVER (ORDER BY among, stratum) <= 10 AS overlap FROM f""")
def gold_sample(spark, sf_dir):
    return e.gold_sample(_strata(spark, sf_dir), 50, 12, 10)


_GF = "gf AS (SELECT source, CASE quality WHEN 1 THEN 'relevant' ELSE CASE WHEN doc_id % 7 = 0 THEN 'ambiguous' ELSE 'not' END END AS gold, doc_id % 9 <> 0 AS a, doc_id % 5 <> 0 AS b, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'not' ELSE 'relevant' END AS c FROM documents JOIN labels USING (doc_id))"
_MET = """SELECT source, count(*) AS n, round(count_if(gold = 'relevant' AND a) / nullif(count_if(gold = 'relevant'), 0), 6) AS recall_a, round(count_if(gold = 'relevant' AND a AND b) / nullif(count_if(gold = 'relevant'), 0), 6) AS recall_ab,
  round(count_if(gold = 'relevant' AND coalesce(c = 'relevant', false)) / nullif(count_if(coalesce(c = 'relevant', false)), 0), 6) AS precision_c, round(count_if(gold = 'relevant' AND coalesce(c = 'relevant', false)) / nullif(count_if(gold = 'relevant' AND c IS NOT NULL), 0), 6) AS recall_c,
  round(count_if(gold = 'relevant' AND a AND b AND coalesce(c = 'relevant', false)) / nullif(count_if(gold = 'relevant'), 0), 6) AS end_to_end, count_if(a AND b AND c IS NULL)::BIGINT AS pending FROM gf WHERE gold <> 'ambiguous' GROUP BY GROUPING SETS ((source), ())"""


def _gold(spark, sf_dir):
    key = F.col("doc_id")
    own = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    gold = F.when(F.col("quality") == 1, "relevant").when(key % 7 == 0, "ambiguous").otherwise("not")
    said = F.when(key % 4 == 0, None).when(key % 3 == 0, "not").otherwise("relevant")
    return e.funnel_metrics(own.select("source", gold.alias("gold"), (key % 9 != 0).alias("a"), (key % 5 != 0).alias("b"), said.alias("c")))


@query("funnel_metrics", f"WITH {_GF} {_MET}")
def funnel_metrics(spark, sf_dir):
    return _gold(spark, sf_dir)


_TARGETS = {"recall_a": 0.95, "recall_ab": 0.9, "precision_c": 0.1, "recall_c": 0.85}


@query("target_gaps", f"WITH {_GF}, mt AS ({_MET}), u AS (UNPIVOT (SELECT recall_a, recall_ab, precision_c, recall_c FROM mt WHERE source IS NULL) ON recall_a, recall_ab, precision_c, recall_c INTO NAME metric VALUE value) SELECT metric, value, t AS target FROM u JOIN (VALUES {', '.join(f'({k!r}, {v}::DOUBLE)' for k, v in _TARGETS.items())}) x(k, t) ON metric = k WHERE value < t")
def target_gaps(spark, sf_dir):
    return e.target_gaps(_gold(spark, sf_dir), _TARGETS)


@query("extraction_metrics", """WITH r AS (SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN doc_id % 4 END AS gc, doc_id % 5 AS pc, doc_id % 3 AS ps, 1 + doc_id % 5 AS gs, 1 + doc_id % 4 AS pst, doc_id % 8 <> 0 AS grounded,
  list_distinct([doc_id % 3, doc_id % 7]) AS gq, list_distinct([doc_id % 3, doc_id % 5]) AS pq, doc_id % 10 = 0 AS empty FROM documents), x AS (SELECT *, CASE WHEN empty THEN [] ELSE gq END AS g, CASE WHEN doc_id % 20 = 0 THEN [] ELSE pq END AS p FROM r)
  SELECT count(*) AS n, round(count_if(gc IS NOT NULL AND pc = gc) / count(gc), 6) AS top1, round(count_if(gc IS NOT NULL AND (pc = gc OR ps = gc)) / count(gc), 6) AS top2, round(count_if(abs(gs - pst) <= 1) / count(gs), 6) AS strength_within_one,
  round(count_if(grounded) / count(*), 6) AS grounding, round(count_if(len(g) = 0 AND len(p) = 0) / count_if(len(g) = 0), 6) AS not_stated, round(sum(len(list_intersect(g, p))) / sum(len(p)), 6) AS cue_precision, round(sum(len(list_intersect(g, p))) / sum(len(g)), 6) AS cue_recall FROM x""")
def extraction_metrics(spark, sf_dir):
    key, none = F.col("doc_id"), F.array().cast("array<bigint>")
    return e.extraction_metrics(table(spark, sf_dir, "documents").select(
        F.when(key % 6 != 0, key % 4).alias("gold_category"), (key % 5).alias("pred_category"), (key % 3).alias("pred_second"), (1 + key % 5).alias("gold_strength"), (1 + key % 4).alias("pred_strength"), (key % 8 != 0).alias("grounded"),
        F.when(key % 10 == 0, none).otherwise(F.array_distinct(F.array(key % 3, key % 7))).alias("gold_cues"), F.when(key % 20 == 0, none).otherwise(F.array_distinct(F.array(key % 3, key % 5))).alias("pred_cues"),
    ))


@query("set_overlap", "WITH g AS (SELECT doc_id FROM labels WHERE quality = 1), p AS (SELECT doc_id FROM documents WHERE n_chars > 500) SELECT count(*) AS shared, (SELECT count(*) FROM g) AS n_gold, (SELECT count(*) FROM p) AS n_predicted FROM g JOIN p USING (doc_id)")
def set_overlap(spark, sf_dir):
    """Gold against predicted ids, by one full outer join."""
    gold = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(1).alias("g"))
    predicted = table(spark, sf_dir, "documents").where("n_chars > 500").select("doc_id", F.lit(1).alias("p"))
    return gold.join(predicted, "doc_id", "full_outer").agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("shared"), F.count("g").alias("n_gold"), F.count("p").alias("n_predicted"))


@query("stage_b_queue", f"WITH {_FUN}, r AS (SELECT item_id FROM fn WHERE a AND NOT b), au AS (SELECT item_id FROM r ORDER BY md5('audit:' || item_id), item_id LIMIT (SELECT round_even(count(*) * 0.05, 0)::BIGINT FROM r)) SELECT item_id, false AS audit FROM fn WHERE a AND b UNION ALL SELECT item_id, true FROM au")
def stage_b_queue(spark, sf_dir):
    """What goes to the model: the keepers, and the audit sample of the rejected."""
    own = _funnel(spark, sf_dir)
    return own.where("a and b").select("item_id", F.lit(False).alias("audit")).union(audit_ids(own.where("a and not b"), 0.05).select("item_id", F.lit(True)))


@query("relevance_rows", f"WITH {_FUN} SELECT item_id, CASE WHEN NOT a THEN 'A' WHEN NOT b THEN 'B' ELSE 'C' END AS stage, CASE WHEN a AND b THEN NULL ELSE 'not_retrieval' END AS label, CASE WHEN NOT a THEN 'no keyword' WHEN NOT b THEN 'margin not above 0.05' END AS rationale FROM fn")
def relevance_rows(spark, sf_dir):
    """A row for each item: where the funnel left it, and why."""
    own = _funnel(spark, sf_dir)
    stage = F.when(~F.col("a"), "A").when(~F.col("b"), "B").otherwise("C")
    return own.select("item_id", stage.alias("stage"), F.when(stage != "C", "not_retrieval").alias("label"), F.when(stage == "A", "no keyword").when(stage == "B", "margin not above 0.05").alias("rationale"))


@query("area_review", f"""WITH {EV}, ar AS (SELECT area_id, row_number() OVER (ORDER BY count(*) DESC, area_id) AS rank FROM ev GROUP BY 1), v AS (SELECT r_name AS area_id, 3 + r_regionkey % 3 AS coherence FROM region WHERE r_regionkey <> 2)
  SELECT count(*) AS n, count(coherence) AS reviewed, round(avg(coherence), 4) AS coherence, count(coherence) = count(*) AND round(avg(coherence), 4) >= 4 AS passed FROM ar LEFT JOIN v USING (area_id) WHERE rank <= 4""")
def area_review(spark, sf_dir):
    from pyspark.sql import Window

    areas = evidence(spark, sf_dir).groupBy("area_id").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "area_id")))
    verdicts = table(spark, sf_dir, "region").where("r_regionkey != 2").select(F.col("r_name").alias("area_id"), (3 + F.col("r_regionkey") % 3).alias("coherence"))
    return e.area_review(verdicts, areas.select("area_id", "rank"), top=4)


@query("near_exemplars", f"""WITH {_ITEMS}, lg AS (SELECT item_id, string_split(folded, ' ') AS w FROM it WHERE n_words >= 12), sx AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM lg), sh AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s FROM sx),
  sn AS (SELECT item_id, count(*) AS n FROM sh GROUP BY 1), b AS (SELECT x.item_id, y.item_id AS exemplar_id, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s WHERE y.item_id % 10 = 0 AND x.item_id % 10 <> 0 GROUP BY 1, 2)
  SELECT b.item_id, exemplar_id FROM b JOIN sn p ON p.item_id = b.item_id JOIN sn q ON q.item_id = exemplar_id WHERE k / (p.n + q.n - k) >= 0.7""")
def near_exemplars(spark, sf_dir):
    own = items(spark, sf_dir).where(F.col("n_words") >= LONG).select("item_id", "words")
    return e.near_exemplars(own.where("item_id % 10 != 0"), own.where("item_id % 10 = 0").withColumnRenamed("item_id", "exemplar_id"), 0.7)


def rule_client(texts):
    """Labels by a word; loses an answer in batches of more than five, as a model may."""
    out = [(i, "vague" if " der " in f" {x.lower()} " else "general", 0.9 if len(x) % 2 else 0.4) for i, x in enumerate(texts)]
    return out[:-1] if len(texts) > 5 else out


_LAB = "CASE WHEN contains(' ' || lower(coalesce(text, '')) || ' ', ' der ') THEN 'vague' ELSE 'general' END"
_CONF = "CASE WHEN length(coalesce(text, '')) % 2 = 1 THEN 0.9 ELSE 0.4 END"


def _asked(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")


@query("model_labels", f"SELECT doc_id AS item_id, {_LAB} AS label, {_CONF}::DOUBLE AS confidence FROM documents")
def model_labels(spark, sf_dir):
    """Batches with answers lost are halved until each text has its own."""
    return m.classify(_asked(spark, sf_dir), rule_client, 16, 20_000)


@query("cached_labels", f"SELECT doc_id AS item_id, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'general' ELSE {_LAB} END AS label, doc_id % 3 = 0 AND doc_id % 2 = 0 AS cached FROM documents WHERE text IN (SELECT text FROM documents GROUP BY 1 HAVING count(*) = 1)")
def cached_labels(spark, sf_dir):
    """Answers of the cache with a valid label are taken, others asked anew."""
    own = _asked(spark, sf_dir)
    single = own.groupBy("text").agg(F.count("*").alias("n"), F.min("item_id").alias("item_id")).where("n = 1 and text is not null").select("item_id", "text")
    cache = single.where("item_id % 3 = 0").select(m.call_key("m1", "p1", F.col("text")).alias("call_key"), F.when(F.col("item_id") % 2 == 0, "general").otherwise("broken").alias("label"), F.lit(0.5).alias("confidence"))
    return m.with_cache(single, cache, "m1", "p1", lambda df: m.classify(df, rule_client, 16, 20_000), ("vague", "general")).select("item_id", "label", "cached")


@query("escalated_labels", f"SELECT doc_id AS item_id, CASE WHEN length(coalesce(text, '')) > 2000 OR {_CONF} < 0.5 THEN 'large' ELSE 'small' END AS model, {_LAB} AS label FROM documents")
def escalated_labels(spark, sf_dir):
    own = _asked(spark, sf_dir)
    small = m.classify(own, rule_client, 16, 20_000)
    return m.escalate(own, small, lambda df: m.classify(df, rule_client, 4, 8_000), 0.5, 2000).select("item_id", "model", "label")


@query("cost_estimate", "WITH s AS (SELECT count(*) AS n, sum(greatest(1, length(coalesce(text, '')) // 4))::BIGINT AS own FROM documents) SELECT n, ceil(n / 25)::BIGINT AS calls, own + ceil(n / 25)::BIGINT * 900 AS tokens_in, n * 60 AS tokens_out, round(((own + ceil(n / 25)::BIGINT * 900) * 0.25 + n * 60 * 2.0) / 1e6, 6) AS usd FROM s")
def cost_estimate(spark, sf_dir):
    return m.cost(table(spark, sf_dir, "documents"), "text", 900, 60, 25, 0.25, 2.0)


@query("resolved_citations", "SELECT conv_id AS call_id, string_agg((conv_id * 100 + turn)::VARCHAR, ',' ORDER BY turn) AS items, 1::BIGINT AS unknown FROM conversations GROUP BY 1")
def resolved_citations(spark, sf_dir):
    """Names such as [3] in an answer, to the items that were listed under them."""
    turns = table(spark, sf_dir, "conversations")
    refs = turns.select(F.col("conv_id").alias("call_id"), F.concat(F.lit("["), F.col("turn").cast("string"), F.lit("]")).alias("ref"), (F.col("conv_id") * 100 + F.col("turn")).alias("item_id")).distinct()
    answers = refs.groupBy("call_id").agg(F.concat(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "ref"))), lambda x: x["ref"]), F.array(F.lit("[none]"))).alias("refs"))
    return m.cited(answers, refs).select("call_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"), "unknown")


_CL = "cl AS (SELECT vec_id, label % 4 AS cluster, label, embedding FROM embeddings)"


def _clustered(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") % 4).alias("cluster"), "label", F.col("embedding").alias("vector"))


@query("built_clusters", f"WITH {_CL}, n AS (SELECT cluster, label, count(*) AS n, min(vec_id) AS first FROM cl GROUP BY 1, 2), k AS (SELECT cluster, arg_min(label, (-n, first)) AS category, sum(n)::BIGINT AS size, min(first) AS first FROM n GROUP BY 1) SELECT row_number() OVER (ORDER BY size DESC, first)::INT - 1 AS cluster_id, size, category FROM k")
def built_clusters(spark, sf_dir):
    """Clusters numbered by size, with their majority category."""
    return c.build(_clustered(spark, sf_dir), "label").select("cluster_id", "size", "category")


@query("central_items", f"""WITH {_CL}, e AS (SELECT vec_id, cluster, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM cl), q AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY 1), u AS (SELECT e.vec_id, cluster, i, x / n AS x FROM e JOIN q USING (vec_id)),
  m AS (SELECT cluster, i, avg(x) AS x FROM u GROUP BY 1, 2), s AS (SELECT u.vec_id, u.cluster, sum(u.x * m.x) AS c FROM u JOIN m ON u.cluster = m.cluster AND u.i = m.i GROUP BY 1, 2) SELECT cluster, arg_min(vec_id, (-round(c, 9), vec_id)) AS vec_id FROM s GROUP BY 1""")
def central_items(spark, sf_dir):
    """The item nearest to each cluster's centre, whose text names the cluster."""
    return c.central(_clustered(spark, sf_dir)).select("cluster", "vec_id")


@query("sweep_grid")
def sweep_grid(spark, sf_dir):
    """Clusterings by several settings: noise, largest share, coherence (no SQL twin)."""
    own = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return c.sweep(own, [(5, 2), (10, 3), (20, 5)])


@query("stream_last_events", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def stream_last_events(spark, sf_dir):
    return counts.run_once(spark, counts.last_events(counts.event_stream(spark, sf_dir), "user_id"), ["user_id"], "update")


@query("stream_history", "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS last5 FROM r WHERE k <= 5 GROUP BY 1")
def stream_history(spark, sf_dir):
    """The last five entries of each key, kept as state."""
    return counts.run_once(spark, counts.histories(counts.event_stream(spark, sf_dir), "user_id", "event_id"), ["user_id"], "update")
