"""Area aggregates, vectors, evaluation, upserts, sources and streaming."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.operators import areas as a
from gleaner.operators import tables as t
from gleaner.operators import vectors as v
from gleaner.plans.domain import EV, evidence
from gleaner.plans.registry import query
from gleaner.scratch import Scratch
from gleaner.session import table
from gleaner.sources import pages as html
from gleaner.streaming import counts

_W = f"WITH {EV}"


@query("cue_counts_per_item", "SELECT n_name AS area_id, l_shipmode AS value, count(*) AS n FROM (SELECT DISTINCT n_name, l_orderkey, l_returnflag || l_linestatus AS l_shipmode FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2")
def cue_counts_per_item(spark, sf_dir):
    """Flags of an order's lines are its cues; each counts once per order."""
    cues = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("cues"))
    items = evidence(spark, sf_dir).select("item_id", F.col("platform").alias("area_id"))
    return a.counts_per_item(items.join(cues, "item_id"), "cues")


@query("dominant_breakdown", f"""{_W}, n AS (SELECT area_id, category, count(*) AS n, min(item_id) AS first FROM ev WHERE category IS NOT NULL AND category <> 'cat0' GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY n DESC, first) AS k FROM n) SELECT area_id, category, n FROM r WHERE k = 1""")
def dominant_breakdown(spark, sf_dir):
    return a.dominant(evidence(spark, sf_dir), "category", "cat0")


@query("majority_category", f"""{_W}, n AS (SELECT source, category, sum(quantity) AS n, min(item_id) AS first FROM ev WHERE category IS NOT NULL GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, first) AS k FROM n) SELECT source, category, n::BIGINT AS n FROM r WHERE k = 1""")
def majority_category(spark, sf_dir):
    """Size-weighted majority."""
    n = evidence(spark, sf_dir).where("category is not null").groupBy("source", "category").agg(F.sum("quantity").alias("n"), F.min("item_id").alias("first"))
    return n.groupBy("source").agg(F.max_by(F.struct("category", "n"), F.struct("n", -F.col("first"))).alias("b")).select("source", "b.category", "b.n")


@query("attempt_examples", f"""{_W}, s AS (SELECT area_id, category, author, min(item_id) AS first FROM ev WHERE category IS NOT NULL GROUP BY 1, 2, 3),
  p AS (SELECT *, row_number() OVER (PARTITION BY area_id, category ORDER BY first) AS k FROM s)
  SELECT area_id, category, string_agg(author::VARCHAR, ',' ORDER BY k) AS examples FROM p WHERE k <= 3 GROUP BY 1, 2""")
def attempt_examples(spark, sf_dir):
    return a.first_examples(evidence(spark, sf_dir), "category", "author")


@query("engagement_sums", f"{_W} SELECT area_id, 'quantity' AS key, sum(quantity)::BIGINT AS total FROM ev GROUP BY 1 UNION ALL SELECT area_id, 'lines', sum(n_lines)::BIGINT FROM ev GROUP BY 1")
def engagement_sums(spark, sf_dir):
    own = evidence(spark, sf_dir).select("area_id", F.explode(F.create_map(F.lit("quantity"), "quantity", F.lit("lines"), "n_lines")).alias("key", "n"))
    return own.groupBy("area_id", "key").agg(F.sum("n").alias("total"))


@query("diverse_top_k", f"""{_W}, c AS (SELECT item_id, area_id, source, quantity AS score FROM ev WHERE NOT is_spam), h AS (SELECT *, row_number() OVER (PARTITION BY area_id, source ORDER BY score DESC, item_id) > 1 AS later FROM c),
  n AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY later, score DESC, item_id) AS k FROM h)
  SELECT area_id, item_id, source, score, row_number() OVER (PARTITION BY area_id ORDER BY score DESC, item_id)::INT AS place FROM n WHERE k <= 12""")
def diverse_top_k(spark, sf_dir):
    own = evidence(spark, sf_dir).where("not is_spam").select("item_id", "area_id", "source", F.col("quantity").alias("score"))
    return a.diverse_top(own, 12).select("area_id", "item_id", "source", "score", "place")


@query("pack_batches")
def pack_batches(spark, sf_dir):
    """Greedy batches of at most 8 texts and 12,000 characters in each source."""
    own = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("item_id"), F.length("text").alias("size"))
    return a.pack(own, "size", 8, 12_000, "source")


_E = "SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, 65)) AS i FROM embeddings"
_CENT = f"e AS ({_E}), m AS (SELECT label, i, avg(x) AS x FROM e GROUP BY 1, 2), nn AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY 1), ce AS (SELECT m.label, i, x / n AS x FROM m JOIN nn USING (label))"


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@query("centroids", f"WITH {_CENT} SELECT label, i::INT AS i, round(x, 5) AS x FROM ce")
def centroids(spark, sf_dir):
    own = v.centroids(_vectors(spark, sf_dir), "label", "embedding")
    return own.select("label", F.posexplode("centroid").alias("i", "x")).select("label", (F.col("i") + 1).alias("i"), F.round("x", 5).alias("x"))


@query("cluster_coherence", f"""WITH {_CENT}, q AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY 1), d AS (SELECT e.vec_id, e.label, sum(e.x * ce.x) AS d FROM e JOIN ce ON ce.label = e.label AND ce.i = e.i GROUP BY 1, 2)
  SELECT label, round(avg(d / n), 5) AS coherence, count(*) AS n FROM d JOIN q USING (vec_id) GROUP BY 1""")
def cluster_coherence(spark, sf_dir):
    own = _vectors(spark, sf_dir)
    met = own.join(v.centroids(own, "label", "embedding"), "label")
    return met.groupBy("label").agg(F.round(F.avg(v.cosine(F.col("embedding"), F.col("centroid"))), 5).alias("coherence"), F.count("*").alias("n"))


@query("cosine_topk_prior", f"""WITH e0 AS ({_E}), h AS (SELECT vec_id % 2 AS half, label, i, avg(x) AS x FROM e0 GROUP BY 1, 2, 3), n AS (SELECT half, label, sqrt(sum(x * x)) AS n FROM h GROUP BY 1, 2),
  c AS (SELECT h.half, h.label, i, x / n AS x FROM h JOIN n ON n.half = h.half AND n.label = h.label),
  s AS (SELECT a.label AS new_id, b.label AS prior_id, round(sum(a.x * b.x), 6) AS similarity FROM c a JOIN c b ON a.half = 1 AND b.half = 0 AND a.i = b.i GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY similarity DESC, prior_id) AS k FROM s) SELECT new_id, prior_id FROM r WHERE k = 1 AND similarity >= 0.3""")
def cosine_topk_prior(spark, sf_dir):
    own = _vectors(spark, sf_dir)
    half = lambda k: v.centroids(own.where(F.col("vec_id") % 2 == k), "label", "embedding").select(F.col("label").alias("id"), "centroid")
    return v.nearest_prior(half(1), half(0), 0.3).select("new_id", "prior_id")


@query("similarity_margin", f"""WITH e AS ({_E}), q AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY 1), u AS (SELECT e.vec_id, label, i, x / n AS x FROM e JOIN q USING (vec_id)),
  ex AS (SELECT * FROM u WHERE vec_id < 40), s AS (SELECT u.vec_id, ex.vec_id AS k, sum(u.x * ex.x) AS c FROM u JOIN ex ON u.i = ex.i GROUP BY 1, 2)
  SELECT vec_id AS id, round(max(CASE WHEN k < 20 THEN c END) - max(CASE WHEN k >= 20 THEN c END), 5) AS margin FROM s GROUP BY 1""")
def similarity_margin(spark, sf_dir):
    own = _vectors(spark, sf_dir).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return v.margins(own, own.where("id < 20"), own.where("id >= 20 and id < 40")).select("id", F.round("margin", 5).alias("margin"))


@query("density_clusters")
def density_clusters(spark, sf_dir):
    """Density clusters within each label's vectors (no SQL twin)."""

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        points = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
        points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
        return pd.DataFrame({"vec_id": frame["vec_id"], "label": frame["label"], "cluster": v.density_labels(points, 10, 3)})

    # labels are few and each takes long: ranges of a given number are not put together again
    apart = _vectors(spark, sf_dir).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "label")
    return apart.groupBy("label").applyInPandas(cluster, "vec_id long, label int, cluster long")


_GOLD = "g AS (SELECT d.doc_id, source, quality AS gold, toxic AS pred FROM documents d JOIN labels l USING (doc_id))"


def _gold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source", F.col("quality").alias("gold"), F.col("toxic").alias("pred"))


@query("gold_funnel_metrics", f"""WITH {_GOLD} SELECT coalesce(source, 'all') AS source, count(*) AS n, count_if(gold = 1)::BIGINT AS positives, round(count_if(gold = 1 AND pred = 1) / nullif(count_if(gold = 1), 0), 6) AS recall,
  round(count_if(gold = 1 AND pred = 1) / nullif(count_if(pred = 1), 0), 6) AS precision_ FROM g GROUP BY GROUPING SETS ((source), ())""")
def gold_funnel_metrics(spark, sf_dir):
    """Recall and precision by source and over all, in one grouping."""
    hit = F.count_if((F.col("gold") == 1) & (F.col("pred") == 1))
    own = _gold(spark, sf_dir).groupingSets([["source"], []], "source").agg(
        F.count("*").alias("n"), F.count_if(F.col("gold") == 1).alias("positives"), F.round(hit / F.nullif(F.count_if(F.col("gold") == 1), F.lit(0)), 6).alias("recall"),
        F.round(hit / F.nullif(F.count_if(F.col("pred") == 1), F.lit(0)), 6).alias("precision_"),
    )
    return own.select(F.coalesce("source", F.lit("all")).alias("source"), "n", "positives", "recall", "precision_")


@query("confusion_matrix", f"WITH {_GOLD} SELECT gold, pred, count(*) AS n FROM g GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return _gold(spark, sf_dir).groupBy("gold", "pred").agg(F.count("*").alias("n"))


@query("label_agreement", f"WITH {_GOLD} SELECT count(*) AS n, count_if(gold = pred)::BIGINT AS same, round(count_if(gold = pred) / count(*), 6) AS agreement FROM g")
def label_agreement(spark, sf_dir):
    same = F.count_if(F.col("gold") == F.col("pred"))
    return _gold(spark, sf_dir).agg(F.count("*").alias("n"), same.alias("same"), F.round(same / F.count("*"), 6).alias("agreement"))


@query("stratified_sample_counts", "WITH s AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY md5('7:' || doc_id), doc_id) AS k FROM documents) SELECT lang, source, count(*) AS n FROM s WHERE k <= 3 GROUP BY 1, 2")
def stratified_sample_counts(spark, sf_dir):
    """A seeded sample of three of each language and source."""
    order = Window.partitionBy("lang", "source").orderBy(F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string"))), "doc_id")
    own = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").withColumn("k", F.row_number().over(order)).where("k <= 3")
    return own.groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("upsert_classify", """WITH s AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, md5(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 4 <> 1)
  SELECT coalesce(s.doc_id, b.doc_id) AS doc_id, CASE WHEN s.doc_id IS NULL THEN 'new' WHEN b.doc_id IS NULL THEN 'kept' WHEN s.h = b.h THEN 'unchanged' ELSE 'updated' END AS change FROM s FULL JOIN b ON s.doc_id = b.doc_id""")
def upsert_classify(spark, sf_dir):
    """Stored rows against a batch that brings some of them changed."""
    docs = table(spark, sf_dir, "documents")
    stored = docs.where("doc_id % 3 != 0").select("doc_id", F.md5("text").alias("h"))
    batch = docs.where("doc_id % 4 != 1").select("doc_id", F.md5(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"), F.lit(1).alias("seq"))
    return t.classify_upsert(stored, batch, "doc_id", ["h"], "seq")


@query("history_ring", "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS last5 FROM r WHERE k <= 5 GROUP BY 1")
def history_ring(spark, sf_dir):
    """The last five entries of each key; only five per task are shuffled."""
    order = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
    last = table(spark, sf_dir, "events").select("user_id", "event_id").withColumn("k", F.row_number().over(order)).where("k <= 5")
    return last.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("last5"))


@query("html_extract")
def html_extract(spark, sf_dir):
    """Title, links and main text of pages."""
    return html.extract(table(spark, sf_dir, "pages"))


@query("thread_rollup", "SELECT conv_id, count(*) AS n_turns, count_if(role = 'user')::BIGINT AS n_user, string_agg(role, ',' ORDER BY turn) AS roles, sum(length(text))::BIGINT AS n_chars FROM conversations GROUP BY 1")
def thread_rollup(spark, sf_dir):
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.count_if(F.col("role") == "user").alias("n_user"), F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"), F.sum(F.length("text")).alias("n_chars")
    )
    return own.select("conv_id", "n_turns", "n_user", F.array_join(F.transform("r", lambda x: x["role"]), ",").alias("roles"), "n_chars")


@query("stream_daily_counts", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark, sf_dir):
    """The stream over the events file, run to its end; equals the batch."""
    return counts.daily_counts_once(spark, sf_dir)


@query("representative_quotes")
def representative_quotes(spark, sf_dir):
    """Turns as quotes of their role's area (no SQL twin: a choice depends on those before it)."""
    own = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("area_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"), (F.col("conv_id") % 5).alias("source"), F.col("text").alias("quote"),
        (1 + F.col("turn") % 5).alias("strength"), F.length("text").cast("double").alias("similarity"),
    )
    return a.representative_quotes(own, Scratch(spark, "quotes"))


@query("reduced_vectors")
def reduced_vectors(spark, sf_dir):
    """No SQL twin: eigenvectors."""
    own = v.reduced(table(spark, sf_dir, "embeddings"), 10, "embedding")
    return own.select("vec_id", F.posexplode("reduced").alias("i", "x"))
