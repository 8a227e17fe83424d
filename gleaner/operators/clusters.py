"""Clusters of vectors: numbering, categories, central items, settings compared."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators import vectors as v


def build(members: DataFrame, category: str, key: str = "vec_id") -> DataFrame:
    """``cluster, cluster_id, size, category`` of members (key, cluster, category): ids by
    size, then first member; the category most members have, then that met first.
    Noise (negative) is no cluster. One aggregate, whatever the size of a cluster."""
    own = members.where("cluster >= 0").groupBy("cluster", F.col(category).alias("category")).agg(F.count("*").alias("n"), F.min(key).alias("first"))
    sums = own.groupBy("cluster").agg(F.min_by("category", F.struct(-F.col("n"), "first")).alias("category"), F.sum("n").alias("size"), F.min("first").alias("first"))
    return sums.withColumn("cluster_id", F.row_number().over(Window.orderBy(F.desc("size"), "first")) - 1)  # clusters are few


def central(members: DataFrame, key: str = "vec_id") -> DataFrame:
    """``cluster, key, cosine`` of the member nearest to each centre (ties: least key)."""
    unit = members.withColumn("vector", v.unit(F.col("vector")))
    centres = v.centroids(unit, "cluster", "vector").select("cluster", F.col("centroid"))
    met = unit.join(centres, "cluster").select("cluster", key, F.round(v.cosine(F.col("vector"), F.col("centroid")), 9).alias("cosine"))
    best = met.groupBy("cluster").agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col(key).alias("k"))).alias("m"))
    return best.select("cluster", F.col("m.k").alias(key), (-F.col("m.c")).alias("cosine"))


def label(text, limit: int = 70):
    """A text cut at a word's end to name a cluster."""
    plain = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(plain) <= limit, plain).otherwise(F.concat(F.regexp_replace(F.substring(plain, 1, limit - 1), r"\s+\S*$", ""), F.lit("…")))


def sweep(points: DataFrame, grid: list[tuple[int, int]], key: str = "vec_id") -> DataFrame:
    """``least_size, least_near, n_clusters, noise, largest, coherence`` of each setting, one
    task for each. The points are dealt to every setting and none passes the driver; a
    task holds them once, whatever their number, and takes time by its square."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        size, near = int(frame["least_size"].iloc[0]), int(frame["least_near"].iloc[0])
        matrix = np.stack(frame.sort_values(key)["vector"].to_numpy()).astype(np.float64)
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
        labels = v.density_labels(matrix, size, near)
        found = [matrix[labels == k] for k in sorted(set(labels.tolist())) if k >= 0]
        centre = [x.mean(axis=0) / max(float(np.linalg.norm(x.mean(axis=0))), 1e-12) for x in found]
        means = [float((x @ m).mean()) for x, m in zip(found, centre, strict=True)]
        row = (size, near, len(found), float((labels < 0).mean()), max((len(x) for x in found), default=0) / len(matrix), float(np.mean(means)) if means else None)
        return pd.DataFrame([row], columns=["least_size", "least_near", "n_clusters", "noise", "largest", "coherence"])

    settings = F.array(*[F.struct(F.lit(i).alias("setting"), F.lit(size).alias("least_size"), F.lit(near).alias("least_near")) for i, (size, near) in enumerate(grid)])
    dealt = points.select(key, "vector", F.explode(settings).alias("s")).select(key, "vector", "s.*").repartitionByRange(len(grid), "setting")
    return dealt.groupBy("setting").applyInPandas(run, "least_size int, least_near int, n_clusters int, noise double, largest double, coherence double")
