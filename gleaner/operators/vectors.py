"""Vectors: centroids, coherence, nearest prior, margins, density clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXEMPLARS, PRIOR = 1000, 10_000
#: Distances that density clustering holds at once.
CELLS = 1 << 21


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """Of length 1, or as it is where its length is almost 0."""
    return F.transform(F.array(F.struct(a.alias("v"), norm(a).alias("n"))), lambda x: F.transform(x["v"], lambda y: y.cast("double") / F.greatest(x["n"], F.lit(1e-12))))[0]


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def centroids(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, size, centroid``: normalized mean; element-wise sums with map-side
    combine, so a hot cluster never meets in one task."""
    own = vectors.select(key, F.posexplode(vector).alias("i", "x"))
    means = own.groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("x"), F.count("*").alias("size"))
    mean = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("m"), F.max("size").alias("size"))
    raw = mean.withColumn("c", F.transform("m", lambda e: e["x"]))
    return raw.withColumn("n", norm(F.col("c"))).select(key, "size", F.transform("c", lambda x: x / F.greatest("n", F.lit(1e-12))).alias("centroid"))


def nearest_prior(new: DataFrame, prior: DataFrame, threshold: float) -> DataFrame:
    """The best prior centroid of each new one, if near enough. Prior clusters are a
    list of at most PRIOR, which is broadcast; more are refused."""
    if prior.limit(PRIOR + 1).count() > PRIOR:
        raise ValueError(f"{PRIOR} prior clusters at most")
    met = new.select(F.col("id").alias("new_id"), F.col("centroid").alias("a")).join(F.broadcast(prior.select(F.col("id").alias("prior_id"), F.col("centroid").alias("b"))))
    scored = met.withColumn("similarity", F.round(cosine(F.col("a"), F.col("b")), 6))
    best = scored.groupBy("new_id").agg(F.max(F.struct("similarity", (-F.col("prior_id")).alias("p"))).alias("best"))
    return best.where(F.col("best.similarity") >= threshold).select("new_id", (-F.col("best.p")).alias("prior_id"), "best.similarity")


def margins(vectors: DataFrame, positive: DataFrame, negative: DataFrame) -> DataFrame:
    """``id, margin``: greatest cosine with the positive exemplars less that with the
    negative ones. Exemplars are a list of at most EXEMPLARS and go along as one
    matrix; more are refused, none are left out."""

    def matrix(side: DataFrame) -> np.ndarray:
        rows = side.select("vector").limit(EXEMPLARS + 1).collect()
        if not 0 < len(rows) <= EXEMPLARS:
            raise ValueError(f"1 to {EXEMPLARS} exemplars of each kind are needed")
        return np.array([r["vector"] for r in rows], np.float64)

    pos, neg = matrix(positive), matrix(negative)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    pos, neg = unit(pos), unit(neg)

    @F.pandas_udf("double")
    def margin(batch: pd.Series) -> pd.Series:
        own = unit(np.stack(batch.to_numpy()).astype(np.float64))
        return pd.Series((own @ pos.T).max(axis=1) - (own @ neg.T).max(axis=1))

    return vectors.select("id", margin("vector").alias("margin"))


def reduced(vectors: DataFrame, dimensions: int, vector: str = "vector") -> DataFrame:
    """vectors with ``reduced``, their principal components: the covariance of the
    dimensions is aggregated by the executors, rows are projected in place. All
    vectors have one length; null ones stay out of the fit and give null."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    have = vectors.where(F.col(vector).isNotNull()).withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    if not have.head(1):
        return vectors.withColumn("reduced", F.lit(None).cast("array<double>"))
    model = PCA(k=dimensions, inputCol="_v", outputCol="_r").fit(have)
    out = model.transform(have).withColumn("reduced", vector_to_array("_r")).drop("_v", "_r")
    return out.unionByName(vectors.where(F.col(vector).isNull()).withColumn("reduced", F.lit(None).cast("array<double>")))


def core_distances(points: np.ndarray, k: int) -> np.ndarray:
    """Squared distance of each point to its k-th neighbour, the point itself being
    the first of all; a block of rows at a time."""
    n, sums = len(points), (points**2).sum(1)
    out, step = np.empty(n), max(1, CELLS // n)
    for at in range(0, n, step):
        d = points[at : at + step] @ points.T
        d *= -2
        d += sums
        d += sums[at : at + step, None]
        d.partition(k, axis=1)
        out[at : at + step] = d[:, k]
    return np.maximum(out, 0)


def reach_tree(points: np.ndarray, core: np.ndarray) -> list[tuple[float, int, int]]:
    """Edges of the minimum spanning tree by mutual reachability. The distances of one
    point are held at a time, to those that are still outside, less what they may be
    rounded off: that to a k-th neighbour must not come out above the core distance."""
    n, sums = len(points), (points**2).sum(1) * (1 - 1e-13)
    rest, far, ids = points, core.copy(), np.arange(n)
    own, best, near = sums, np.full(n, np.inf), np.zeros(n, np.int64)
    edges, now, place, inside = [], 0, 0, 0
    for _ in range(n - 1):
        far[place] = best[place] = np.inf  # inside from here on
        inside += 1
        if 8 * inside > len(ids):
            left = np.flatnonzero(np.isfinite(far))
            rest, far, ids, own, best, near, inside = rest[left], far[left], ids[left], own[left], best[left], near[left], 0
        d = rest @ points[now]
        d *= -2
        d += own
        d += sums[now]
        np.maximum(d, far, out=d)
        np.maximum(d, core[now], out=d)
        closer = d < best
        best[closer], near[closer] = d[closer], now
        place = int(best.argmin())
        edges.append((float(np.sqrt(best[place])), int(near[place]), int(ids[place])))
        now = int(ids[place])
    return edges


def density_labels(points: np.ndarray, least_size: int = 10, least_samples: int = 3) -> np.ndarray:
    """Density clusters by mutual reachability: the minimum spanning tree is cut at
    its most persistent level; noise is -1. Every distance is taken and none is kept, so
    memory grows with the points and time with their square."""
    n = len(points)
    if n < least_size:
        return np.full(n, -1)
    edges = sorted(reach_tree(points, core_distances(points, min(least_samples, n - 1))))
    parent, size = list(range(2 * n - 1)), [1] * n + [0] * (n - 1)
    births, children, at = [0.0] * n + [0.0] * (n - 1), {}, n

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for w, a, b in edges:
        ra, rb = root(a), root(b)
        parent[ra] = parent[rb] = at
        children[at], births[at], size[at] = (ra, rb), w, size[ra] + size[rb]
        at += 1

    def walk(node: int, birth: float) -> tuple[float, list[tuple[int, float]]]:
        """Stability of the best choice below, and the chosen nodes."""
        own, level, here = 0.0, 1 / max(birth, 1e-12), node
        while True:
            split = 1 / max(births[here], 1e-12)
            large = [c for c in children.get(here, ()) if size[c] >= least_size]
            if len(large) == 2:
                own += size[here] * (split - level)
                below = [walk(c, births[here]) for c in large]
                total = sum(x for x, _ in below)
                return (own, [(node, birth)]) if own >= total else (total, [y for _, x in below for y in x])
            if not large:
                return own + size[here] * max(0.0, split - level), [(node, birth)]
            own += (size[here] - size[large[0]]) * (split - level)
            here = large[0]

    import sys

    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * n + 1000))
    top = 2 * n - 2
    _, chosen = walk(top, births[top] * 2 + 1e-9)
    if chosen == [(top, births[top] * 2 + 1e-9)]:
        chosen = [(top, 0)]
    labels = np.full(n, -1)
    groups = []
    for node, _ in chosen:
        stack, own = [node], []
        while stack:
            x = stack.pop()
            if x < n:
                own.append(x)
            else:
                stack.extend(children[x])
        groups.append(sorted(own))
    for i, own in enumerate(sorted(groups, key=lambda g: (-len(g), g[0]))):
        labels[own] = i
    return labels
