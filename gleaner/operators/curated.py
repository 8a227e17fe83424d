"""Areas as they stand after curation: merge chains, states, names, rows of those merged away."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.runs import resolve_merges

MERGES = 100_000


def areas(clusters: DataFrame, curation: DataFrame, least: int, most: int = MERGES) -> DataFrame:
    """``area_id, clusters, category, size, status, name, merged_from, merged_into, emerging``
    of clusters (cluster_id, category, size, area_id) under the corrections in force
    (target_id, field merge, status or name, value).

    Clusters go to the end of their area's merge chain, the largest first. The category
    is that of most members, then of the largest cluster, then the least. An area that
    was merged away keeps a row without clusters, with the category of the area it is in.
    Areas of fewer than ``least`` members are emerging. Merges are entered by hand; more
    than ``most`` are refused."""
    spark = clusters.sparkSession
    merges = {r["target_id"]: r["value"] for r in curation.where("field = 'merge'").limit(most + 1).collect()}
    if len(merges) > most:
        raise ValueError(f"{most} merges at most")
    ends = spark.createDataFrame(list(resolve_merges(merges).items()), "home string, final string")
    own = clusters.select("cluster_id", "category", "size", F.col("area_id").alias("home")).join(ends, "home", "left").withColumn("area_id", F.coalesce("final", "home")).drop("final")
    weights = own.groupBy("area_id", "category").agg(F.sum("size").alias("w"), F.max("size").alias("largest"))
    category = weights.groupBy("area_id").agg(F.min_by("category", F.struct(-F.col("w"), -F.col("largest"), "category")).alias("category"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("s"), "cluster_id")))
    away = F.array_sort(F.collect_set(F.when(F.col("home") != F.col("area_id"), F.col("home"))))
    met = own.groupBy("area_id").agg(F.transform(order, lambda x: x["cluster_id"]).alias("clusters"), F.sum("size").alias("size"), away.alias("merged_from")).join(category, "area_id")
    stubs = own.where("home != area_id").select(F.col("home").alias("area_id"), F.col("area_id").alias("merged_into")).distinct()
    stubs = stubs.join(category.withColumnRenamed("area_id", "merged_into"), "merged_into")
    said = curation.where("field in ('status', 'name')").groupBy(F.col("target_id").alias("area_id")).pivot("field", ["status", "name"]).agg(F.first("value"))
    none = F.array().cast("array<string>")
    columns = ["area_id", "clusters", "category", "size", "merged_from", "merged_into"]
    both = met.withColumn("merged_into", F.lit(None).cast("string")).select(columns).unionByName(
        stubs.select("area_id", none.alias("clusters"), "category", F.lit(0).cast("long").alias("size"), none.alias("merged_from"), "merged_into")
    )
    status = F.when(F.col("merged_into").isNotNull(), "merged").otherwise(F.coalesce("status", F.lit("active")))
    return both.join(said, "area_id", "left").select("area_id", "clusters", "category", "size", status.alias("status"), "name", "merged_from", "merged_into", (F.col("size") < least).alias("emerging"))
