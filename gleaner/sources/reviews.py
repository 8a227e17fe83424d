"""Store reviews page by page, threads with typed replies, and a source for Spark.

``ReviewPages`` reads saved pages (JSON lines of one page each: country, token, next,
reviews) as a Python data source, so that what is fetched and what is stored look
the same to the plans."""

from __future__ import annotations

import glob
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "review_id string, country string, page int, at string, score string, content string"


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        """One for each saved country, whose pages follow one another."""
        return [InputPartition(p) for p in sorted(glob.glob(f"{self.options['path']}/*.jsonl"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Reviews of a country from its first page on, along the tokens, up to the page
        all of whose reviews are older than ``since``."""
        since = self.options.get("since", "")
        with open(partition.value, encoding="utf-8") as f:
            pages = {p.get("token"): p for p in map(json.loads, f)}
        token, n, seen = None, 0, set()
        while token not in seen and (page := pages.get(token)):
            seen.add(token)
            fresh = [r for r in page["reviews"] if r.get("at", "") >= since]
            yield from ((r.get("id"), page.get("country"), n, r.get("at"), None if r.get("score") is None else str(r["score"]), r.get("content")) for r in fresh)
            if not fresh:
                return
            token, n = page.get("next"), n + 1


class ReviewPages(DataSource):
    """Saved review pages below ``path``; ``since`` is the first day that is wanted."""

    @classmethod
    def name(cls) -> str:
        return "review_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options)


def fetch(spark: SparkSession, path: str, since: str = "", limit: int | None = None) -> DataFrame:
    """Raw items of the source from a day on, at most ``limit``."""
    spark.dataSource.register(ReviewPages)
    own = one_per_review(spark.read.format("review_pages").option("path", path).option("since", since).load())
    return own if limit is None else own.orderBy(F.desc("at"), "review_id").limit(limit)


def one_per_review(reviews: DataFrame) -> DataFrame:
    """``review_id, at, score, content, countries``: a review met in several countries is
    one, as first met by country, with all of them."""
    first = F.min_by(F.struct("at", "score", "content"), F.struct("country", "page")).alias("m")
    own = reviews.where("review_id is not null").groupBy("review_id").agg(first, F.array_sort(F.collect_set("country")).alias("countries"))
    return own.select("review_id", "m.at", "m.score", "m.content", "countries")


def typed_replies(posts: DataFrame, most: int = 10) -> DataFrame:
    """``thread_id, kind, author, at, body, place`` of the replies (thread_id, author, role,
    at, body) of each thread (first_author): those of its author are follow-ups, of
    experts expert, others user. A reply that is shown twice is one, and of each thread
    the first ``most`` follow-ups and others by time stay."""
    own = posts.dropDuplicates(["thread_id", "author", "at", "body"])
    kind: Column = F.when(F.col("author").eqNullSafe(F.col("first_author")), "op_followup").when(F.col("role") == "expert", "expert").otherwise("user")
    own = own.withColumn("kind", kind).withColumn("_op", F.col("kind") == "op_followup")
    order = ["at", F.col("author").asc_nulls_first(), "body"]
    own = own.withColumn("_n", F.row_number().over(Window.partitionBy("thread_id", "_op").orderBy(*order))).where(F.col("_n") <= most)
    place = F.row_number().over(Window.partitionBy("thread_id").orderBy(*order))
    return own.select("thread_id", "kind", "author", "at", "body", place.alias("place"))


def thread_list(pages: DataFrame, html: str) -> DataFrame:
    """``page_id, thread_id, place`` of the links to threads in each page, the first
    occurrence of a thread in a page."""
    ids = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"/thread/(\d+)"), F.lit(1))
    return pages.select("page_id", F.posexplode(F.array_distinct(ids)).alias("place", "thread_id"))
