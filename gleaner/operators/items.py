"""Items from raw payloads: one projection for each source, one frame of items.

A raw row is ``raw_id, source, platform, payload`` (JSON) and when it was fetched.
Each source gives its fields as expressions over the payload; rows without text
are told apart by a reason, never dropped in silence."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import scalars
from gleaner.sources.pages import scraped_page

# Texts of removed posts, and errors of spreadsheet formulas.
DELETED = ("[deleted]", "[removed]")
FORMULA_ERRORS = ("#N/A", "#REF!", "#VALUE!", "#DIV/0!", "#NAME?", "#NUM!", "#NULL!", "#ERROR!")


def at(path: str) -> Column:
    """A value of the payload as text, trimmed; null if it is not there."""
    return F.trim(F.get_json_object("payload", f"$.{path}"))


def filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def numbers(**values: Column) -> Column:
    """Engagement: the values that are whole numbers, by name."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.floor(F.regexp_replace(v, ",", "").try_cast("double")).alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def meta(**values: Column) -> Column:
    """Metadata as JSON texts by name, without what is empty."""
    return scalars.drop_empty(F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[v.cast("string") for v in values.values()])))


def cell(name: str) -> Column:
    """A cell of a sheet's row; null for formula errors."""
    return F.when(~at(f"row.{name}").isin(*FORMULA_ERRORS), filled(at(f"row.{name}")))


def store_review() -> dict[str, Column]:
    return {
        "title": F.lit(None).cast("string"), "text": at("content"), "date": at("at"), "loose": F.lit(False), "rating": scalars.rating(at("score")),
        "engagement": numbers(thumbs_up=at("thumbsUpCount")),
        "metadata": meta(review_id=at("reviewId"), app_version=F.coalesce(filled(at("reviewCreatedVersion")), at("appVersion")), countries=at("_meta.countries"), developer_reply=at("replyContent")),
    }


def feed_review() -> dict[str, Column]:
    """An entry of a feed, whose values are objects with a label, or a page's card."""
    both = lambda name, plain: F.coalesce(F.get_json_object("payload", f"$['{name}'].label"), at(plain))
    return {
        "title": filled(F.trim(both("title", "title"))), "text": F.trim(both("content", "content")), "date": both("updated", "date"), "loose": F.lit(False),
        "rating": scalars.rating(both("im:rating", "rating")), "engagement": numbers(vote_sum=both("im:voteSum", "voteSum"), vote_count=both("im:voteCount", "voteCount")),
        "metadata": meta(review_id=both("id", "id"), country=at("country"), app_version=both("im:version", "version"), via=at("_meta.via")),
    }


def sheet_row() -> dict[str, Column]:
    """A row whose columns are named by the field they hold. A captured page gives its
    content as text, a refused one its snippet or title."""
    page = F.col("_page")
    text = F.when(page.isNull(), cell("text")).when(page["blocked"], F.coalesce(cell("snippet"), cell("title"))).otherwise(page["body"])
    return {
        "title": F.coalesce(cell("title"), F.when(~page["blocked"], page["title"])), "text": text, "date": F.coalesce(cell("date"), page["published"], F.lit("")), "loose": F.lit(True),
        "rating": F.when(F.col("platform").isin("android", "ios"), scalars.rating(cell("rating"))), "engagement": numbers(upvotes=cell("score"), comments=cell("comments")),
        "metadata": meta(sheet_tab=at("tab"), sheet_source=cell("source"), sheet_id=cell("id"), scraped_page=F.when(page.isNotNull(), F.lit(True)), fetch_blocked=F.when(page["blocked"], F.lit(True))),
    }


def thread() -> dict[str, Column]:
    title, body = filled(at("title")), filled(at("body"))
    return {
        "title": title, "text": F.coalesce(body, title), "date": at("created_at"), "loose": F.lit(False), "rating": F.lit(None).cast("int"),
        "engagement": numbers(same_question=F.coalesce(at("same_question_count"), at("counts.upvotes")), replies=F.coalesce(at("counts.replies"), at("replies_seen"))),
        "metadata": meta(thread_id=at("thread_id"), state=at("state"), title_only=F.when(body.isNull(), F.lit(True)), replies=at("replies")),
    }


MAPPERS: dict[str, Callable[[], dict[str, Column]]] = {"store": store_review, "feed": feed_review, "sheet": sheet_row, "community": thread}


def normalize(raw: DataFrame, now: Column, mappers: dict[str, Callable[[], dict[str, Column]]] = MAPPERS) -> DataFrame:
    """``raw_id, item_id, source, platform, title, text, date, precision, rating,
    engagement, metadata, date_flag, content_hash, skipped`` of raw rows (raw_id,
    source, platform, payload, fetched_at); rows of other sources are left out.
    skipped is why a row is no item: deleted, no_text, or null. A date more than a day
    ahead of now is nulled and flagged."""

    def project(source: str, fields: dict[str, Column]) -> DataFrame:
        own = raw.where(F.col("source") == source).withColumn("_page", scraped_page(cell("text")))  # a column, so that it is split once
        return own.select("raw_id", "source", "platform", "fetched_at", *[v.alias(k) for k, v in fields.items()])

    rows = reduce(DataFrame.unionByName, [project(s, m()) for s, m in mappers.items()])
    when, precision = scalars.loose_date(F.col("date"), F.col("fetched_at"))
    rows = rows.withColumn("precision", F.when(F.col("loose"), precision)).withColumn("date", F.when(F.col("loose"), when).otherwise(F.try_to_timestamp("date")))
    text = F.col("text")
    skipped = F.when(F.lower(text).isin(*DELETED), "deleted").when(F.coalesce(text, F.lit("")) == "", "no_text")
    ahead = F.col("date") > now + F.expr("interval 1 day")
    shown = F.when(F.col("title").isNotNull() & ~F.startswith(text, F.col("title")), F.concat_ws("\n\n", "title", "text")).otherwise(text)
    return rows.select(
        "raw_id", scalars.item_id(F.col("raw_id")).alias("item_id"), "source", "platform", "title", "text", F.when(~F.coalesce(ahead, F.lit(False)), F.col("date")).alias("date"), "precision",
        "rating", "engagement", "metadata", F.coalesce(ahead, F.lit(False)).alias("date_flag"), scalars.content_hash(shown).alias("content_hash"), skipped.alias("skipped"),
    )


def skip_counts(normalized: DataFrame) -> DataFrame:
    """``source, reason, n``. The reason passes a generator, through which no filter is
    pushed: it would be repeated in every projection below."""
    own = normalized.select("source", F.explode_outer(F.array("skipped")).alias("reason")).where("reason is not null")
    return own.groupBy("source", "reason").agg(F.count("*").alias("n"))


def raw_by_id(raw: DataFrame, source: str, ids: DataFrame | None = None) -> DataFrame:
    """The stored rows of a source, or those of them that are named."""
    own = raw.where(F.col("source") == source)
    return own if ids is None else own.join(ids.select("raw_id").distinct(), "raw_id", "left_semi")


def work_items(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Eligible items that are no spam in order of id, the limit counting these alone."""
    own = items.where("eligible and not is_spam").orderBy("item_id")
    return own if limit is None else own.limit(limit)
