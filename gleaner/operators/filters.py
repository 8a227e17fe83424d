"""Filter state as one value, turned into columns.

Facets see corrections first: a value corrected by a reviewer counts in place of
the engine's own, and an empty correction clears it back."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Filters:
    sources: tuple[str, ...] = ()
    platforms: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    scope: str | None = None  # retrieval type
    since: date | None = None
    until: date | None = None
    ratings: tuple[int, ...] = ()
    include_unrated: bool = True
    min_confidence: int | None = None
    high_stakes_only: bool = False

    def active_count(self) -> int:
        return sum(getattr(self, f.name) != f.default for f in fields(self))

    def summary(self) -> str:
        return "; ".join(f"{f.name}={getattr(self, f.name)}" for f in fields(self) if getattr(self, f.name) != f.default) or "all items"

    def key(self) -> str:
        """The filters as text, the same for equal ones."""
        return json.dumps({f.name: getattr(self, f.name) for f in fields(self)}, default=str, sort_keys=True)

    @classmethod
    def from_key(cls, key: str) -> Filters:
        own = json.loads(key)
        dates = {k: date.fromisoformat(own[k]) for k in ("since", "until") if own.get(k)}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in own.items()} | dates)

    def items(self) -> Column:
        """Facets of an item. A null fails every facet but that of ratings, which
        unrated items pass while they are included."""
        clauses = [~F.col("is_spam")]
        if self.sources:
            clauses.append(F.col("source").isin(*self.sources))
        if self.platforms:
            clauses.append(F.col("platform").isin(*self.platforms))
        if self.since:
            clauses.append(F.col("day") >= F.lit(self.since))
        if self.until:
            clauses.append(F.col("day") <= F.lit(self.until))
        if self.ratings:
            rated = F.col("rating").isin(*self.ratings)
            clauses.append(rated | F.col("rating").isNull() if self.include_unrated else rated)
        return _all(clauses)

    def insights(self) -> Column:
        """Facets of what was found in an item; confidence is the lesser of two."""
        clauses = [F.lit(True)]
        if self.scope:
            clauses.append(F.col("retrieval_type") == self.scope)
        if self.categories:
            clauses.append(F.col("category").isin(*self.categories))
        if self.high_stakes_only:
            clauses.append(F.col("high_stakes"))
        if self.min_confidence is not None:
            clauses.append(F.least("confidence100", F.col("relevance10") * 10) >= self.min_confidence)
        return _all(clauses)

    def evidence(self) -> Column:
        return self.items() & self.insights()


def _all(clauses: list[Column]) -> Column:
    out = clauses[0]
    for clause in clauses[1:]:
        out = out & clause
    return out


def latest_overrides(log: DataFrame) -> DataFrame:
    """``target_id, field, value, override_id``: the last entry of each key; an
    empty value is kept, as it clears."""
    last = log.groupBy("target_id", "field").agg(F.max(F.struct("override_id", "value")).alias("last"))
    return last.select("target_id", "field", F.col("last.value").alias("value"), F.col("last.override_id").alias("override_id"))


def corrected(df: DataFrame, key: str, column: str, field: str, latest: DataFrame) -> DataFrame:
    """df with ``column`` as its latest correction says."""
    own = latest.where(F.col("field") == field).select(F.col("target_id").alias("_t"), F.col("value").alias("_v"))
    met = df.join(own, F.col(key) == F.col("_t"), "left")
    return met.withColumn(column, F.when(F.col("_v").isNotNull() & (F.col("_v") != ""), F.col("_v")).otherwise(F.col(column))).drop("_t", "_v")


def search(columns: list[str], term: str) -> Column:
    """Case-insensitive search in any of the columns; % and _ act as wildcards."""
    return _any([F.lower(F.coalesce(c, F.lit(""))).like(f"%{term.lower()}%") for c in columns])


def _any(clauses: list[Column]) -> Column:
    out = clauses[0]
    for clause in clauses[1:]:
        out = out | clause
    return out


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of an ordered frame, numbers from 1. Sorting and limit become one
    top-k, so only offset + size rows of each partition are kept."""
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)
