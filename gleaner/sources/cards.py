"""Review cards of store pages: an element labelled by its review's title holds the
title, stars, time, author and content of one review."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that have no end tag (fixed values of HTML).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CARD = "struct<review_id: string, title: string, content: string, rating: int, at: string, author: string>"
_LABEL, _STARS = re.compile(r"review-(\d+)-title"), re.compile(r"(\d).*Stars?$", re.DOTALL)


class _Cards(HTMLParser):
    """Open elements are a stack; each knows the innermost card around it and the field
    that its text belongs to, so a card within a card keeps what is its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open, self.cards = [], []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        have = {k: v or "" for k, v in attrs}
        _, card, field = self.open[-1] if self.open else ("", None, None)
        if named := _LABEL.fullmatch(have.get("aria-labelledby", "")):
            card, field = {"review_id": named[1]}, None
            self.cards.append(card)
        elif card is not None:
            if stars := _STARS.search(have.get("aria-label", "")):
                card.setdefault("rating", int(stars[1]))
            if tag == "time" and "datetime" in have:
                card.setdefault("at", have["datetime"])
            classes = have.get("class", "").split()
            opens = "title" if tag == "h3" else next((c for c in ("author", "content") if c in classes), None)
            if field is None and opens and opens not in card:  # the first of its kind
                field = opens
                card[field] = []
        if tag not in VOID:
            self.open.append((tag, card, field))

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][2] and (own := data.strip()):
            _, card, field = self.open[-1]
            card[field].append(own)


def read_cards(page: str | None) -> list[dict[str, object]]:
    """Every card of a page in order, repeats included; none for null."""
    reader = _Cards()
    reader.feed(page or "")
    reader.close()
    text = lambda card, field, glue: glue.join(card[field]) if field in card else None
    return [
        {"review_id": c["review_id"], "title": text(c, "title", " "), "content": text(c, "content", "\n") or "", "rating": c.get("rating"), "at": c.get("at"), "author": text(c, "author", "")}
        for c in reader.cards
    ]


def review_cards(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``review_id, title, content, rating, at, author``: one row per review. A page shows
    a review more than once (list and dialog), and pages repeat reviews: the longest
    content stays, of equal ones that of the first page and place. Null pages have none."""

    @F.pandas_udf(f"array<{CARD}>")
    def parse(texts: pd.Series) -> pd.Series:
        return pd.Series([read_cards(t) for t in texts])

    cards = pages.select(F.col(page_id).alias("_page"), F.posexplode(parse(html)).alias("_place", "c"))
    order = F.struct((-F.length("c.content")).alias("l"), F.col("_page").alias("p"), F.col("_place").alias("n"))
    return cards.groupBy(F.col("c.review_id").alias("_id")).agg(F.min_by("c", order).alias("c")).select("c.*")
