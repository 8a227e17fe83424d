import re

import pytest

from gleaner.operators import report, scoring
from gleaner.sources import cards


def test_cards_keep_what_is_their_own():
    page = """<div aria-labelledby="review-7-title"><h3>Good<br>one</h3><i aria-label="4 Stars"></i><time datetime="2024-05-01">May</time>
      <div aria-labelledby="review-8-title"><h3>Inner</h3><p class="content">a <b>b</b><br>c</p></div>
      <p class="meta author">Ann</p><p class="content">first</p><p class="content">second</p></div>
      <div aria-labelledby="review-x-title"><h3>no</h3></div>"""
    outer, inner = cards.read_cards(page)
    assert outer == {"review_id": "7", "title": "Good one", "content": "first", "rating": 4, "at": "2024-05-01", "author": "Ann"}
    assert inner == {"review_id": "8", "title": "Inner", "content": "a\nb\nc", "rating": None, "at": None, "author": None}
    assert cards.read_cards(None) == cards.read_cards("") == cards.read_cards("</p></div>") == []


def test_the_longest_card_of_a_review_stays(spark):
    card = lambda i, text, title: f'<div aria-labelledby="review-{i}-title"><h3>{title}</h3><p class="content">{text}</p>'
    pages = spark.createDataFrame([(1, card(1, "abc", "p") + "</div>" + card(1, "abcdef", "q")), (2, card(1, "uvwxyz", "r")), (3, None), (4, card(2, "", "s"))], "page_id long, html string")
    got = {r["review_id"]: (r["title"], r["content"]) for r in cards.review_cards(pages).collect()}
    assert got == {"1": ("q", "abcdef"), "2": ("s", "")}
    assert cards.review_cards(pages.limit(0)).count() == 0


def test_places_of_a_document_are_right():
    out = report.pdf([("A (b) \\ c", ["x" * 250, "“q” …", "日"]), ("B", [str(i) for i in range(200)])], "run 1")
    table = int(re.search(rb"startxref\n(\d+)\n%%EOF\n$", out)[1])
    assert out[table:].startswith(b"xref\n")
    places = [int(x) for x in re.findall(rb"(\d{10}) 00000 n ", out[table:])]
    assert all(out[p:].startswith(b"%d 0 obj" % i) for i, p in enumerate(places, 1))
    for m in re.finditer(rb"<< /Length (\d+) >>\nstream\n", out):
        assert out[m.end() + int(m[1]) :].startswith(b"\nendstream")
    n = int(re.search(rb"/Count (\d+)", out)[1])
    assert n == len(report.paged([("A", [""]), ("B", [str(i) for i in range(200)])])) == out.count(b"/Type /Page ")
    assert rb"(A \(b\) \\ c) Tj" in out and b"(\x93q\x94 \x85) Tj" in out and b"(?) Tj" in out and b"x" * 101 not in out
    assert report.pdf([]).count(b"/Type /Page ") == 1


def test_sections_of_ranked_areas(spark):
    names = ", ".join(f"{i}.0 {d}" for i, d in enumerate(scoring.DIMENSIONS, 1))
    scores = spark.sql(f"select concat('a', id) area_id, 20 + id n_items, {names} from range(3)")
    ranked = scoring.rank_areas(scores, scoring.WEIGHTS)
    quotes = spark.createDataFrame([("a2", "late", 2), ("a2", "soon", 1), ("a0", "other", 1)], "area_id string, quote string, place int")
    own = report.sections(ranked, quotes, scoring.WEIGHTS, top=2, note="drill")
    assert [t for t, _ in own] == ["Ranked problem areas", "1. a2", "2. a1", "How areas are ranked"]
    assert own[0][1] == ["drill", "1. a2: 3.10, Medium", "2. a1: 3.10, Medium", "3. a0: 3.10, Medium"]
    assert own[1][1][-2:] == ['"soon"', '"late"'] and own[2][1][-1] == "No quotes match."
    assert report.sections(ranked.limit(0), quotes, scoring.WEIGHTS)[0][1] == ["No area matches."]
    with pytest.raises(ValueError):
        report.sections(ranked.crossJoin(spark.range(400).select("id")), quotes, scoring.WEIGHTS)
