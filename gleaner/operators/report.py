"""The printed report: ranked areas as a table, then a page for each of the first.

Pages are written as plain PDF 1.4 with the built-in fonts, so no library is needed.
Areas are rows of tens; larger tables are refused, not cut."""

from __future__ import annotations

import textwrap

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.scoring import DIMENSIONS

#: A page in points: size, margin, font sizes of titles and text, line height, characters of a line.
WIDTH, HEIGHT, MARGIN, TITLE, BODY, LINE, CHARACTERS = 612, 792, 54, 14, 9, 13, 100
MOST_AREAS, QUOTES = 1000, 8


def _string(line: str) -> bytes:
    """A string of the standard encoding; characters that it lacks become ?."""
    plain = line.encode("cp1252", "replace")
    return b"(" + plain.replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b")"


def paged(sections: list[tuple[str, list[str]]]) -> list[list[tuple[int, str]]]:
    """(font size, line) by page: every section begins a page, long lines are wrapped and
    what does not fit goes on over the next page."""
    room, pages = (HEIGHT - 2 * MARGIN) // LINE, []
    for title, lines in sections:
        own = [(TITLE, t) for t in textwrap.wrap(title, CHARACTERS * BODY // TITLE)] + [(BODY, "")]
        for line in lines:
            own.extend((BODY, part) for part in textwrap.wrap(line, CHARACTERS, subsequent_indent="  ") or [""])
        pages.extend(own[i : i + room] for i in range(0, len(own), room))
    return pages


def pdf(sections: list[tuple[str, list[str]]], footer: str = "") -> bytes:
    """The document: catalog, page tree, font, then each page and its content."""
    pages = paged(sections) or [[]]
    kids = " ".join(f"{4 + 2 * i} 0 R" for i in range(len(pages)))
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} >>".encode(),
        b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>",
    ]
    for i, lines in enumerate(pages):
        drawn = [b"BT /F1 %d Tf 1 0 0 1 %d %d Tm %s Tj ET" % (size, MARGIN, HEIGHT - MARGIN - n * LINE, _string(line)) for n, (size, line) in enumerate(lines) if line]
        drawn.append(b"BT /F1 7 Tf 1 0 0 1 %d %d Tm %s Tj ET" % (MARGIN, MARGIN // 2, _string(f"{footer}  {i + 1} / {len(pages)}".strip())))
        content = b"\n".join(drawn)
        objects.append(f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {WIDTH} {HEIGHT}] /Resources << /Font << /F1 3 0 R >> >> /Contents {5 + 2 * i} 0 R >>".encode())
        objects.append(b"<< /Length %d >>\nstream\n%s\nendstream" % (len(content), content))
    out, places = bytearray(b"%PDF-1.4\n"), []
    for i, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (i, body)
    table = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    out += b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, table)
    return bytes(out)


def sections(ranked: DataFrame, quotes: DataFrame, weights: dict[str, float], top: int = 8, note: str = "") -> list[tuple[str, list[str]]]:
    """What the report says of ranked areas (rank_areas) and their quotes (area_id, quote,
    place): the table of all, a page for each of the ``top`` first, and the weights."""
    rows = ranked.orderBy("rank").limit(MOST_AREAS + 1).collect()
    if len(rows) > MOST_AREAS:
        raise ValueError(f"a report takes {MOST_AREAS} areas at most")
    shown = rows[:top]
    said: dict[object, list[str]] = {}
    wanted = quotes.where((F.col("place") <= QUOTES) & F.col("area_id").isin([r["area_id"] for r in shown])).orderBy("area_id", "place")
    for q in wanted.collect():
        said.setdefault(q["area_id"], []).append(f'"{q["quote"]}"')
    line = lambda r: f"{r['rank']}. {r['area_id']}: {r['composite']:.2f}, {r['band']}{', little evidence' if r['low_evidence'] else ''}"
    out = [("Ranked problem areas", [*([note] if note else []), *([line(r) for r in rows] or ["No area matches."])])]
    for r in shown:
        scores = [f"{d.replace('_', ' ')}: {r[d]:.2f}" for d in DIMENSIONS]
        out.append((f"{r['rank']}. {r['area_id']}", [f"Score {r['composite']:.2f} ({r['band']}) from {r['n_items']} items", *scores, "", *(said.get(r["area_id"]) or ["No quotes match."])]))
    return [*out, ("How areas are ranked", [f"{k.replace('_', ' ')}: weight {v:.2f}" for k, v in weights.items()])]
