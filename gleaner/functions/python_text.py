"""Text functions that need Python's tables, as Arrow batches."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG, _QUOTE = re.compile(r"<[^>]+>"), re.compile(r"\s*>")
_IMAGE, _LINK = re.compile(r"!\[([^\]]*)\]\([^)]*\)"), re.compile(r"\[([^\]]+)\]\([^)]*\)")
# markdown that gives way to what it marks, in this order
_MARKS = (re.compile(r"(\*\*|__)(?P<own>.+?)\1", re.S), re.compile(r"(?<!\*)\*(?!\*)(?P<own>.+?)(?<!\*)\*(?!\*)"), re.compile(r"(?<!_)_(?!_)(?P<own>.+?)(?<!_)_(?!_)"), re.compile(r"`(?P<own>[^`]*)`"))
_HEADING = re.compile(r"^#{1,6}\s*", re.M)
# The blocks that count as emoji, with the selector and the joiner.
_EMOJI = re.compile("[\U0001f300-\U0001faff\u2600-\u27bf\U0001f1e6-\U0001f1ff\u2190-\u21ff\u2b00-\u2bff\ufe0f\u200d]+")
_PHONE = re.compile(r"(?<!\d)\+?\d[\d\s().-]{8,20}\d(?!\d)")


def without_links(text: str) -> str:
    """Without the markdown images and links, their words too."""
    return _LINK.sub("", _IMAGE.sub("", text))


def strip_markup(text: str) -> str:
    """NFKC, entities, quoted lines, markdown and tags; what is marked stays."""
    lines = html.unescape(unicodedata.normalize("NFKC", text)).splitlines()
    text = "\n".join(x for x in lines if not _QUOTE.match(x))
    text = _TAG.sub(" ", _LINK.sub(r"\1", _IMAGE.sub(r"\1", text)))
    for mark in _MARKS:
        text = mark.sub(lambda m: m["own"], text)
    return _HEADING.sub("", text)


def name_emoji(text: str) -> str:
    """Emoji as their Unicode names; selectors and joiners go."""

    def names(m: re.Match[str]) -> str:
        own = [unicodedata.name(c, "").lower() for c in m[0] if unicodedata.category(c)[0] not in "CM"]
        return f" {' '.join(filter(None, own))} " if any(own) else " "

    return _EMOJI.sub(names, text)


def without_emoji(text: str) -> str:
    return _EMOJI.sub(" ", text)


def looks_like_phone(found: str) -> bool:
    """10 to 15 digits that are no date, no version and no bare id of 12."""
    digits, compact = re.sub(r"\D", "", found), re.sub(r"\s", "", found)
    dated = re.fullmatch(r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}", compact)
    version = re.fullmatch(r"\d{1,4}(\.\d{1,12}){2,}", compact)
    return 10 <= len(digits) <= 15 and not (dated or version or (len(digits) == 12 and found.strip().isdigit()))


def redact_phones(text: str) -> tuple[str, int]:
    hits = 0

    def mark(m: re.Match[str]) -> str:
        nonlocal hits
        if not looks_like_phone(m[0]):
            return m[0]
        hits += 1
        return "[PHONE]"

    return _PHONE.sub(mark, text), hits


@F.pandas_udf(T.StructType([T.StructField("clean", T.StringType()), T.StructField("n_phones", T.IntegerType())]))
def clean_text(texts: pd.Series) -> pd.DataFrame:
    """Markup stripped, emoji named, phones replaced; null for null."""
    out = []
    for t in texts:
        out.append((None, 0) if t is None else redact_phones(name_emoji(strip_markup(t))))
    return pd.DataFrame(out, columns=["clean", "n_phones"])


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 LCS / (len a + len b), by bit-parallel LCS."""
    if not a and not b:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = s = (1 << len(a)) - 1
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return 200.0 * (len(a) - s.bit_count()) / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """Likeness of two texts as sets of words, 0 to 100: what they share counts in
    full, the rest by its indel distance; 100 where one set holds the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if shared and not (left and right):
        return 100.0
    n, gap = len(" ".join(shared)), bool(shared)
    whole = 2 * (n + gap) + len(left) + len(right)
    apart = (len(left) + len(right)) * (1 - indel_ratio(left, right) / 100)
    found = [1 - apart / whole]
    if shared:
        found += [1 - (gap + len(rest)) / (2 * n + gap + len(rest)) for rest in (left, right)]
    return 100 * max(found)


def ground_quote(quote: str | None, text: str | None, threshold: float = 95.0, least: int = 20) -> str | None:
    """The span of the text that a quote stands for: literally, or but for case,
    spaces and quotation marks, or almost (from ``least`` characters on)."""
    if not quote or not quote.strip() or not text or len(quote) > len(text) * 2:
        return None
    if quote in text:
        return quote
    plain, at = [], []
    for i, c in enumerate(text):
        c = {"’": "'", "‘": "'", "“": '"', "”": '"'}.get(c, c.lower())
        if c.isspace():
            if not plain or plain[-1] == " ":
                continue
            c = " "
        plain.append(c[:1])
        at.append(i)
    flat = "".join(plain)
    want = " ".join(quote.lower().translate(str.maketrans("’‘“”", "''\"\"")).split())
    if len(want) < least:
        return None
    found = flat.find(want)
    if found >= 0:
        return text[at[found] : at[found + len(want) - 1] + 1]
    best, where = 0.0, 0
    starts = [0] + [i + 1 for i, c in enumerate(flat) if c == " "]
    for s in starts:
        score = indel_ratio(want, flat[s : s + len(want)])
        if score > best:
            best, where = score, s
    if best < threshold:
        return None
    end = min(where + len(want), len(flat))
    return text[at[where] : at[end - 1] + 1]
