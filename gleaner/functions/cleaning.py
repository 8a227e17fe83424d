"""The cleaning record of a text: what is shown, what is compared, its language,
and whether it goes on to the model."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import python_text
from gleaner.functions.text import BARE_ID, EMAIL, FUNCTION_WORDS, GROUPED_ID, PASSPORT, URL

# Function words that mark English, and romanized Hindi words that are rare in it.
ENGLISH = """the and my this that with have was were but not for you your from they them just when what it's its can't
don't very really because would could should about there their please""".split()
ROMANIZED_HINDI = """nahi nahin nhi hain mera meri mere mujhe kaise kyun kyon dhund dhundh dhoond dhoondh raha rahi rahe yaad
kahan kahaan kaha apna apni apne abhi mila mili gayi gaya gaye wala wali wale karo karna bhai yaar mein mujhko kripya dhundo
dhoondo""".split()
# First and last character of each script, and its language.
SCRIPTS = (
    (0x0900, 0x097F, "hi"), (0x0980, 0x09FF, "bn"), (0x0B80, 0x0BFF, "ta"), (0x0C00, 0x0C7F, "te"), (0x0C80, 0x0CFF, "kn"),
    (0x0D00, 0x0D7F, "ml"), (0x0600, 0x06FF, "ar"), (0x0400, 0x04FF, "ru"), (0x4E00, 0x9FFF, "zh"),
)
# Lines of site chrome.
CHROME = (
    "menu", "sign in", "sign in now", "sign up", "log in", "close", "skip to content", "skip to search", "skip to main content", "submenu",
    "informational notification", "this question has been marked as a duplicate", "this question has been marked as a duplicate.", "try again",
    "details", "locked", "[x]",
)
_CHECKBOX, _WRONG = re.compile(r"-\s*\[x\]", re.I), "something went wrong"


@dataclass(frozen=True)
class Rules:
    """What decides a record."""

    languages: tuple[str, ...] = ("en",)
    least_words: int = 5
    language_words: int = 4
    keywords: tuple[str, ...] = ()
    most_chars: int = 6000
    head_chars: int = 4000
    boilerplate: bool = False


def _phrases(phrases: tuple[str, ...]) -> re.Pattern[str] | None:
    own = sorted((re.escape(p.lower().replace("’", "'")) for p in phrases), key=len, reverse=True)
    return re.compile(rf"(?<!\w)(?:{'|'.join(own)})(?!\w)", re.I) if own else None


def spaced(text: str) -> str:
    """Plain spaces, trimmed lines, one blank line at most."""
    text = text.replace(" ", " ").translate({0x200B: None, 0xFEFF: None})
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[^\S\n]+", " ", text))
    return "\n".join(map(str.strip, text.splitlines())).strip()


def without_chrome(text: str) -> str:
    """Lines of a captured page that are its content: no chrome, and up to the first
    line of three words nothing but such lines."""
    kept: list[str] = []
    for line in map(str.strip, text.splitlines()):
        low = line.lower()
        if low in CHROME or low.startswith(_WRONG) or _CHECKBOX.fullmatch(line):
            continue
        if not kept:
            bare = re.sub(URL, "", python_text.without_links(line))
            if len(re.sub(r"[*#\-\[\]|]+", " ", bare).split()) < 3:
                continue
        kept.append(line)
    return "\n".join(kept)


def redact_all(text: str) -> tuple[str, int]:
    """Personal data replaced, ids before phones, and how much there was."""
    n = 0
    for pattern, mark in ((f"(?i)\\b{EMAIL}\\b", "[EMAIL]"), (URL, "[URL]"), (GROUPED_ID, "[ID]"), (BARE_ID, "[ID]"), (PASSPORT, "[ID]")):
        text, hits = re.subn(pattern, mark, text)
        n += hits
    text, hits = python_text.redact_phones(text)
    return text, n + hits


def language(text: str, least_words: int) -> tuple[str, float]:
    """Language and confidence: mixed with romanized Hindi, by script, English for short
    texts and by its function words, else by the function words of others."""
    tokens = [w for w in (x.strip(".,!?;:\"'()[]") for x in text.lower().split()) if w]
    mixed = sum(map(set(ROMANIZED_HINDI).__contains__, tokens))
    if mixed >= 2:
        return "code_mixed", 0.9 if mixed > 2 else 0.7
    letters = [c for c in text if c.isalpha()]
    if len(letters) >= 8:
        scripts = Counter(next((name for low, high, name in SCRIPTS if low <= ord(c) <= high), "latin" if c.isascii() else "other") for c in letters)
        name, n = scripts.most_common(1)[0]
        if name != "latin" and n >= 0.3 * len(letters):
            return name, 0.95
    if len(tokens) < least_words:
        return "en", 0.5
    plain = not letters or sum(map(str.isascii, letters)) >= 0.9 * len(letters)
    if plain and sum(map(set(ENGLISH).__contains__, tokens)) >= 2:
        return "en", 0.8
    hits = {lang: sum(map(set(known).__contains__, tokens)) for lang, known in FUNCTION_WORDS.items()}
    best = max(sorted(hits), key=hits.__getitem__)
    share = hits[best] / (sum(hits.values()) or 1)
    if best != "en" and hits[best] >= 2:
        return best, share
    return ("en", max(0.5, share)) if plain else ("unknown", 0.0)


def shortened(text: str, head: int, most: int, keywords: re.Pattern[str] | None) -> str:
    """The beginning to a word's end, and the later sentences that hold a keyword."""
    first = text[:head].rsplit(" ", 1)[0] if len(text) > head else text
    kept, size = [first.strip()], len(first.strip()) + 1
    for m in re.finditer(r".+?(?:[.!?](?=\s|$)|$)", text[len(first) :], re.S):
        if size >= most:
            break
        piece = m[0].strip()
        if piece and keywords and keywords.search(piece.lower().replace("’", "'")):
            kept.append(piece)
            size += len(piece) + 1
    out = "\n".join(filter(None, kept))
    return out if len(out) <= most else out[:most].rsplit(" ", 1)[0].rstrip()


FIELDS = "clean_text string, dedup_text string, language string, confidence double, code_mixed boolean, word_count long, eligible boolean, exclude_reason string, truncated boolean, n_redacted long"


def record(text: str | None, rules: Rules, keywords: re.Pattern[str] | None) -> tuple:
    """The fields of one text; a null text is an empty one."""
    bare = python_text.strip_markup(text or "")
    if rules.boilerplate:
        bare = without_chrome(bare)
    said, n_redacted = redact_all(spaced(python_text.name_emoji(bare)))
    plain, _ = redact_all(spaced(python_text.without_emoji(bare)))
    said, plain = spaced(said), spaced(plain)
    folded = " ".join(re.sub(r"[^\w\s']", " ", plain.lower().translate({0x2019: "'", 0x2018: "'", 0x60: "'"})).split())
    n_words = len(plain.split())
    lang, confidence = language(plain, rules.language_words) if plain else ("en", 0.5)
    truncated = len(said) > rules.most_chars
    if truncated:
        said = shortened(said, rules.head_chars, rules.most_chars, keywords)
    hit = bool(keywords and keywords.search(plain.lower().replace("’", "'")))
    reason = (
        "emoji_only" if not any(map(str.isalnum, python_text.without_emoji(bare)))
        else "empty" if not said or not n_words
        else "code_mixed" if lang == "code_mixed"
        else "language" if lang not in rules.languages
        else "min_words" if n_words < rules.least_words and not hit
        else None
    )
    return said, folded, lang, confidence, lang == "code_mixed", n_words, reason is None, reason, truncated, n_redacted


def clean_record(text: Column, rules: Rules) -> Column:
    """The record of a text column, by Arrow batches."""

    @F.pandas_udf(f"struct<{', '.join(x.replace(' ', ':', 1) for x in FIELDS.split(', '))}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        keywords = _phrases(rules.keywords)
        for texts in batches:
            yield pd.DataFrame([record(t, rules, keywords) for t in texts], columns=[x.split()[0] for x in FIELDS.split(", ")])

    return run(text)


def scrub_names(metadata: str | None, names: frozenset[str]) -> tuple[str | None, list[str]]:
    """JSON without the keys that hold user names, at any depth, and their values."""
    import json

    removed: list[str] = []

    def walk(x: object) -> object:
        if isinstance(x, list):
            return [walk(v) for v in x]
        if not isinstance(x, dict):
            return x
        removed.extend(v.strip() for k, v in x.items() if k.lower() in names and isinstance(v, str) and v.strip())
        return {k: walk(v) for k, v in x.items() if k.lower() not in names}

    try:
        return (None if metadata is None else json.dumps(walk(json.loads(metadata)), ensure_ascii=False, separators=(",", ":"))), removed
    except ValueError:
        return metadata, []


#: Keys of metadata that hold user names (fixed values).
USERNAME_KEYS = frozenset("username user_name user author author_name reviewer handle screen_name displayname display_name".split())


def scrubbed(metadata: Column) -> Column:
    """``struct<metadata, removed>``; texts that are no JSON stay as they are."""

    @F.pandas_udf("struct<metadata string, removed array<string>>")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scrub_names(v, USERNAME_KEYS) for v in values], columns=["metadata", "removed"])

    return run(metadata)
