"""Text expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of personal data, in the order in which they are replaced.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = r"(?i)(?:https?://|www\.)\S+"
GROUPED_ID = r"\b\d{4}[\s-]\d{4}[\s-]\d{4}\b"
BARE_ID = r"(?<!\d)\d{12}(?!\d)"
PASSPORT = r"\b[A-Z][0-9]{7}\b"
KIN = ("sister", "brother", "mom", "mother", "dad", "father", "wife", "husband", "son", "daughter", "friend", "colleague", "aunt", "uncle")
# Function words by language, for the guess.
FUNCTION_WORDS = {
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "was"),
    "es": ("el", "que", "los", "se", "del", "las", "por", "un", "con", "una"),
    "fr": ("le", "et", "les", "des", "du", "une", "est", "dans", "qui", "pour"),
}


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def phrase_match(text: Column, phrases: list[str]) -> Column:
    """Whether any phrase stands in the text as whole words. The U flag makes \\w
    cover letters of all scripts."""
    import re

    longest_first = "|".join(re.escape(p.lower().replace("’", "'")) for p in sorted(phrases, key=len, reverse=True))
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), "’‘`", "'''").rlike(rf"(?iU)(?<!\w)(?:{longest_first})(?!\w)")


def normalize_space(text: Column) -> Column:
    """Odd spaces to plain ones, zero-width marks out, lines trimmed, one blank line at most."""
    out = F.regexp_replace(text, " ", " ")
    out = F.regexp_replace(out, "[​-‍﻿]", "")
    out = F.regexp_replace(out, "[ \\t]*\\n[ \\t]*", "\n")
    return F.trim(F.regexp_replace(F.regexp_replace(out, "\\n{3,}", "\n\n"), "[ \\t]+", " "))


def redact(text: Column) -> tuple[Column, Column]:
    """Text with e-mails, URLs and ids replaced, and how many there were."""
    out, count = text, F.lit(0)
    for pattern, mark in ((EMAIL, "[EMAIL]"), (URL, "[URL]"), (GROUPED_ID, "[ID]"), (BARE_ID, "[ID]"), (PASSPORT, "[ID]")):
        count = count + F.regexp_count(out, F.lit(pattern))
        out = F.regexp_replace(out, pattern, mark)
    return out, count


def language_guess(text: Column) -> Column:
    """The language whose function words are met most often (ties by name); null if none is."""
    every = "|".join(w for known in FUNCTION_WORDS.values() for w in known)
    met = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"(?<![\p{{L}}\p{{N}}])({every})(?![\p{{L}}\p{{N}}])"), F.lit(1))

    def best(found: Column) -> Column:
        count = lambda known: F.size(F.filter(found, lambda w: w.isin(*known)))
        scored = [F.struct(count(FUNCTION_WORDS[lang]).alias("n"), F.lit(-i).alias("i"), F.lit(lang).alias("lang")) for i, lang in enumerate(sorted(FUNCTION_WORDS))]
        return F.array_max(F.filter(F.array(*scored), lambda s: s["n"] > 0))["lang"]

    return F.element_at(F.transform(F.array(met), best), 1)  # the text is searched once, the words met are few


def eligibility(text: Column, language: Column, least_words: int, keyword: Column) -> Column:
    """Why a text is left out, or null: the first of the reasons in order."""
    bare = F.coalesce(text, F.lit(""))
    n = F.size(words(bare))
    return (
        F.when(~bare.rlike(r"[\p{L}\p{N}]"), "emoji_only")
        .when(F.trim(bare) == "", "empty")
        .when(language.isNull() | (language != "en"), "language")
        .when((n < least_words) & ~keyword, "min_words")
    )


def normalize_cue(text: Column) -> Column:
    """Lower-cased, without punctuation at the ends and leading articles, however often
    they alternate."""
    plain = F.regexp_replace(F.translate(F.lower(F.coalesce(text, F.lit(""))), "’‘`“”", "'''\"\""), r"\s+", " ")
    ends = r"[\s\"'.,;:!?()\[\]]"
    return F.regexp_replace(F.regexp_replace(plain, rf"{ends}+$", ""), rf"^(?:{ends}+|(?:my|the|a|an|some|that|this)\s+)+", "")


def spreadsheet_cell(value: Column, limit: int = 50_000) -> Column:
    """Cut with a mark, and guarded against formulas; empty for null."""
    own = F.coalesce(value.cast("string"), F.lit(""))
    own = F.when(F.length(own) <= limit, own).otherwise(F.concat(F.rtrim(F.substring(own, 1, limit - len(" [truncated]") - 2)), F.lit(" [truncated]")))
    return F.when(own.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), own)).otherwise(own)


def redact_names(text: Column) -> Column:
    """Names after words of kinship."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"\b([Mm]y|[Oo]ur)\s+({'|'.join(KIN)})\s+[A-Z][a-z]+\b", "$1 $2 [name]")


def titleize(value: Column) -> Column:
    return F.initcap(F.regexp_replace(value, "[_-]+", " "))


def estimate_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4))
