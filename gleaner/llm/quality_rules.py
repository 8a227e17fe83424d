"""Quality rules: base counts, and divergence from language references.

For each language of the table two reference distributions are built from whole
texts of all its documents: over character classes, and over its COMMON most
common words and all others. A document is compared with those of its language
by the Jensen-Shannon distance (base 2), characters only from MIN_CHARS
characters on and words only from MIN_WORDS words on; the limits fall with the
length, as a short text strays by chance. The references are those of the corpus
as it is, its junk included. A language of fewer than REFERENCE words, and the
null language, are compared with all languages together.

One reading of the texts counts every word of every language exactly; a task
hands its counts on whenever it holds ROOM words. The judging is a second one.
References of LANGUAGES languages are held at once, more go in blocks.

Defined cases: a null or empty text has no words, fails the base rule and is not
kept. Rows are judged one by one, repeated ids too. An empty table gives no
rows. Whole texts are read, at any length."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

SYMBOLS = "#*$%&|<>"
COMMON = 50
#: Words of a language that make a reference.
REFERENCE = 10_000
#: Words that a task counts before it hands them on; languages whose references are held at once.
ROOM, LANGUAGES = 500_000, 10_000
MIN_CHARS, MIN_WORDS = 200, 60
#: Largest distances of characters and words, and what short texts get on top:
#: the slack over the root of the number of characters or words.
MAX_CHARS, CHAR_SLACK = 0.2, 1.5
MAX_WORDS, WORD_SLACK = 0.18, 2.5

# character classes: lower, upper, other letters, digits, space, line end, punctuation, symbols, others
_TABLE = np.full(0x10000, 8, np.uint8)
for _i in range(0x10000):
    _c = chr(_i)
    if _c.isalpha():
        _TABLE[_i] = 0 if _c.islower() else 1 if _c.isupper() else 2
    elif _c.isdigit():
        _TABLE[_i] = 3
_TABLE[[ord(c) for c in " \t"]] = 4
_TABLE[[ord(c) for c in "\n\r\x0b\x0c"]] = 5
_TABLE[[ord(c) for c in ".,;:!?'\"()-"]] = 6
_TABLE[[ord(c) for c in "#*$%&|<>=+~^_@/\\[]{}"]] = 7
CLASSES = 9


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_TABLE[np.minimum(codes, 0xFFFF)], minlength=CLASSES)


def repeat_words(words: list[bytes], window: int = 5) -> int:
    """Words that lie in a window found twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if len(known) == len(words):
        return 0
    pair = lambda a, b: np.unique(a * (b.max() + 1) + b, return_inverse=True)[1]  # noqa: E731  ids of joined windows, exact
    two = pair(ids[:-1], ids[1:])
    four = pair(two[:-2], two[2:])
    five = pair(four[:-1], ids[4:])
    starts = np.flatnonzero(np.bincount(five)[five] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(words), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeat_words(words)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors, 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda a: float((a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum())
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def word_counts(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """``lang, slot, word, n``: of each language its characters by class (slot), its
    words in all (slot CLASSES) and each of its words (slot -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str | None, Counter[str]] = {}
        classes: dict[str | None, np.ndarray] = {}

        def rows() -> pa.RecordBatch:
            out = [(lang, i, "", int(n)) for lang, own in classes.items() for i, n in enumerate(own) if n]
            out += [(lang, CLASSES, "", own.total()) for lang, own in words.items()]
            out += [(lang, -1, w, n) for lang, own in words.items() for w, n in own.items()]
            words.clear()
            classes.clear()
            types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["lang", "slot", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text := text.as_py():
                    text = text.decode("utf-8", "replace")
                    words.setdefault(lang, Counter()).update(text.lower().split())
                    classes.setdefault(lang, np.zeros(CLASSES, np.int64))
                    classes[lang] += class_counts(text)
            if sum(map(len, words.values())) > room:
                yield rows()
        if words:
            yield rows()

    found = docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, "lang string, slot int, word string, n long")
    return found.groupBy("lang", "slot", "word").agg(F.sum("n").alias("n"))


Reference = tuple[np.ndarray, dict[str, int], np.ndarray]


def references(counts: DataFrame, common: int = COMMON) -> dict[str | None, Reference]:
    """For each language of the counts that is not null: counts of classes, its common
    words in order, and counts of these and of all others."""
    own = counts.where("lang is not null")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    best = own.where("slot = -1").withColumn("place", F.row_number().over(order)).where(F.col("place") <= common)
    rows = own.where("slot >= 0").withColumn("place", F.lit(0)).unionByName(best).orderBy("lang", "slot", "place").collect()
    classes, words, totals = {}, {}, {}
    for r in rows:
        if r["slot"] < 0:
            words.setdefault(r["lang"], []).append((r["word"], r["n"]))
        elif r["slot"] == CLASSES:
            totals[r["lang"]] = r["n"]
        else:
            classes.setdefault(r["lang"], np.zeros(CLASSES, np.int64))[r["slot"]] = r["n"]
    return {
        lang: (classes[lang], {w: i for i, (w, _) in enumerate(words.get(lang, []))}, np.array([*(n for _, n in words.get(lang, [])), total - sum(n for _, n in words.get(lang, []))]))
        for lang, total in totals.items()
    }


def judge(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, char_distance, word_distance`` of each row; a distance
    that was not measured is null."""
    scratch = scratch or Scratch(docs.sparkSession, "divergence")
    counts = scratch.write(word_counts(docs), "counts")
    pooled = counts.groupBy("slot", "word").agg(F.sum("n").alias("n")).withColumn("lang", F.lit("*"))
    pooled = references(scratch.write(pooled, "pooled")).get("*")
    large = scratch.write(counts.where((F.col("slot") == CLASSES) & (F.col("n") >= REFERENCE) & F.col("lang").isNotNull()).select("lang"), "languages")
    own, blocks = counts.join(large, "lang", "left_semi"), -(-large.count() // LANGUAGES)
    if blocks <= 1:
        return judged(docs, references(own), pooled)
    of = F.pmod(F.xxhash64(F.coalesce("lang", F.lit(""))), F.lit(blocks))
    return reduce(DataFrame.unionByName, [judged(docs.where(of == b), references(own.where(of == b)), pooled) for b in range(blocks)])


def judged(docs: DataFrame, known: dict[str | None, Reference], pooled: Reference | None) -> DataFrame:
    """The rows of docs by the references of their languages, or else the pooled one."""

    @F.pandas_udf("struct<n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double>")
    def rules(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        rows = []
        for raw, lang in zip(texts, langs, strict=True):
            text = raw.decode("utf-8", "replace") if raw is not None else None
            n, *rest = base_counts(text)
            failed = n < 10 or 100 * rest[-1] > 20 * n
            chars = words = None
            if not failed:
                classes, common, usual = known.get(lang) or pooled
                if len(text) >= MIN_CHARS:
                    chars = distance(class_counts(text), classes)
                if n >= MIN_WORDS:
                    own = np.zeros(len(usual))
                    found = Counter(text.lower().split())
                    for w in found.keys() & common.keys():
                        own[common[w]] = found[w]
                    own[-1] = found.total() - own.sum()
                    words = distance(own, usual)
            near = (chars is None or chars <= MAX_CHARS + CHAR_SLACK / len(text) ** 0.5) and (words is None or words <= MAX_WORDS + WORD_SLACK / n**0.5)
            rows.append((n, *rest, failed, not failed and near, chars, words))
        return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"])

    return docs.select("doc_id", rules(F.col("text").cast("binary"), F.col("lang")).alias("r")).select("doc_id", "r.*")
