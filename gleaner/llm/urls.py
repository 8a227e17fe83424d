"""URL filters: explicit rules first, then naive Bayes over segmented names.

Labels of a host and parts of a path are often words run together; they are
split by the unigram Viterbi path, with word counts gathered from the text of
all pages and a list of common web words. Counts, names and their words stay
distributed: every distinct name is brought together with the counted words that
it holds, is split once, and its words go back to the urls that have it.
Multinomial naive Bayes then scores the words of host and path. It is trained on
all pages with weak labels: a page whose host has a word of SEEDS counts as one
to block. Words are hashed into a fixed number of slots, so the counts have a
bounded size.

Defined cases: words and names are runs of letters of any script, lower-cased;
digits and marks part them. Segments have LONGEST letters at most, and one letter
alone is no known word. A null url, and one without ``://``, has empty host and
path, fits no rule and is allowed. Rows are judged one by one, repeated ids too;
null page ids are returned as null. An empty table gives no rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.scratch import Scratch

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Words of hosts that mark pages to block, for the weak labels.
SEEDS = tuple("adult ads bet bets betting bitcoin casino cheap crack escort gambling hack jackpot loan loans lottery payday pills poker porn sex slots spam torrent viagra warez xxx".split())
#: Common words of names on the web, for the segmentation.
WEB_WORDS = tuple("about account app article articles best blog blogs book books buy care city cloud club code com community contact data day design dev docs download edu english farm food forum forums free game games go guide health help home host hotel html index info item learn life link links list live local mail map media menu mobile money movie music net network new news office online open page pages photo play post posts press product products read review reviews school science search server service shop site sites social software sport sports store story stream support tag team tech time tips top track travel user video video view web wiki win work world".split())
#: Letters of the longest word.
LONGEST = 32
SLOTS = 1 << 16
#: A listed word counts as one of so many words at least.
LISTED = 2000
#: Added to the count of every slot that was seen.
SMOOTH = 0.1
_PARTS = re.compile(r"[^\W\d_]+")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _UPPER.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (ties: the first in order) and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, fate in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest comes last and is tried first
        own, slash, prefix = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(fate)).otherwise(verdict)
    return rule, verdict


def host_names(host: str) -> list[str]:
    labels = host.split(".")[:-1] if "." in host else [host]  # the last label says nothing of content
    return [p for x in labels for p in _PARTS.findall(x.lower())]


def path_names(path: str) -> list[str]:
    return _PARTS.findall(path.lower())


def counted_words(pages: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, float]:
    """``word, n`` of whole texts of all pages, in which listed words count as one in
    LISTED at least; their sum, and the score of a word not counted, before its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for html in batch.column(0):
                counts.update(_PARTS.findall(re.sub(r"<[^>]*>", " ", (html.as_py() or b"").decode("utf-8", "replace")).lower()))
            found = [(w, n) for w, n in counts.items() if 1 < len(w) <= LONGEST]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.int64()), strict=True)], names=["word", "n"])

    found = pages.select(F.col("html").cast("binary")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = scratch.write(found, "words")
    total, least = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.min("n"), F.lit(1))).head()
    listed, floor = sorted({*WEB_WORDS, *SEEDS}), max(1, total // LISTED)
    known = {r["word"]: r["n"] for r in found.where(F.col("word").isin(listed)).collect()}
    raised = {w: max(known.get(w, 0), floor) for w in listed}
    total += sum(n - known.get(w, 0) for w, n in raised.items())
    listed = pages.sparkSession.createDataFrame(list(raised.items()), "word string, n long")
    return found.where(~F.col("word").isin(list(raised))).unionByName(listed), total, math.log10(min(least, floor) / total) - 1


def names_of(parsed: DataFrame) -> DataFrame:
    """``row, kind, place, name`` of every name of the hosts (kind 0) and paths (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out += [(row, kind, i, n) for kind, own in enumerate((host_names(host), path_names(path))) for i, n in enumerate(own)]
            if out:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["row", "kind", "place", "name"])

    return parsed.select("row", "host", "path").mapInArrow(run, "row long, kind int, place int, name string")


def segmented(names: DataFrame, words: DataFrame, total: int, unseen: float) -> DataFrame:
    """``name, words`` of distinct names: the likeliest path over the counted words."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                for at in range(0, len(n), 256):  # of long names, some beginnings at a time
                    found = list({n[i:j] for i in range(at, min(len(n), at + 256)) for j in range(i + 2, min(i + LONGEST, len(n)) + 1)})
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array([n] * len(found)), pa.array(found)], names=["name", "word"])

    @F.pandas_udf("array<string>")
    def split(names: pd.Series, known: pd.Series) -> pd.Series:
        own = ({} if k is None else {x["word"]: math.log10(x["n"] / total) for x in k} for k in known)
        return pd.Series([Segmenter(scores, unseen).split(n) for n, scores in zip(names, own, strict=True)])

    held = names.mapInArrow(parts, "name string, word string").join(words, "word").groupBy("name").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    return names.join(held, "name", "left").select("name", split("name", "known").alias("words"))


class Segmenter:
    """Unigram Viterbi: scores are log10 probabilities of words."""

    def __init__(self, scores: dict[str, float], unseen: float | None = None, longest: int = LONGEST):
        self.scores, self.longest = scores, longest
        self.unseen = min(scores.values(), default=0.0) - 1 if unseen is None else unseen

    def split(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                word = name[start:end]
                options.append((best[start] + self.scores.get(word, self.unseen - len(word)), start))
            score, start = max(options)
            best.append(score)
            back.append(start)
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]


def slots(host_words: list[str], path_words: list[str]) -> list[int]:
    return [zlib.crc32(f"{kind}{w}".encode()) % SLOTS for kind, own in (("h ", host_words), ("p ", path_words)) for w in own]


class Bayes:
    """Multinomial naive Bayes of two classes over slots."""

    def __init__(self, words: np.ndarray, rows: np.ndarray):
        seen = words.sum(axis=0) > 0
        smooth = words + SMOOTH
        totals = smooth[:, seen].sum(axis=1) if seen.any() else np.ones(2)
        # a slot never seen speaks for neither class
        self.logs = np.where(seen, np.log(smooth[1] / totals[1]) - np.log(smooth[0] / totals[0]), 0.0)
        self.prior = math.log((rows[1] + 1) / (rows[0] + 1))

    def odds(self, found: list[int]) -> float:
        """Log odds of block."""
        return self.prior + float(self.logs[found].sum()) if found else self.prior


def train(worded: DataFrame) -> Bayes:
    """From (host_words, path_words) of all pages."""
    seeds = frozenset(SEEDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows = np.zeros((2, SLOTS), np.int64), [0, 0]
        for batch in batches:
            for own, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                label = int(not seeds.isdisjoint(own or []))
                rows[label] += 1
                np.add.at(table[label], slots(own or [], more or []), 1)
        at = [np.flatnonzero(x) for x in table]
        out = [(k, int(i), int(table[k][i])) for k in (0, 1) for i in at[k]] + [(k, -1, rows[k]) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["label", "slot", "n"])

    summed = worded.select("host_words", "path_words").mapInArrow(run, "label long, slot long, n long").groupBy("label", "slot").agg(F.sum("n").alias("n")).toArrow()
    words, rows = np.zeros((2, SLOTS)), np.zeros(2)
    for label, slot, n in zip(*(summed.column(c).to_pylist() for c in ("label", "slot", "n")), strict=True):
        if slot < 0:
            rows[label] += n
        else:
            words[label, slot] += n
    return Bayes(words, rows)


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, scratch: Scratch | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, log_odds, words`` of each row."""
    scratch = scratch or Scratch(pages.sparkSession, "urls")
    host, path = split_url(F.col("url"))
    parsed = scratch.write(pages.select("page_id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row")), "parsed")
    names = scratch.write(names_of(parsed), "names")
    split = scratch.write(segmented(scratch.write(names.select("name").distinct(), "distinct"), *counted_words(pages, scratch)), "segmented")
    # written, so that the join is a stage of its own, in which a name that many urls share can be split
    met = scratch.write(names.join(split, "name").select("row", "kind", "place", "words"), "words-met")
    of = lambda k: F.flatten(F.transform(F.filter("all", lambda x: x["kind"] == k), lambda x: x["words"])).alias(("host_words", "path_words")[k])
    own = met.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "place", "words"))).alias("all")).select("row", of(0), of(1))
    worded = scratch.write(parsed.join(own, "row", "left"), "worded")
    scratch.drop(names, split, met)
    model = train(worded)

    @F.pandas_udf("double")
    def odds(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([model.odds(slots([] if h is None else h, [] if p is None else p)) for h, p in zip(hosts, paths, strict=True)], dtype="float64")

    rule, fate = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = worded.withColumn("rule", rule).withColumn("fate", fate).withColumn("log_odds", odds("host_words", "path_words"))
    method = F.when((F.col("host") != "") & (F.col("log_odds") > 0), "block").otherwise("allow")
    listed = F.concat_ws(" ", F.col("host_words"), F.lit("/"), F.col("path_words")).alias("words")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("fate", method).alias("verdict"), "log_odds", listed)
