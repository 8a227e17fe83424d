"""Severity of abuse by cumulative-link ordinal regression.

Features are a text's words and their first four and five letters. Those that
the toxic rows of the bounded labelled sample hold far more often than the
others are selected, and a document is the sparse vector of log counts of them.
The labels say only whether a row is toxic, so the grades to fit are 0 for rows
that are not, and 1, 2 or 3 by the number of abusive words for those that are
(up to 2, up to 6, more). So that no row is graded by what it taught, the sample
is cut in two by hash, and the abusive words of a row are those that the *other*
half's features mark. One weight vector is shared by all thresholds: P(grade >=
k) = sigmoid(w.x - t_k) with t_1 < t_2 < t_3; the expected severity is the sum
of the three.

Defined cases: null and empty texts have no features and get the base severity.
Without toxic labels no feature is selected and nothing is toxic. An empty table
gives no rows. Whole texts are read, at any length."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.labels import LIMIT, labelled_texts
from gleaner.scratch import Scratch

GRADES = 3
#: What a feature must show to be selected; the sample bounds their number.
LEAST_ROWS, LEAST_LIFT = 5, 8.0
HALVES = 2
_WORD = re.compile(r"\w+")


def parts(word: str) -> list[str]:
    """Features of a word: itself, and what it starts with."""
    return [word, *(f"{word[:n]}-" for n in (4, 5) if len(word) > n)]


def word_counts(text: bytes | None) -> Counter[str]:
    return Counter(_WORD.findall((text or b"").decode("utf-8", "replace").lower()))


def select_features(labelled: DataFrame) -> list[list[str]]:
    """Features that mark toxic rows of (text, label, half), strongest first: of each
    half by itself, and last of both together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = defaultdict(lambda: [0] * 2 * HALVES)
        for batch in batches:
            for text, label, half in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for part in {p for w in word_counts(text.as_py()) for p in parts(w)}:
                    seen[part][2 * half + (label > 0)] += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(2 * HALVES))], names=["part", *columns])

    columns = [f"{kind}{half}" for half in range(HALVES) for kind in ("plain", "toxic")]
    found = labelled.select("text", "label", "half").mapInArrow(run, "part string, " + ", ".join(f"{c} long" for c in columns))
    found = found.groupBy("part").agg(*[F.sum(c).alias(c) for c in columns]).where(sum(F.col(f"toxic{h}") for h in range(HALVES)) >= LEAST_ROWS)
    sizes = {(r["half"], r["toxic"]): r["n"] for r in labelled.groupBy("half", (F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    rows, out = found.toPandas(), []
    for halves in ([0], [1], [0, 1]):
        toxic, plain = (sum(rows[f"{kind}{h}"].astype("int64") for h in halves) for kind in ("toxic", "plain"))
        of_toxic, of_plain = (sum(sizes.get((h, t), 0) for h in halves) for t in (True, False))
        lift = ((toxic + 0.5) / (of_toxic + 1)) / ((plain + 0.5) / (of_plain + 1))
        strong = rows.assign(strength=toxic * np.log(lift))[(toxic >= LEAST_ROWS) & (lift >= LEAST_LIFT)]
        out.append(strong.sort_values(["strength", "part"], ascending=[False, True])["part"].tolist())
    return out


class Lookup:
    """Finds selected features in texts, remembering words for as long as memory allows."""

    def __init__(self, features: list[str], remember: int = 300_000):
        self.index, self.memo, self.remember = {f: i for i, f in enumerate(features)}, {}, remember

    def __call__(self, text: bytes | None) -> tuple[dict[int, int], int]:
        """Counts of the features, and of the words that have any."""
        counts, abusive, memo, index = {}, 0, self.memo, self.index
        for word, n in word_counts(text).items():
            own = memo.get(word)
            if own is None:
                if len(memo) >= self.remember:
                    memo.clear()
                own = memo[word] = tuple(index[p] for p in parts(word) if p in index)
            if own:
                abusive += n
                for i in own:
                    counts[i] = counts.get(i, 0) + n
        return counts, abusive


def grade_of(toxic: int, abusive: int) -> int:
    """Grade of a labelled row."""
    return 0 if not toxic else 1 if abusive <= 2 else 2 if abusive <= 6 else 3


def fit(rows: list[tuple[list[int], list[float], int]], n_features: int, steps: int = 400, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the cumulative-link likelihood."""
    sizes = np.array([len(r[0]) for r in rows], np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    col = np.fromiter((i for r in rows for i in r[0]), np.int64, int(sizes.sum()))
    val = np.fromiter((v for r in rows for v in r[1]), np.float64, int(sizes.sum()))
    y = np.array([r[2] for r in rows], np.int64)
    w, raw = np.zeros(n_features), np.array([0.0, *np.zeros(GRADES - 1)])  # thresholds: first, then log gaps
    params = np.concatenate((w, raw))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, first, gaps = params[:n_features], params[n_features], np.exp(params[n_features + 1 :])
        t = np.concatenate(([first], first + np.cumsum(gaps)))
        z = np.bincount(row, val * w[col], minlength=len(rows))
        above = np.concatenate((np.ones((1, len(rows))), 1 / (1 + np.exp(-(z - t[:, None]))), np.zeros((1, len(rows)))))
        slope = above * (1 - above)
        at = np.arange(len(rows))
        p = np.maximum(above[y, at] - above[y + 1, at], 1e-12)
        dz = (slope[y, at] - slope[y + 1, at]) / p
        dt = np.array([(-np.where(y == k, slope[k], 0) + np.where(y == k - 1, slope[k], 0)) @ (1 / p) for k in range(1, GRADES + 1)])
        grad = np.concatenate((np.bincount(col, val * dz[row], minlength=n_features), [dt.sum()], [dt[k:].sum() * gaps[k - 1] for k in range(1, GRADES)])) / len(rows)
        grad[:n_features] -= ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    first, gaps = params[n_features], np.exp(params[n_features + 1 :])
    return params[:n_features], np.concatenate(([first], first + np.cumsum(gaps)))


class Grader:
    """The fitted regression."""

    def __init__(self, docs: DataFrame, labels: DataFrame, limit: int = LIMIT, scratch: Scratch | None = None):
        scratch = scratch or Scratch(docs.sparkSession, "severity")
        half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(HALVES)).cast("int").alias("half")
        labelled = scratch.write(labelled_texts(docs, labels, "toxic", limit).select("text", "label", half), "labelled")
        *of_halves, self.features = select_features(labelled)
        features = self.features

        @F.pandas_udf("struct<at array<int>, n array<double>, abusive int>")
        def vector(texts: pd.Series, halves: pd.Series) -> pd.DataFrame:
            look, others = Lookup(features), [Lookup(f) for f in of_halves]
            found = [look(t)[0] for t in texts]
            abusive = [others[1 - h](t)[1] for t, h in zip(texts, halves, strict=True)]
            return pd.DataFrame({"at": [list(c) for c in found], "n": [list(np.log1p(list(c.values()))) for c in found], "abusive": abusive})

        rows = labelled.select(vector("text", "half").alias("x"), "label").select("x.*", "label").collect() if features else []
        sample = [(r["at"], r["n"], grade_of(r["label"] > 0, r["abusive"])) for r in rows]
        self.weights, self.thresholds = fit(sample, len(features)) if sample else (np.zeros(0), np.arange(5.0, 5.0 + GRADES))
        scratch.drop(labelled)

    def graded(self, docs: DataFrame) -> DataFrame:
        """``doc_id, expected_severity, grade, toxic, n_abusive`` of each row."""
        features, weights, thresholds = self.features, self.weights, self.thresholds

        @F.pandas_udf("struct<expected_severity double, grade int, toxic boolean, n_abusive long>")
        def grade(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            look = Lookup(features)
            for texts in batches:
                found = [look(t) for t in texts]
                z = np.array([sum(weights[i] * np.log1p(n) for i, n in c.items()) for c, _ in found], np.float64)
                above = 1 / (1 + np.exp(-(z[:, None] - thresholds)))
                yield pd.DataFrame({"expected_severity": above.sum(axis=1), "grade": (above >= 0.5).sum(axis=1).astype("int32"), "toxic": above[:, 0] >= 0.5, "n_abusive": [a for _, a in found]})

        return docs.select("doc_id", grade(F.col("text").cast("binary")).alias("g")).select("doc_id", "g.*")


def severity(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Fit on the labelled sample and grade every row of docs."""
    return Grader(docs, labels, limit).graded(docs)
