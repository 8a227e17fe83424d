"""Transcript parsing with a hidden Markov model, and canonical chat rendering.

A raw transcript is a text of lines in which speakers are named by markers of
many styles, or not at all. Its lines are the observations: the kind of marker,
whether a blank line stands before, whether the line asks, how long it is. The
states are the three roles, each at the beginning of a turn or inside it. The
model's tables are counts over transcripts whose roles are known; they have a
fixed size. Viterbi gives the roles, and turns are rendered as
``<|role|>`` lines followed by the text without its marker.

Transcripts are parsed one by one. Those of a table of turns are built in parts
of PART turns at most, so that no conversation has to fit into one task.

Blank lines inside a turn stay; those before and after it part the turns and go.

Defined cases: null and empty transcripts have no turns and render as an empty
text. A turn without text is a marker alone, which parses as a turn without text.
Rows that repeat a conversation's turn in every column are one turn; turns that share
a number stay in the order of their text. A null number comes first; rows without
conv_id are transcripts of one turn each. A role that is not known is taken as user in
the counts. Empty tables give no rows."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
ALIASES = {
    "system": ("system", "context", "instructions", "setup"),
    "user": ("user", "human", "question", "q", "me", "prompt"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model"),
}
#: Styles of markers, by role in the order of ROLES.
STYLES = (("System: ", "User: ", "Assistant: "), ("[system] ", "[user] ", "[assistant] "), ("### Context: ", "### Human: ", "### AI: "), ("Setup - ", "Q - ", "A - "), ("**Instructions:** ", "**Me:** ", "**Bot:** "))
PART = 64
MARKERS, LENGTHS = 5, 4  # none, the three roles, an unknown name; by length of the line
SYMBOLS = MARKERS * 2 * 2 * LENGTHS
STATES = 2 * len(ROLES)
_NAMES = {name: i + 1 for i, role in enumerate(ROLES) for name in ALIASES[role]}
_MARKER = re.compile(r"^\s*(?:[#*>\[(<|]{0,4}\s*)([A-Za-z]{1,12})\s*(?:[\])>|*]{0,3}\s*(?::\**|[-–](?=\s))|[\])>|]{1,3})[ \t]?")


def marker(line: str) -> tuple[int, int]:
    """Kind of the marker that a line begins with (0: none) and its length."""
    m = _MARKER.match(line)
    return (_NAMES.get(m[1].lower(), MARKERS - 1), m.end()) if m else (0, 0)


def observe(text: str) -> tuple[list[str], list[int], np.ndarray, list[list[str]]]:
    """Lines with a word, where their text begins, their symbols, and the blank lines
    before them."""
    lines, begins, symbols, blanks, blank, skipped = [], [], [], [], True, []
    for line in text.split("\n"):
        if not line.strip():
            blank = True
            skipped.append(line)
            continue
        kind, begin = marker(line)
        size = len(line) - begin
        symbol = kind * 2 + blank
        symbol = (symbol * 2 + line.rstrip().endswith("?")) * LENGTHS + (0 if size < 40 else 1 if size < 120 else 2 if size < 300 else 3)
        lines.append(line)
        begins.append(begin)
        symbols.append(symbol)
        blanks.append(skipped)
        blank, skipped = False, []
    return lines, begins, np.array(symbols, np.int64), blanks


class Hmm:
    """Log tables of the start, the steps and the symbols."""

    def __init__(self, start: np.ndarray, steps: np.ndarray, emits: np.ndarray):
        logs = lambda x, axis: np.log(x / x.sum(axis=axis, keepdims=True))
        begins = np.arange(STATES) % 2 == 0
        own = np.eye(STATES, dtype=bool) | (np.arange(STATES)[:, None] + 1 == np.arange(STATES)) & begins[:, None]
        allowed = begins[None, :] | own  # inside a turn only after its own beginning or inside
        self.start = logs(np.where(begins, start + 0.5, 1e-9), 0)
        self.steps = logs(np.where(allowed, steps + 0.5, 1e-9), 1)
        self.emits = logs(emits + 0.1, 1)

    def viterbi(self, symbols: np.ndarray) -> np.ndarray:
        """The likeliest states."""
        n = len(symbols)
        back = np.zeros((n, STATES), np.int8)
        score = self.start + self.emits[:, symbols[0]]
        for t in range(1, n):
            options = score[:, None] + self.steps
            back[t] = options.argmax(axis=0)
            score = options.max(axis=0) + self.emits[:, symbols[t]]
        states = np.zeros(n, np.int64)
        states[-1] = score.argmax()
        for t in range(n - 1, 0, -1):
            states[t - 1] = back[t, states[t]]
        return states


def parse(text: str | None, model: Hmm) -> tuple[list[tuple[str, str]], np.ndarray]:
    """Turns (role, text) of a transcript, and the role of each line."""
    lines, begins, symbols, blanks = observe(text or "")
    if not lines:
        return [], np.zeros(0, np.int64)
    states = model.viterbi(symbols)
    turns: list[tuple[str, list[str]]] = []
    for line, begin, state, gap in zip(lines, begins, states.tolist(), blanks, strict=True):
        if state % 2 == 0:
            turns.append((ROLES[state // 2], [line[begin:]]))
        else:
            turns[-1][1].extend([*gap, line])
    return [(role, "\n".join(own)) for role, own in turns], states // 2


def render(turns: list[tuple[str, str]]) -> str:
    """Canonical text of turns."""
    return "".join(f"<|{role}|>\n{text}\n" for role, text in turns)


def fit(transcripts: DataFrame) -> Hmm:
    """Count (text, truth), truth being 2 * role + inside for each line with a word."""
    cells = STATES + STATES * STATES + STATES * SYMBOLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cells, np.int64)
        for batch in batches:
            for text, truth in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                symbols, states = observe(text or "")[2], np.array(truth or [], np.int64)
                if not len(states) or len(symbols) != len(states):
                    continue
                table[states[0]] += 1
                np.add.at(table, STATES + states[:-1] * STATES + states[1:], 1)
                np.add.at(table, STATES + STATES * STATES + states * SYMBOLS + symbols, 1)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(table[at])], names=["cell", "n"])

    summed = transcripts.select("text", "truth").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(cells)
    for r in summed:
        table[r["cell"]] = r["n"]
    a, b = STATES, STATES + STATES * STATES
    return Hmm(table[:a], table[a:b].reshape(STATES, STATES), table[b:].reshape(STATES, SYMBOLS))


def build_transcripts(turns: DataFrame, unmarked: int = 12, part: int = PART) -> DataFrame:
    """``conv_id, part, text, truth`` of a table of turns (conv_id, turn, role,
    text): each conversation in one of STYLES, and of its turns, but for each
    part's first, about ``unmarked`` in a hundred without a marker."""
    role = lambda c: F.when(c == "system", 0).when(c == "assistant", 2).otherwise(1)
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("_one"))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / part), F.lit(0)))
    count = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > part)  # more turns than numbers: dealt out by hash
    rows = rows.join(count.withColumnsRenamed({"conv_id": "_c", "part": "_p"}), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")), "left")
    deal = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).when(F.col("n").isNotNull(), F.pmod(F.xxhash64("turn", "text"), F.ceil(F.col("n") / part))).otherwise(0)
    rows = rows.withColumn("deal", deal).withColumn("h", F.pmod(F.xxhash64("conv_id", "turn", "text", F.lit(3)), F.lit(100)))
    grouped = rows.groupBy("conv_id", "part", "deal").agg(F.array_sort(F.collect_list(F.struct("turn", role(F.col("role")).alias("role"), "text", "h"))).alias("turns"))

    @F.pandas_udf("struct<text string, truth array<int>>")
    def write(style: pd.Series, turns: pd.Series) -> pd.DataFrame:
        out = []
        for s, all_turns in zip(style, turns, strict=True):
            texts, truth = [], []
            for i, t in enumerate(all_turns):
                own = t["text"] if t["text"].strip() else ""
                full = (STYLES[s][t["role"]] if i == 0 or t["h"] >= unmarked or not own else "") + own
                texts.append(full)
                truth += [2 * t["role"]] + [2 * t["role"] + 1] * (sum(1 for x in full.split("\n") if x.strip()) - 1)
            out.append(("\n\n".join(texts), truth))
        return pd.DataFrame(out, columns=["text", "truth"])

    style = F.pmod(F.xxhash64("conv_id", F.lit(17)), F.lit(len(STYLES))).cast("int")
    return grouped.select("conv_id", F.struct("part", "deal").alias("at"), write(style, F.col("turns")).alias("w")).select("conv_id", F.col("at.part").alias("part"), F.col("at.deal").alias("deal"), "w.text", "w.truth")


def parse_transcripts(transcripts: DataFrame, model: Hmm, keep: list[str], text: str = "text", truth: Column | None = None) -> DataFrame:
    """The kept columns, with ``n_lines, n_turns, roles, rendered`` and, given the
    true states of the lines, ``n_right``: lines whose role was recovered."""

    @F.pandas_udf("struct<n_lines long, n_turns long, roles string, rendered string, n_right long>")
    def run(texts: pd.Series, truths: pd.Series) -> pd.DataFrame:
        out = []
        for t, known in zip(texts, truths, strict=True):
            turns, roles = parse(t, model)
            right = None if known is None else int((np.array(known, np.int64) // 2 == roles).sum()) if len(known) == len(roles) else 0
            out.append((len(roles), len(turns), ",".join(r for r, _ in turns), render(turns), right))
        frame = pd.DataFrame(out, columns=["n_lines", "n_turns", "roles", "rendered", "n_right"])
        return frame.astype({"n_right": "Int64"})

    known = truth if truth is not None else F.lit(None).cast("array<int>")
    return transcripts.select(*keep, run(F.col(text), known).alias("r")).select(*keep, "r.*")
