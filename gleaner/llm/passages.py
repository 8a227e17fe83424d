"""Substring dedup by paragraph MinHash banding.

Paragraphs are of two kinds. Lines of ``min_line`` words or more get MinHash
signatures of their word shingles, with bands tuned for recall at the threshold;
lines that collide in a band are verified by the exact Jaccard similarity of
their shingle sets, and linked lines form components. A passage that was copied
into other text, or that is broken into short lines, fills no such line, so the
words of a text are also taken without regard to line ends: of every ANCHOR
consecutive runs of ANCHOR words the one with the least hash is an anchor. Every
run of 2 * ANCHOR - 1 words that two documents share has an anchor in both, and
the anchors of a longer one leave no gap. Runs of anchors are extended word by
word in both texts, over edits, as far as the Jaccard similarity of the aligned
spans (shingles in aligned equal blocks) stays at the threshold or above.

Of each component, and of equal anchors, the copies in the document with the
least id stay, and those in other documents go. What goes in a document is merged
into spans, over line ends too. A span counts if it has ``min_run`` words or more,
or if it is of whole lines and has ``min_line``. The first is for passages of over
50 words, less the 4 (a shingle's, but one) that an edit near either end can part
from them; what documents share in shorter pieces (licences, greetings, a sentence
quoted) stays.

Counts, joins and components are distributed; only colliding lines have their
texts brought together, in bounded groups (see links). Whole texts are read.

Defined cases: null and empty texts have no paragraphs. Rows with one doc_id are
one document (nothing in them is removed for another of them), all rows without
doc_id likewise, after all others. An empty table gives no rows."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.links import link, shared_keys
from gleaner.operators.components import connected_components
from gleaner.scratch import Scratch

MIN_LINE, MIN_RUN = 25, 42
SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.99
#: Words of an anchor, and of the positions of which one is an anchor.
ANCHOR = 10
#: Of an extension: words of one text between equal blocks, least words of a block
#: behind such a gap, and words of the other text that are brought along on either side.
GAP, MEET, FAR = 16, 3, 64
BLOCK = 128
NO_ID = (1 << 63) - 1

_U = np.uint64
_MIX, _STEP = _U(0x9E3779B97F4A7C15), 0xD1342543DE82EF95
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tune(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 6) -> tuple[int, int]:
    """Bands and rows: the most rows for which at most ``most`` bands reach the recall."""
    options = [(math.ceil(math.log(1 - recall) / math.log(1 - threshold**r)), r) for r in range(1, 9)]
    return max((o for o in options if o[0] <= most), key=lambda o: o[1], default=options[0])


def word_hashes(words: list[bytes]) -> np.ndarray:
    crc = zlib.crc32
    own = np.array([crc(w) for w in words], _U) * _MIX
    return (own ^ (own >> _U(29))) * _U(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 4096)
            grow = lambda base: np.multiply.accumulate(np.concatenate(([_U(1)], np.full(size - 1, base, _U))))
            self.up, self.down = grow(_U(_STEP)), grow(_U(pow(_STEP, -1, 1 << 64)))


_POWERS = _Powers()


def run_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of a text's word hashes, from which run_hashes takes its runs."""
    _POWERS.reach(len(hashes) + 1)
    return np.concatenate(([_U(0)], np.cumsum(hashes * _POWERS.up[: len(hashes)], dtype=_U)))


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of words, the same wherever it stands."""
    own = (sums[ends] - sums[starts]) * _POWERS.down[starts]
    own = (own ^ (own >> _U(31))) * _MIX + (ends - starts).astype(_U)
    return (own ^ (own >> _U(29))).view(np.int64)


def anchor_points(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions such that every ``window`` consecutive ones hold one with their least
    hash. Where that hash comes again and again, as in a word said a thousand times, no
    more of its places are taken than that needs."""
    if not len(grams):
        return np.empty(0, np.int64)
    seen = np.lib.stride_tricks.sliding_window_view(grams, min(window, len(grams)))
    found = np.unique(seen.argmin(axis=1) + np.arange(len(seen)))
    again = np.flatnonzero((grams[found[1:]] == grams[found[:-1]]) & (np.diff(found) <= window))
    if not len(again):
        return found
    keep = np.ones(len(found), bool)
    for i in again.tolist():  # found[i + 1] repeats found[i]
        if not keep[i]:
            continue
        j = i + 1
        while j + 1 < len(found) and grams[found[j + 1]] == grams[found[i]] and found[j + 1] <= found[i] + window:
            keep[j] = False
            j += 1
    return found[keep]


def line_bounds(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words of a text, lower-cased as ASCII, and the first word of each line, and the end."""
    words, starts = [], [0]
    for line in text.lower().split(b"\n"):
        own = line.split()
        if own:
            words += own
            starts.append(len(words))
    return words, np.array(starts, np.int64)


def signer(bands: int, rows: int, seed: int = 5):
    """Band keys of a line's shingle hashes."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, bands * rows, dtype=_U)[:, None] * _U(2) + _U(1)
    b = rng.integers(1, 1 << 63, bands * rows, dtype=_U)[:, None]

    def sign(shingles: np.ndarray) -> np.ndarray:
        mixed = shingles * a + b
        least = (mixed ^ (mixed >> _U(32))).min(axis=1).reshape(bands, rows)
        key = np.arange(1, bands + 1, dtype=_U)
        for i in range(rows):
            key = (key ^ least[:, i]) * _MIX
            key ^= key >> _U(32)
        return key.view(np.int64)

    return sign


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), F.xxhash64("doc_id", "text").alias("rk"), F.col("text").cast("binary").alias("text"))


def pieces(docs: DataFrame, min_line: int = MIN_LINE, threshold: float = THRESHOLD, shingle: int = SHINGLE, size: int = ANCHOR) -> DataFrame:
    """``uid, d, rk, s, n, check, bands, line``: every line of min_line words or more,
    and every anchor (n = 0, check = 0, without bands and line), from one reading of the texts."""
    bands, rows = tune(threshold)
    schema = "uid long, d long, rk long, s long, n long, check long, bands array<long>, line binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = signer(bands, rows)
        for batch in batches:
            lines_found, anchors_found, counts = [], [], []
            for d, rk, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words, lines = line_bounds(text.as_py() or b"")
                hashes = word_hashes(words)
                sums = run_sums(hashes)
                at = np.arange(max(0, len(words) - size + 1))
                grams = run_hashes(sums, at, at + size)
                starts = anchor_points(grams, size)
                anchors_found.append((grams[starts], starts))
                counts.append(len(starts))
                long = np.flatnonzero(np.diff(lines) >= min_line)
                if len(long):
                    at = np.arange(len(words) - shingle + 1)
                    grams = run_hashes(sums, at, at + shingle).view(_U)
                    for s, e in zip(lines[long].tolist(), lines[long + 1].tolist(), strict=True):
                        line = b" ".join(words[s:e])
                        lines_found.append((_signed(line, 1), d, rk, s, e - s, _signed(line, 2), sign(grams[s : e - shingle + 1]), line))
            types = [pa.int64()] * 6 + [pa.list_(pa.int64()), pa.binary()]
            if lines_found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines_found, strict=True), types, strict=True)], names=names)
            if total := sum(counts):
                zeros, repeat = np.zeros(total, np.int64), lambda i: np.repeat(batch.column(i).to_numpy(), counts)  # noqa: B023, E731
                columns = [np.concatenate([x[0] for x in anchors_found]), repeat(0), repeat(1), np.concatenate([x[1] for x in anchors_found]), zeros, zeros]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(total, types[6]), pa.nulls(total, types[7])], names=names)

    return _keyed(docs).mapInArrow(run, schema)


def aligned(one: list[int], other: list[int]) -> list[tuple[int, int, int]]:
    """Equal blocks of two texts from their first words on, each with the words of
    either text before it: the first may be empty, further ones have MEET words."""
    blocks, i, j, gap = [], 0, 0, (0, 0)
    while gap is not None:
        i, j, n = i + gap[0], j + gap[1], 0
        for x, y in zip(one[i:], other[j:], strict=False):
            if x != y:
                break
            n += 1
        blocks.append((*gap, n))
        i, j, gap, ahead = i + n, j + n, None, {}
        near = other[j : j + GAP + MEET]
        if set(near).isdisjoint(one[i : i + GAP + MEET]):
            break
        for y in range(len(near) - MEET + 1):
            ahead.setdefault(tuple(near[y : y + MEET]), y)
        for x in range(i, min(i + GAP, len(one) - MEET) + 1):
            y = ahead.get(tuple(one[x : x + MEET]))
            if y is not None and (gap is None or x - i + y < sum(gap)):
                gap = (x - i, y)
    return blocks


def like(shared: int, one: int, other: int, threshold: float, shingle: int) -> bool:
    """Whether spans of so many words with so many aligned shingles are similar enough."""
    both = one + other - 2 * (shingle - 1) - shared
    return shared >= threshold * both


def widest(n: int, before: list[tuple[int, int, int]], after: list[tuple[int, int, int]], threshold: float, shingle: int) -> tuple[int, int, int, int, int]:
    """Words that a run of n equal words gains before and after it, in either text,
    as far as the whole stays similar enough, and its aligned shingles."""

    def sums(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        out = [(blocks[0][2], blocks[0][2], 0)]
        for x, y, k in blocks[1:]:
            a, b, shared = out[-1]
            out.append((a + x + k, b + y + k, shared + max(0, k - shingle + 1)))
        return out

    core, best = n + before[0][2] + after[0][2] - shingle + 1, None
    for la, lb, ls in sums(before):
        for ra, rb, rs in sums(after):
            shared = core + ls + rs
            if like(shared, n + la + ra, n + lb + rb, threshold, shingle) and (best is None or la + ra > best[0] + best[1]):
                best = (la, ra, lb, rb, shared)
    return best


def bridged(spans: list[list], threshold: float, shingle: int) -> list[list]:
    """Spans (other text, s, e, s and e there, aligned shingles, owner, cluster,
    parts), those joined that are similar enough with what lies between them."""
    out: list[list] = []
    for x in sorted(spans):
        last = out[-1] if out else None
        if last and last[0] == x[0] and x[1] >= last[2] and x[3] >= last[4] and like(last[5] + x[5], x[2] - last[1], x[4] - last[3], threshold, shingle):
            new = x[5]
        elif last and last[0] == x[0] and x[1] < last[2] and x[3] < last[4] and x[2] - last[2] == x[4] - last[4] >= 0:
            new = x[2] - last[2]
        else:
            out.append(list(x))
            continue
        last[2], last[4], last[5], last[7], last[8] = x[2], x[4], last[5] + new, min(last[7], x[7]), last[8] + x[8]
    return out


def _signed(text: bytes, seed: int) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(text, seed), "big", signed=True)


def _short(words: list[bytes]) -> np.ndarray:
    return (word_hashes(words) >> _U(32)).astype(np.uint32)


def shared_anchors(anchors: DataFrame, scratch: Scratch) -> DataFrame:
    """``uid, d, rk, s, owner`` of the anchors (uid, d, rk, s) that two documents have."""
    owned = anchors.groupBy("uid").agg(F.min("d").alias("owner"), F.max("d").alias("high")).where("owner < high").drop("high")
    owned = scratch.write(owned, "anchor-classes")
    met = scratch.write(anchors.join(owned, "uid"), "anchors-met", "zstd")
    scratch.drop(owned)
    return met


def anchor_runs(met: DataFrame, scratch: Scratch) -> DataFrame:
    """``d, rk, s, e, owner, ork, os, oe, cluster, n_parts`` of shared anchors:
    the words that they cover without a gap in a document and in the first one that has them too."""
    # written, so that the join is a stage of its own, in which a crowded anchor can be split
    first = scratch.write(met.where("d = owner").groupBy("uid").agg(F.min(F.struct("rk", "s")).alias("at")), "anchor-places")
    gone = met.where("d > owner").join(first, "uid").select("d", "rk", "s", "owner", "uid", F.col("at.rk").alias("ork"), (F.col("at.s") - F.col("s")).alias("shift"))
    order = Window.partitionBy("d", "rk").orderBy("s", "uid")
    on = (F.lag("ork").over(order) == F.col("ork")) & (F.lag("shift").over(order) == F.col("shift")) & (F.col("s") <= F.lag("s").over(order) + ANCHOR)
    gone = gone.withColumn("new", F.when(on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = gone.groupBy("d", "rk", "run", "owner", "ork", "shift").agg(F.min("s").alias("s"), (F.max("s") + ANCHOR).alias("e"), F.min("uid").alias("cluster"), F.count("*").alias("n_parts"))
    runs = runs.select("d", "rk", "s", "e", "owner", "ork", (F.col("s") + F.col("shift")).alias("os"), (F.col("e") + F.col("shift")).alias("oe"), "cluster", "n_parts")
    runs = scratch.write(runs, "anchor-runs", "zstd")
    scratch.drop(met, first)
    return runs


def copied_spans(docs: DataFrame, met: DataFrame, scratch: Scratch, threshold: float, shingle: int) -> DataFrame:
    """``d, rk, s, n, owner, cluster, n_parts, first, last``: runs of shared anchors whose words
    are equal (by another hash of them), extended word by word in both texts as far as
    the spans are similar to the threshold.

    FAR words of the other text suffice: 2 * ANCHOR - 1 equal words have an anchor,
    so an extension that goes on longer has met another run, which is extended
    itself (and bridged with this one), or more edits than the threshold allows."""
    runs = anchor_runs(met, scratch)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rk, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = line_bounds(text.as_py())[0]
                own = _short(words)
                for w in wanted:
                    os, oe = w["os"], w["oe"]
                    out.append((rk, os, oe, _signed(b" ".join(words[os:oe]), 1), own[max(0, os - FAR) : os].tobytes(), own[oe : oe + FAR].tobytes()))
            if out:
                types = [pa.int64()] * 4 + [pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["ork", "os", "oe", "core", "before", "after"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column(3)
            ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
            inner = lists.flatten()
            every = list(zip(*(inner.field(i).to_pylist() for i in range(inner.type.num_fields)), strict=True))
            for i, (d, rk, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)):
                words, lines = line_bounds(text.as_py())
                own, lines, spans = _short(words).tolist(), set(lines.tolist()), []
                for s, e, ork, os, oe, owner, own_cluster, n_parts, core, before, after in every[ends[i - 1] if i else 0 : ends[i]]:
                    if _signed(b" ".join(words[s:e]), 1) != core:
                        continue
                    back = aligned(own[max(0, s - FAR - GAP) : s][::-1], np.frombuffer(before, np.uint32)[::-1].tolist())
                    ahead = aligned(own[e : e + FAR + GAP], np.frombuffer(after, np.uint32).tolist())
                    la, ra, lb, rb, shared = widest(e - s, back, ahead, threshold, shingle)
                    spans.append([ork, s - la, e + ra, os - lb, oe + rb, shared, owner, own_cluster, n_parts])
                out += [(d, rk, s, e - s, owner, cluster, n, s in lines, e in lines) for _, s, e, _, _, _, owner, cluster, n in bridged(spans, threshold, shingle)]
            if out:
                types = [pa.int64()] * 7 + [pa.bool_()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["d", "rk", "s", "n", "owner", "cluster", "n_parts", "first", "last"])

    texts = _keyed(docs)
    wanted = runs.select("ork", "os", "oe").distinct().groupBy("ork").agg(F.collect_list(F.struct("os", "oe")).alias("wanted"))
    near = texts.join(wanted.hint("shuffle_hash"), F.col("rk") == F.col("ork")).select("rk", "text", "wanted")
    near = near.mapInArrow(around, "ork long, os long, oe long, core long, before binary, after binary").dropDuplicates(["ork", "os", "oe"])
    # written, so that both sides of the join are plain shuffles, which adaptive execution can split at a crowded run
    words = scratch.write(near, "around", "zstd")
    near = scratch.write(runs.join(words.hint("merge"), ["ork", "os", "oe"]), "runs-around", "zstd")
    lists = near.groupBy("rk").agg(F.collect_list(F.struct("s", "e", "ork", "os", "oe", "owner", "cluster", "n_parts", "core", "before", "after")).alias("runs"))
    met = texts.join(lists.hint("shuffle_hash"), "rk").select("d", "rk", "text", "runs")
    spans = met.mapInArrow(extend, "d long, rk long, s long, n long, owner long, cluster long, n_parts long, first boolean, last boolean")
    spans = scratch.write(spans, "copied-spans")
    scratch.drop(runs, words, near)
    return spans


def jaccard_edges(bounds: np.ndarray, table: pa.Table, threshold: float, shingle: int) -> tuple[list[int], list[int]]:
    """Spanning forests of the lines in each group that are similar enough."""
    left, right = [], []
    ids, lines = table.column("id").to_pylist(), table.column("line").to_pylist()
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        if e - s < 2:
            continue
        sets = []
        for line in lines[s:e]:
            words = line.split()
            sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))})
        rest = list(range(e - s))
        while len(rest) > 1:
            queue, rest = [rest[0]], rest[1:]
            while queue and rest:
                one, far = queue.pop(), []
                own = sets[one]
                for x in rest:
                    other = sets[x]
                    low, high = sorted((len(own), len(other)))
                    both = len(own & other) if low >= threshold * high else 0
                    if both and both >= threshold * (low + high - both):
                        left.append(ids[s + x])
                        right.append(ids[s + one])
                        queue.append(x)
                    else:
                        far.append(x)
                rest = far
    return left, right


def line_edges(lines: DataFrame, scratch: Scratch, threshold: float, shingle: int) -> DataFrame:
    """``a, b``: verified links between distinct lines."""
    keyed = lines.select(F.explode("bands").alias("key"), F.col("uid").alias("id"))
    crowded = scratch.write(keyed.groupBy("key").agg(F.min("id").alias("l"), F.max("id").alias("h")).where("l < h").select("key"), "band-keys")
    met = scratch.write(keyed.join(crowded, "key").distinct(), "band-rows")
    counts = shared_keys(met, scratch)
    texts = lines.select(F.col("uid").alias("id"), "line").join(met.select("id").distinct(), "id", "left_semi")
    texts = scratch.write(texts.groupBy("id").agg(F.max("line").alias("line")), "band-lines")
    shared = met.join(counts, "key").join(texts, "id")

    def kernel(at: np.ndarray, table: pa.Table) -> tuple[list[int], list[int]]:
        return jaccard_edges(at, table, threshold, shingle)

    return link(shared, kernel, BLOCK)


def repeated_spans(docs: DataFrame, min_line: int = MIN_LINE, min_run: int = MIN_RUN, threshold: float = THRESHOLD, shingle: int = SHINGLE, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, rk, start, n_words, first_doc, cluster, n_parts``: the spans (word
    positions) of each document that a document with a lesser id has too. rk is
    the hash of doc_id and text, first_doc that least id, cluster the least id of
    the components in the span, n_parts the number of paragraphs merged."""
    scratch = scratch or Scratch(docs.sparkSession, "passages")
    found = scratch.write(pieces(docs, min_line, threshold, shingle), "pieces", "zstd")
    lines, anchors = found.where("n > 0"), found.where("n = 0").select("uid", "d", "rk", "s")
    member = scratch.write(connected_components(line_edges(lines, scratch, threshold, shingle), scratch), "line-components")
    owners = scratch.write(lines.groupBy("uid", "check").agg(F.min("d").alias("low"), F.max("d").alias("high")), "line-owners")
    of_linked = owners.join(member, owners.uid == member.node)
    lowest = scratch.write(of_linked.groupBy("component").agg(F.min("low").alias("owner")), "component-owners")
    linked = of_linked.join(lowest, "component").select("uid", "check", "owner", F.col("component").alias("cluster"))
    equal = owners.where("low < high").join(member, owners.uid == member.node, "left_anti").select("uid", "check", F.col("low").alias("owner"), F.col("uid").alias("cluster"))
    classes = scratch.write(linked.union(equal), "line-classes")
    gone_lines = lines.select("uid", "check", "d", "rk", "s", "n").join(classes, ["uid", "check"]).where("d > owner")
    gone_lines = gone_lines.select("d", "rk", "s", "n", "owner", "cluster", F.lit(1).cast("long").alias("n_parts"), F.lit(True).alias("first"), F.lit(True).alias("last"))
    gone_lines = scratch.write(gone_lines, "line-parts")

    # the pieces are larger than all else, so they go before the texts are shuffled
    met = shared_anchors(anchors, scratch)
    scratch.drop(found, member, owners, lowest, classes)
    copied = copied_spans(docs, met, scratch, threshold, shingle)
    parts = scratch.write(gone_lines.unionByName(copied), "parts")
    scratch.drop(gone_lines, copied)
    parts = parts.withColumn("e", F.col("s") + F.col("n"))
    order = Window.partitionBy("d", "rk").orderBy("s", "e", "cluster")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", (reach.isNull() | (F.col("s") > reach)).cast("int")).withColumn("span", F.sum("new").over(order))
    spans = parts.groupBy("d", "rk", "span").agg(
        F.min("s").alias("start"), F.max("e").alias("end"), F.min("owner").alias("first_doc"), F.min("cluster").alias("cluster"), F.sum("n_parts").alias("n_parts"),
        F.min_by("first", "s").alias("first"), F.max_by("last", "e").alias("last"),
    )
    spans = spans.withColumn("n_words", F.col("end") - F.col("start"))
    spans = spans.where((F.col("n_words") >= min_run) | ((F.col("n_words") >= min_line) & F.col("first") & F.col("last")))
    return spans.select(F.when(F.col("d") != NO_ID, F.col("d")).alias("doc_id"), "rk", "start", "n_words", "first_doc", "cluster", "n_parts")


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words of the spans (first word, number of words)."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, last = [], 0
    for start, n in sorted(spans):
        out.append(text[last : at[start]])
        last = at[start + n]
    out.append(text[last:])
    return b"".join(out)


def remove_spans(docs: DataFrame, scratch: Scratch | None = None, **how) -> DataFrame:
    """docs without repeated spans, with their columns; n_chars follows the text
    if there is such a column. Documents of which no word is left go."""
    scratch = scratch or Scratch(docs.sparkSession, "passages-cut")
    inner = Scratch(docs.sparkSession, "passages-spans")
    spans = repeated_spans(docs, scratch=inner, **how)
    spans = scratch.write(spans.groupBy(F.col("rk").alias("_span_rk"), F.col("doc_id").alias("_span_doc")).agg(F.collect_set(F.struct("start", "n_words")).alias("_spans")), "spans")
    inner.clear()

    @F.pandas_udf("binary")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if own is None else cut(t, [(x["start"], x["n_words"]) for x in own]) for t, own in zip(texts, spans, strict=True)], dtype=object)

    # one plan at every size: texts are shuffled once, a task builds on the spans alone, and
    # the cut is not deterministic to the optimizer so that it runs once for a row
    met = docs.withColumn("_rk", F.xxhash64("doc_id", "text")).join(spans.hint("shuffle_hash"), (F.col("_rk") == F.col("_span_rk")) & F.col("doc_id").eqNullSafe(F.col("_span_doc")), "left")
    met = met.withColumn("text", without.asNondeterministic()(F.col("text").cast("binary"), F.col("_spans")).cast("string"))
    met = met.where(F.col("_spans").isNull() | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    if "n_chars" in docs.columns:
        met = met.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return met.select(*docs.columns)
