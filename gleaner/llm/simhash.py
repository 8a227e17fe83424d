"""SimHash near-duplicate groups.

Fingerprints: 64 bits by majority over the XXH64 of a text's word shingles.
Candidates: the 64 bits are cut into blocks; fingerprints at most ``distance``
bits apart agree on all but ``distance`` of the blocks, so each fingerprint is
keyed by every choice of the remaining blocks and pairs are verified within
keys only. Exact copies share a fingerprint and are collapsed before that.
Groups are the connected components of the verified links (``simhash_groups``).

``near_groups`` finds the texts whose sets of five-word shingles are similar to
a threshold. One changed word spoils five shingles, so their fingerprint strays
too far for blocks; that of the words (each weighted by the logarithm of its
count) hardly does. Blocks are therefore cut from the fingerprint of the words,
the Hamming distance is verified on both, and texts in the groups found so are
linked if the exact Jaccard similarity of their shingles reaches the threshold.

Defined cases: a null text, and a text without words, has the fingerprint zero,
which links like any other. Fewer words than a shingle: the whole sequence is
the one shingle. Rows that repeat a doc_id are fingerprinted one by one. A null
doc_id never names a group: its row gets the least doc_id of its group that is
not null, or null. An empty table gives no rows. Other columns of the input are
not read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.links import link, shared_keys
from gleaner.operators.components import connected_components
from gleaner.scratch import Scratch

#: Rows of one key that are verified at once; more are cut into pairs of chunks.
BLOCK = 256
#: The same for sets of shingles, which are larger.
SET_BLOCK = 128


def majority(digests: list[bytes], weights: np.ndarray | None = None) -> int:
    """The bits that more than half of the digests (by weight) have."""
    bits, step = np.zeros(64, np.int64), 1 << 15
    for at in range(0, len(digests), step):
        part = np.unpackbits(np.frombuffer(b"".join(digests[at : at + step]), np.uint8).reshape(-1, 8), axis=1)
        bits += part.sum(axis=0, dtype=np.int64) if weights is None else weights[at : at + step] @ part
    total = len(digests) if weights is None else int(weights.sum())
    return int.from_bytes(np.packbits(2 * bits > total).tobytes(), "big")


def shingle_digests(words: list[bytes], shingle: int, seed: int) -> list[bytes]:
    """XXH64 of each shingle, repeats included."""
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = list(accumulate(len(w) + 1 for w in words))
    take = min(shingle, len(words))
    if take == len(words):
        return [digest(joined, seed)] if words else []
    return [digest(joined[s : e - 1], seed) for s, e in zip([0, *ends], ends[take - 1 :], strict=False)]


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of a UTF-8 text."""
    return majority(shingle_digests((text or b"").lower().split(), shingle, seed))


def word_fingerprint(words: list[bytes], seed: int = 42) -> int:
    """Fingerprint of the words, each by the logarithm of its count."""
    counts = Counter(words)
    weights = np.rint(16 * (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts))))).astype(np.int64)
    return majority([xxhash.xxh64_digest(w, seed) for w in counts], weights)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, fp long")


def signatures(docs: DataFrame, shingle: int = 5, seed: int = 42) -> DataFrame:
    """``doc_id, rk, id, fp, fp2``: rk is the hash of doc_id and text, id that of the
    words in order, fp the fingerprint of the words, fp2 that of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2):
                words = (t.as_py() or b"").lower().split()
                out.append((xxhash.xxh3_64_intdigest(b" ".join(words), seed), word_fingerprint(words, seed), majority(shingle_digests(words, shingle, seed))))
            found = np.array(out, np.uint64).reshape(-1, 3).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(found[:, i]) for i in range(3))], names=["doc_id", "rk", "id", "fp", "fp2"])

    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rk"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, rk long, id long, fp long, fp2 long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` blocks, as signed longs."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def block_keys(nodes: DataFrame, blocks: int, distance: int) -> DataFrame:
    """The nodes (id, fp and others) with ``key``, for each choice of blocks of fp."""
    masks = block_masks(blocks, distance)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    return nodes.select(F.explode(keys).alias("key"), "*")


def near_edges(bounds: np.ndarray, ids: np.ndarray, halves: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of the links within groups: rows whose fingerprints are near
    in every one of ``halves`` (fingerprints, most differing bits)."""
    halves = [(v.view(np.uint64), d) for v, d in halves]
    near = lambda one, other: np.logical_and.reduce([np.bitwise_count(v[one] ^ v[other]) <= d for v, d in halves])
    sizes, starts = np.diff(bounds), bounds[:-1]
    two = starts[sizes == 2]
    two = two[near(two, two + 1)]
    left, right = [ids[two]], [ids[two + 1]]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        rest = np.arange(s, s + n)
        while len(rest) > 1:  # a tree of each component, from its first row on
            queue, rest = [int(rest[0])], rest[1:]
            while queue and len(rest):
                node = queue.pop()
                hit = near(rest, node)
                if hit.any():
                    found, rest = rest[hit], rest[~hit]
                    left.append(ids[found])
                    right.append(np.full(len(found), ids[node], np.int64))
                    queue.extend(found.tolist())
    return np.concatenate(left), np.concatenate(right)


def near_links(nodes: DataFrame, scratch: Scratch, distance: int = 3, blocks: int = 5, finer: int = 7, block: int = BLOCK, second: int | None = None) -> DataFrame:
    """``a, b``: links between distinct nodes (id, fp; with ``second``, fp2 too, at most
    so many bits apart) that suffice for their components. Keys with more than
    ``block`` nodes go on to finer blocks, and what is still crowded there is verified
    chunk by chunk."""

    def kernel(at: np.ndarray, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        column = lambda name: table.column(name).to_numpy()
        return near_edges(at, column("id"), [(column("fp"), distance), *([(column("fp2"), second)] if second is not None else [])])

    nodes = nodes.select("id", "fp", *(["fp2"] if second is not None else []))
    keyed = block_keys(nodes, blocks, distance)
    counts = shared_keys(keyed, scratch)
    shared = keyed.join(counts.hint("merge"), "key")
    edges = link(shared.where(F.col("n") <= block), kernel, block)
    if counts.where(F.col("n") > block).head(1):
        crowded = scratch.write(shared.where(F.col("n") > block).select(*nodes.columns).distinct(), "crowded")
        keyed = block_keys(crowded, finer, distance)
        edges = edges.union(link(keyed.join(shared_keys(keyed, scratch).hint("merge"), "key"), kernel, block))
    return edges


def similar_edges(bounds: np.ndarray, ids: np.ndarray, sets: pa.ListArray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of the links within groups of sets: Jaccard similarity of the
    threshold or more. One set is held against all others of its group at once."""
    at, values = np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy()))), sets.flatten().to_numpy()
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if e - s < 2:
            continue
        own = np.unique(values[at[s] : at[e]], return_inverse=True)[1]
        cuts, sizes = at[s : e + 1] - at[s], np.diff(at[s : e + 1])
        mark, rest = np.zeros(int(own.max()) + 1, np.int64), np.ones(e - s, bool)
        while rest.sum() > 1:
            first = int(rest.argmax())
            queue, rest[first] = [first], False
            while queue and rest.any():
                node = queue.pop()
                members = own[cuts[node] : cuts[node + 1]]
                mark[members] = 1
                both = np.add.reduceat(mark[own], cuts[:-1])
                mark[members] = 0
                hit = np.flatnonzero(rest & (both >= threshold * (sizes + sizes[node] - both) - 1e-9))
                rest[hit] = False
                left.append(ids[s + hit])
                right.append(np.full(len(hit), ids[s + node], np.int64))
                queue.extend(hit.tolist())
    return np.concatenate(left), np.concatenate(right)


def shingle_sets(texts: DataFrame, shingle: int = 5, seed: int = 42) -> DataFrame:
    """``id, shingles`` of (id, text): the distinct 64-bit hashes of the shingles, one
    at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for t in batch.column(1):
                digests = shingle_digests((t.as_py() or b"").lower().split(), shingle, seed)
                sets.append(np.unique(np.frombuffer(b"".join(digests), np.int64)) if digests else np.zeros(1, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return texts.select("id", F.col("text").cast("binary")).mapInArrow(run, "id long, shingles array<long>")


def near_groups(docs: DataFrame, scratch: Scratch, threshold: float = 0.8, shingle: int = 5, distance: int = 5, second: int = 16, seed: int = 42) -> DataFrame:
    """``doc_id, rk, group`` of each row of docs: rows of one group hold the same words
    or are linked by texts that are similar to the threshold. rk is the hash of doc_id
    and text; group, an id of texts, is null for rows without another like them.
    What grows with the input is joined by shuffles, as the driver builds every table
    that is broadcast."""
    own = scratch.write(signatures(docs, shingle, seed), "signatures")
    nodes = own.groupBy("id").agg(F.min("fp").alias("fp"), F.min("fp2").alias("fp2"), F.min("rk").alias("rk"), F.count("*").alias("copies"))
    nodes = scratch.write(nodes, "distinct")
    close = near_links(nodes, scratch, distance, blocks=distance + 2, finer=distance + 3, second=second)
    hamming = scratch.write(connected_components(close, scratch), "hamming")
    members = scratch.write(hamming.hint("merge").join(nodes.select(F.col("id").alias("node"), "rk"), "node"), "members")
    met = docs.withColumn("_rk", F.xxhash64("doc_id", "text")).select("_rk", "text").join(members.select("rk", F.col("node").alias("id")).hint("shuffle_hash"), F.col("_rk") == F.col("rk"))
    sets = scratch.write(shingle_sets(met, shingle, seed).dropDuplicates(["id"]), "sets")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    shared = members.join(sizes.hint("merge"), "component").select(F.col("component").alias("key"), "n", F.col("node").alias("id")).hint("merge").join(sets, "id")

    def kernel(at: np.ndarray, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return similar_edges(at, table.column("id").to_numpy(), table.column("shingles").combine_chunks(), threshold)

    verified = link(shared, kernel, SET_BLOCK)
    linked = scratch.write(connected_components(verified, scratch), "linked")
    alone = nodes.where("copies > 1").join(linked.hint("merge"), nodes.id == linked.node, "left_anti").select("id", F.col("id").alias("group"))
    classes = scratch.write(linked.select(F.col("node").alias("id"), F.col("component").alias("group")).union(alone), "groups")
    scratch.drop(nodes, hamming, members, sets)
    return own.join(classes.hint("merge"), "id", "left").select("doc_id", "rk", "group")


def simhash_groups(docs: DataFrame, shingle: int = 3, seed: int = 42, distance: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row of docs."""
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    own = scratch.write(fingerprints(docs, shingle, seed), "fingerprints")
    reps = scratch.write(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "distinct")
    grouped = scratch.write(connected_components(near_links(reps.select(F.col("fp").alias("id"), "fp"), scratch, distance, distance + 2, distance + 4), scratch), "components")
    member = grouped.select(F.col("node").alias("fp"), "component")
    least = scratch.write(member.join(reps, "fp").groupBy("component").agg(F.min("least").alias("component_id")), "least")
    of_groups = member.join(least, "component").select("fp", "component_id")
    of_copies = reps.where("copies > 1").join(member.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    classes = scratch.write(of_groups.union(of_copies), "classes")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return own.join(classes, "fp", "left").select("doc_id", hexed.alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """One row of each group of near_groups, all columns kept: that with the least
    doc_id (null last), and of rows that repeat it that with the least hash of doc_id
    and text. Rows equal in doc_id and text are in one group; of those that differ in
    other columns alone, the least of these stays. Rows in no group stay, whatever
    their doc_id."""
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    rows = scratch.write(near_groups(docs, scratch, threshold, shingle).where("group is not null"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk")).alias("first")
    kept = rows.groupBy("group").agg(first).select(F.col("first.rk").alias("rk"), F.lit(True).alias("stays"))
    # a row hash of a group either goes, or stays for one row
    fate = rows.groupBy("rk").agg(F.count("*").alias("rows")).join(kept.hint("merge"), "rk", "left")
    fate = scratch.write(fate.select(F.col("rk").alias("_at"), F.coalesce("stays", F.lit(False)).alias("_stays"), (F.col("rows") > 1).alias("_again")), "fate")
    met = docs.withColumn("_rk", F.xxhash64("doc_id", "text")).join(fate.where("_again or not _stays").hint("shuffle_hash"), F.col("_rk") == F.col("_at"), "left")
    met = met.where("_stays is null or _stays")
    single = met.where("_again is null").select(*docs.columns)
    if not fate.where("_again and _stays").head(1):
        return single
    again = met.where("_again").groupBy("_rk").agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("_row"))
    return single.unionByName(again.select("_row.*"))
