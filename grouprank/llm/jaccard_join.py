"""N-gram Jaccard self-join by chosen paths (operator 8).

Sets of five-word shingles are represented by MINHASHES minwise hashes; equal hashes at one coordinate stand for a
shared token. (The first split takes 32 bits of a hash; 16 bits are kept for all that follows.) A run begins with all
sets in one node. At each node a few coordinates are sampled (by a hash of the node's path, so all sets of a node take
the same ones), and sets with equal tokens there go to one child. Nodes of few sets are compared by brute force, larger
ones are split again, but for the sets that are very near to the node's pivot: whatever is similar to them is linked to
the pivot, too. Runs are repeated until a pair at the threshold is found with the wanted probability. Links estimated
in the nodes give candidate groups; within a group all sets are compared exactly, block by block, so copies and near
copies never become a list of pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import TEXT_ROWS, grouped, narrow, text_slices, written
from grouprank.llm.components import components
from grouprank.llm.shingles import mix, shingle_hashes

THRESHOLD = 0.8
MINHASHES = 128
#: Share of equal minwise hashes from which sets of one node may be similar: 5 deviations below the threshold.
LIKELY = 0.6
#: From this share of equal hashes a set is settled by its link to a pivot: sets similar to it are at a distance of
#: 0.2 + 0.2 from the pivot at most, about, so they are linked to it from PIVOT_LIKELY, deviations below that.
SETTLED = 0.8
PIVOT_LIKELY = 0.4
#: Coordinates taken at a node on average: 1 / THRESHOLD, so that a similar pair stays together in one child on average.
BRANCHES = 1 / THRESHOLD
RECALL = 0.999
#: Sets of a node that are compared by brute force, levels of splitting, sets in a block of a larger comparison.
NODE_SETS = 128
LEVELS = 4
BLOCK = 128


def settled_loss() -> float:
    """The most likely loss at a node of a pair at the threshold: one set is settled, the other not linked to the pivot.

    The one is at some similarity s to the pivot, the other at s - (1 - THRESHOLD) at worst; estimates are about normal.
    """
    def below(bar: float, s: float) -> float:
        return 0.5 * (1 + math.erf((bar - s) / math.sqrt(2 * s * (1 - s) / MINHASHES)))
    return max((1 - below(SETTLED, s)) * below(PIVOT_LIKELY, s - (1 - THRESHOLD)) for s in np.linspace(0.3, 0.99, 139).tolist())


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold is missed with at most 1 - recall, even if each run goes down all levels.

    A node takes one coordinate, or two with probability BRANCHES - 1, and a pair shares each with `threshold`. What
    settled sets lose at the levels (the same in every run, at worst) is taken from 1 - recall.
    """
    two, lost = BRANCHES - 1, 0.0
    for _ in range(levels):
        apart = 1 - threshold + threshold * lost  # a child without the pair
        lost = (1 - two) * apart + two * apart * apart
    return int(np.ceil(np.log(1 - recall - levels * settled_loss()) / np.log(lost)))


def minhashes(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of MINHASHES 32-bit minwise hashes for each non-empty text."""
    some = np.flatnonzero(np.diff(first))
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    draw = np.random.default_rng(8)
    factors = draw.integers(0, 1 << 31, MINHASHES, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = draw.integers(0, 1 << 32, MINHASHES, dtype=np.int64).astype(np.uint32)
    found = np.empty((len(some), MINHASHES), np.uint32)
    for k in range(MINHASHES):
        h = (low ^ shifts[k]) * factors[k]
        h ^= h >> np.uint32(15)
        found[:, k] = np.minimum.reduceat(h * np.uint32(0x2C1B3C6D), first[some]) if len(some) else 0
    return found


def set_key(shingles: bytes) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


def set_rows(runs: int):
    """(doc_id, text_hash, key of the set, sketch, roots); the last three are null if the text has no word.

    sketch has 16 bits of each minwise hash, roots the first children of all runs.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 4 << 20):
            shingles, first = shingle_hashes(batch.column(1).to_pylist())
            hashes = minhashes(shingles, first)
            paths = mix(np.tile(np.arange(1, runs + 1, dtype=np.uint64), len(hashes)))
            child, of = children(paths, np.repeat(np.arange(len(hashes)), runs), hashes)
            order = np.argsort(of, kind="stable")
            ends = np.cumsum(np.bincount(of, minlength=len(hashes)))
            made = zip(hashes.astype("<u2"), np.split(child[order], ends[:-1]), strict=False)
            keys, sketches, roots = [], [], []
            for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                sketch, root = next(made) if hi > lo else (None, None)
                keys.append(set_key(np.unique(shingles[lo:hi]).tobytes()) if hi > lo else None)
                sketches.append(None if sketch is None else sketch.tobytes())
                roots.append(None if root is None else root.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(x, pa.binary()) for x in (keys, sketches, roots))],
                ["doc_id", "text_hash", "key", "sketch", "roots"])

    return rows


def children(paths: np.ndarray, of: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Paths of the children that sets (rows `of` of sketch) at nodes `paths` go to, and the set of each."""
    found, sets = [], []
    for nth in (0, 1):
        h = mix(paths + np.uint64(0xA24BAED4963EE407 + nth))
        taken = np.full(len(h), True) if nth == 0 else (h >> np.uint64(40)) < np.uint64((BRANCHES - 1) * (1 << 24))
        coordinate = h % np.uint64(MINHASHES)
        token = sketch[of, coordinate.astype(np.int64)].astype(np.uint64)
        child = mix(paths * np.uint64(0x9FB21C651E98DF25) + (token << np.uint64(8)) + coordinate)
        found.append(child[taken])
        sets.append(of[taken])
    return np.concatenate(found).view(np.int64), np.concatenate(sets)


def sketch_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, MINHASHES)


def root_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, rep) of the first children of rows (rep, roots)."""
    for batch in batches:
        roots = batch.column(1).to_pylist()
        n = pa.array(np.repeat(np.arange(len(roots)), [len(r) // 8 for r in roots]))
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(roots), "<i8")), batch.column(0).take(n)], ["path", "rep"])


def node_splitter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, rep, sketch, pivot, pivot_sketch) of large nodes: links to the pivot, and children of the unsettled."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch = sketch_matrix(batch.column(2))
        agree = (sketch == sketch_matrix(batch.column(4))).mean(axis=1)
        rep, pivot = batch.column(1).to_numpy(), batch.column(3).to_numpy()
        linked = np.flatnonzero((agree >= PIVOT_LIKELY) & (rep != pivot))
        open_ = np.flatnonzero((agree < SETTLED) & (rep != pivot))
        path, of = children(batch.column(0).to_numpy().view(np.uint64)[open_], open_, sketch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((np.zeros(len(linked), np.int64), path))), pa.array(np.concatenate((rep[linked], rep[of]))),
             pa.array([*pivot[linked].tolist(), *[None] * len(of)], pa.int64())], ["path", "rep", "pivot"])


def labels(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the least row that it is joined to."""
    n = len(linked)
    found = np.arange(n)
    while True:
        least = np.minimum(found, np.where(linked, found[None, :], n).min(axis=1, initial=n))
        least = least[least]
        if (least == found).all():
            return found
        found = least


def blocked(rows: DataFrame, seed: int) -> DataFrame:
    """Deal rows of groups of n rows to pairs of blocks (i <= j) of about BLOCK rows; every two rows of a group meet in one.

    A group of at most BLOCK rows is one block. Adds i, j and block (the row's own).
    """
    dealt = (rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(seed)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("blocks", "other"))


def likely_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of one node whose sketches agree enough, as links to the least set that they are joined to."""
    for rows in grouped(batches, ["path", "i", "j"]):
        reps, first = np.unique(rows.column("rep").to_numpy(), return_index=True)
        if len(reps) < 2:
            continue
        sketch = sketch_matrix(rows.column("sketch"))[first]
        agree = np.zeros((len(reps), len(reps)), np.uint8)
        for k in range(MINHASHES):
            agree += sketch[:, k][:, None] == sketch[:, k][None, :]
        label = labels(agree >= LIKELY * MINHASHES)
        some = label != np.arange(len(reps))
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(reps[label[some]])], ["a", "b"])


def together(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys in one task, one after another."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def candidate_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) between sets that some node of some run holds together, whose sketches agree enough."""
    sketches = sets.select("rep", "sketch")
    nodes, links = written(sets.select("rep", "roots").mapInArrow(root_nodes, "path long, rep long"), "nodes"), None
    for level in range(LEVELS):
        # a node's pivot is the set whose number, mixed with the path, is least
        sizes = written(nodes.groupBy("path").agg(F.count("*").alias("n"), F.min(F.expr("rep ^ path")).alias("m")).where("n > 1")
                        .select("path", "n", F.expr("m ^ path").alias("pivot")), "node-sizes")
        last = level == LEVELS - 1
        ready = sizes if last else sizes.where(F.col("n") <= NODE_SETS)
        members = blocked(nodes.join(ready.select("path", "n"), "path").join(sketches, "rep"), level).select("path", "i", "j", "rep", "sketch")
        found = together(members, "path", "i", "j").mapInArrow(likely_links, "a long, b long")
        links = found if links is None else links.union(found)
        large = sizes.where(F.col("n") > NODE_SETS)
        if last or large.isEmpty():
            break
        pivots = large.join(sketches.toDF("pivot", "pivot_sketch"), "pivot").select("path", "pivot", "pivot_sketch")
        split = (nodes.join(pivots, "path").join(sketches, "rep").select("path", "rep", "sketch", "pivot", "pivot_sketch")
                 .mapInArrow(node_splitter, "path long, rep long, pivot long"))
        split = written(split, "split")
        links = links.union(split.where("pivot is not null").select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
        nodes = split.where("pivot is null").select("path", "rep")
    return links


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, key, ...): the text replaced by its sorted distinct shingles, where that set has the key."""
    for batch in text_slices(batches, "text", 4 << 20):
        shingles, first = shingle_hashes(batch.column(0).to_pylist())
        sets = [np.unique(shingles[lo:hi]).tobytes() for lo, hi in zip(first[:-1], first[1:], strict=True)]
        same = [key == set_key(s) for key, s in zip(batch.column(1).to_pylist(), sets, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), *batch.columns[2:]],
                                         ["shingles", *batch.schema.names[2:]]).filter(pa.array(same))


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """Whether sets' Jaccard similarity reaches the threshold, for all pairs; by products of membership matrices."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1  # tokens of one set alone are in no intersection
    owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, (1 << 24) // len(sets))
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    last = int(token[-1]) + 1 if len(token) else 0
    for at in range(0, last, width):
        lo, hi = np.searchsorted(token, [at, at + width])
        part = np.zeros((len(sets), min(width, last - at)), np.float32)
        part[owner[lo:hi], token[lo:hi] - at] = 1
        common += part @ part.T
    common = common.astype(np.float64)
    found = common >= THRESHOLD * (size[:, None] + size[None, :] - common) - 1e-9
    np.fill_diagonal(found, False)
    return found


def verified_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each set of a pair of blocks: similar sets with their copies, and the least set that it is joined to there.

    whole says that the group has one block, so that least is final.
    """
    for rows in grouped(batches, ["component", "i", "j"]):
        reps, first = np.unique(rows.column("rep").to_numpy(), return_index=True)
        copies, block = (rows.column(c).to_numpy()[first] for c in ("copies", "block"))
        shingles = rows.column("shingles").take(pa.array(first)).to_pylist()
        linked = similar([np.frombuffer(s, np.uint64) for s in shingles])
        if rows.column("i")[0].as_py() != rows.column("j")[0].as_py():
            linked &= block[:, None] != block[None, :]  # pairs within one block have a task of their own
        whole = rows.column("whole")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array(reps), pa.array(linked @ copies), pa.array(reps[labels(linked)]), pa.array(np.full(len(reps), whole))],
            ["rep", "links", "least", "whole"])


def jaccard_classes(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, text_hash (xxhash64 of text, for rows that share an id).

    n_links is the number of other documents whose set of five-word shingles (lower-case words, a shorter text is one
    shingle) has a Jaccard similarity of 0.8 or more with this document's, copies included. Similarities are exact for
    the sets that were compared; `runs` (by default as many as RECALL needs) bounds the share of links never compared.
    class_id is the least doc_id that a document is joined to by links, its own if there is none.
    Documents without words (null or empty text too) have no links. A document with a null id has none and no class.
    Repeated rows are copies of one another. An empty table gives no rows.
    """
    return jaccard_groups(docs, runs).drop("class_set")


def jaccard_groups(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """The rows of jaccard_classes with class_set, which only rows of one class share (null without words or id).

    Rows that share an id may have one class_id and yet be of several classes.
    """
    docs = narrow(docs, ("doc_id", "long"), ("text", "string"))
    rows = written(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        set_rows(runs or runs_needed()), "doc_id long, text_hash long, key binary, sketch binary, roots binary"), "sets",
                   rows_per_batch=TEXT_ROWS)
    usable = rows.where("doc_id is not null and key is not null")
    keys = written(usable.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
                   .withColumn("rep", F.xxhash64("key")), "set-keys")
    # a set's sketch is that of its first document; rows that repeat it are dropped
    sets = written(usable.join(keys, ["key", "doc_id"]).dropDuplicates(["key", "doc_id"]).select("rep", "sketch", "roots"), "distinct-sets")

    near = components(candidate_links(sets))
    near = written(near.join(keys, near["id"] == keys["rep"]).select("rep", "component", "key", "doc_id", "copies"), "candidates")
    near = near.join(near.groupBy("component").agg(F.count("*").alias("n")), "component")
    # not broadcast, even where it is small: the same plan at every size
    members = docs.join(near.hint("merge"), "doc_id").select("text", "key", "component", "n", "rep", "copies").mapInArrow(
        shingle_sets, "shingles binary, component long, n long, rep long, copies long")
    pairs = blocked(members, LEVELS).select("component", "i", "j", "block", (F.col("n") <= BLOCK).alias("whole"), "rep", "copies", "shingles")
    exact = written(together(pairs, "component", "i", "j").mapInArrow(verified_links, "rep long, links long, least long, whole boolean"), "exact")

    ends = exact.select(F.col("rep").alias("a"), F.col("least").alias("b"), "whole")
    joined = components(ends.where("not whole").drop("whole")).union(ends.where("whole").drop("whole"))
    joined = joined.join(keys.select("rep", "doc_id"), joined["id"] == keys["rep"]).select("rep", "component", "doc_id")
    classes = joined.join(joined.groupBy("component").agg(F.min("doc_id").alias("class_id")), "component").select("rep", "class_id", "component")
    links = exact.groupBy("rep").agg(F.sum("links").alias("links"))
    of_key = (keys.join(links, "rep", "left").join(classes, "rep", "left")
              .select("key", F.coalesce("class_id", "doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("class_set")))
    linked = usable.select("doc_id", "text_hash", "key").join(of_key, "key").select("doc_id", "class_id", "n_links", "text_hash", "class_set")
    alone = rows.where("doc_id is null or key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "text_hash",
                                                                      F.lit(None).cast("long").alias("class_set"))
    return linked.union(alone)
