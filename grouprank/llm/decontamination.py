"""Benchmark decontamination with SimHash windows and a multi-index over Hamming blocks (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import narrow, text_slices, with_carried
from grouprank.llm.shingles import SIZE, mix, shingle_hashes

BITS = 64
#: Fingerprints up to this distance are found. At a similarity of 0.8 the expected distance is about 10, its deviation 3.
RADIUS = 20
#: Blocks of the fingerprint; one of them differs in RADIUS // BLOCKS bits at most.
BLOCKS = 7
SIMILARITY = 0.8
#: Items held at a time; the documents are read once for each such block of items.
ITEM_BLOCK = 20_000


def signs(shingles: np.ndarray) -> np.ndarray:
    """A row of +1/-1 for each shingle."""
    bits = (mix(shingles + np.uint64(0xD1B54A32D192ED03))[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of rows of sums of signs."""
    return ((sums > 0).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingles; a shingle weighs as often as it occurs."""
    both, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = np.bincount(place[:len(a)], minlength=len(both)), np.bincount(place[len(a):], minlength=len(both))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


@dataclass
class ItemIndex:
    """Benchmark items as shingles, their fingerprints, and for each block of bits the items near each block value."""
    ids: list[int | None]
    shingles: list[np.ndarray]
    prints: np.ndarray
    near: list[dict[int, np.ndarray]]
    keys: np.ndarray  # all items' shingles, in order
    owners: np.ndarray  # the item of each key

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None]) -> ItemIndex:
        all_shingles, first = shingle_hashes(texts)
        kept = np.flatnonzero(np.diff(first))
        shingles = [all_shingles[first[i]:first[i + 1]] for i in kept]
        prints = np.array([fingerprints(signs(s).sum(axis=0)[None])[0] for s in shingles], dtype=np.uint64)
        near = []
        for lo, hi in block_edges():
            values = ((prints >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)
            every = np.arange(1 << (hi - lo))
            found: dict[int, np.ndarray] = {}
            for value in every:
                if len(some := np.flatnonzero(np.bitwise_count(values ^ value) <= RADIUS // BLOCKS)):
                    found[int(value)] = some
            near.append(found)
        keys = np.concatenate([np.unique(s) for s in shingles] or [np.zeros(0, np.uint64)])
        owners = np.repeat(np.arange(len(shingles)), [len(np.unique(s)) for s in shingles])
        order = np.argsort(keys, kind="stable")
        return cls([ids[i] for i in kept], shingles, prints, near, keys[order], owners[order])

    def within_radius(self, print_: np.uint64) -> np.ndarray:
        """All items whose fingerprint is within RADIUS: some block is within its share, so the blocks find them all."""
        found = [near[value] for (lo, hi), near in zip(block_edges(), self.near, strict=True)
                 if (value := int(print_ >> np.uint64(lo)) & ((1 << (hi - lo)) - 1)) in near]
        if not found:
            return np.zeros(0, np.int64)
        some = np.unique(np.concatenate(found))
        return some[np.bitwise_count(self.prints[some] ^ print_) <= RADIUS]

    def hits(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles that items have, and for each the item (a place once for each such item)."""
        low = np.searchsorted(self.keys, shingles, "left")
        n = np.searchsorted(self.keys, shingles, "right") - low
        place = np.repeat(np.arange(len(shingles)), n)
        nth = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        return place, self.owners[np.repeat(low, n) + nth]

    def leaks(self, shingles: np.ndarray, place: np.ndarray, item: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """For each item found in a document: (similarity, first shingle, shingles) of its best window.

        Windows have an item's size, and those that hold none of its shingles can't be similar to it; all others
        are fingerprinted. What the index finds within the radius is compared exactly.
        """
        found: dict[int, tuple[float, int, int]] = {}
        for size in {len(self.shingles[i]) for i in np.unique(item)}:
            mine = np.array([len(self.shingles[i]) == size for i in item])
            width = min(size, len(shingles))
            starts = np.unique((place[mine][:, None] - np.arange(width)).ravel())
            starts = starts[(starts >= 0) & (starts + width <= len(shingles))]
            wanted = set(np.unique(item[mine]).tolist())
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                if not len(run):
                    continue
                sums = np.cumsum(np.concatenate((np.zeros((1, BITS), np.int32), signs(shingles[run[0]:run[-1] + width]))), axis=0)
                at = run - run[0]
                for start, print_ in zip(run.tolist(), fingerprints(sums[at + width] - sums[at]), strict=True):
                    for i in self.within_radius(print_).tolist():
                        if i in wanted and (value := similarity(shingles[start:start + width], self.shingles[i])) >= SIMILARITY:
                            found[i] = max(found.get(i, (0.0, 0, 0)), (value, -start, width))
        return {i: (value, -start, width) for i, (value, start, width) in found.items()}


def block_edges() -> list[tuple[int, int]]:
    cuts = np.linspace(0, BITS, BLOCKS + 1).astype(int).tolist()
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def contaminated(docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_items, is_contaminated, items, similarities, first_words, n_words.

    items are the benchmark items that a passage of the document is similar to (weighted Jaccard similarity of
    five-word shingles >= 0.8, words in lower case without punctuation), in order of id; first_words and n_words say
    where (in words). Columns named in carry follow under c0, c1, ... A passage is as many words as the item; a document shorter than the item is one passage.
    An item of fewer than five words is one shingle of its own length, found only in documents of just those words.
    SimHash is an estimate, so a similar passage is missed if its fingerprint is further than RADIUS bits away (a few
    in ten thousand at a similarity of exactly 0.8).
    Null or empty texts, and documents without words, hold nothing. Items without words match nothing, an item of a
    null id is listed as null. Repeated rows are judged each. An empty benchmark leaves all documents clean.
    """
    spark = docs.sparkSession
    docs = with_carried(docs, (("doc_id", "long"), ("text", "string")), carry)
    items = narrow(benchmark, ("item_id", "long"), ("text", "string"))
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    found = docs.withColumn("found", F.array().cast("array<struct<item:long,similarity:double,first:long,n:long>>"))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        rows = some.collect()  # about ITEM_BLOCK items
        index = spark.sparkContext.broadcast(ItemIndex.of([r["item_id"] for r in rows], [r["text"] for r in rows]))
        found = found.mapInArrow(searcher(index), found.schema)
    return found.select(
        "doc_id", F.size("found").cast("long").alias("n_items"), (F.size("found") > 0).alias("is_contaminated"),
        F.col("found.item").alias("items"), F.col("found.similarity").alias("similarities"),
        F.col("found.first").alias("first_words"), F.col("found.n").alias("n_words"), *(f"c{k}" for k in range(len(carry))))


def searcher(index):
    """Adds to each row's list what one block of items finds in its text."""
    kind = pa.list_(pa.struct([("item", pa.int64()), ("similarity", pa.float64()), ("first", pa.int64()), ("n", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: ItemIndex = index.value
        coarse = np.zeros(1 << 20, bool)
        coarse[items.keys >> np.uint64(44)] = True
        for batch in text_slices(batches, "text", 4 << 20):
            shingles, first = shingle_hashes(batch.column(1).to_pylist())
            maybe = np.flatnonzero(coarse[shingles >> np.uint64(44)])
            places, owners = items.hits(shingles[maybe])
            places = maybe[places]
            doc = np.searchsorted(first, places, side="right") - 1
            at = batch.schema.get_field_index("found")
            found = batch.column(at).to_pylist()
            for k in np.unique(doc):
                mine = doc == k
                leaks = items.leaks(shingles[first[k]:first[k + 1]], places[mine] - first[k], owners[mine])
                found[k] = sorted(
                    [*found[k], *({"item": items.ids[i], "similarity": v, "first": s, "n": w + SIZE - 1} for i, (v, s, w) in leaks.items())],
                    key=lambda x: (x["item"] is None, x["item"] or 0))
            yield batch.set_column(at, "found", pa.array(found, kind))

    return search
