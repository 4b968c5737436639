"""Packing of token pieces into sequences of a fixed capacity (operator 1).

The packing problem is solved over the histogram of piece lengths, which has at most `capacity` rows however many
documents there are. The solution is a list of runs: so many sequences with the same lengths in the same order.
Pieces are then numbered within their length, in parallel, and each number is looked up in the runs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grouprank.llm.common import TEXT_ROWS, narrow, text_slices, written
from grouprank.llm.tokenizing import token_ids, tokenizer_path

#: lengths of a sequence in order, as (length, how many), and the number of such sequences
Run = tuple[tuple[tuple[int, int], ...], int]

SPECIAL = "<|endoftext|>"


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: whole if it fits, else the remainder first, then full pieces."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None,
                     ranks: str | None = None) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (of little-endian uint32 ids).

    A document's ids are its text's tokens, then end_id; null text is empty, so it gives one piece with end_id alone.
    """
    json_path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    ranks_path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 4 << 20):
            out: list[list] = [[] for _ in range(5)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(text or "", json_path, ranks_path, SPECIAL), np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    row = (doc_id, k, start, length, zlib.crc32(ids[start:start + length]))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return narrow(docs, ("doc_id", "long"), ("text", "string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fix_dominating(counts: np.ndarray, capacity: int) -> tuple[list[Run], np.ndarray]:
    """Martello-Toth reduction: sequences that some best packing holds, and the counts that are left.

    counts[s] is the number of pieces of length s. For a piece j the feasible set F holding j is fixed when every other
    feasible set holding j can be replaced by F without more sequences, which holds when
    - nothing else fits beside j: F = {j};
    - one piece fills the rest exactly, or only one more piece can ever fit: F = {j, the largest that fits};
    - at most two more can fit and the largest that fits is no less than the best pair: the same F;
    - at most two more can fit, the best pair (a, b) has the largest that fits as a, and no pair of pieces
      both longer than b fits: F = {j, a, b}.
    """
    counts = counts.copy()
    fixed: list[Run] = []

    def smallest(without: int, how_many: int) -> list[int]:
        counts[without] -= 1
        found: list[int] = []
        for s in np.flatnonzero(counts):
            found += [int(s)] * int(min(counts[s], how_many - len(found)))
            if len(found) == how_many:
                break
        counts[without] += 1
        return found

    def take(parts: list[int]) -> None:
        need = {s: parts.count(s) for s in parts}
        times = min(int(counts[s]) // k for s, k in need.items())
        for s, k in need.items():
            counts[s] -= k * times
        fixed.append((tuple((s, parts.count(s)) for s in dict.fromkeys(parts)), times))

    def largest(most: int, without: int) -> int:
        counts[without] -= 1
        below = np.flatnonzero(counts[:most + 1])
        counts[without] += 1
        return int(below[-1]) if len(below) else 0

    def best_pair(room: int, without: int) -> tuple[int, int]:
        counts[without] -= 1
        sizes = np.flatnonzero(counts)
        best, lo, hi = (0, 0), 0, len(sizes) - 1
        while lo <= hi:
            a, b = int(sizes[hi]), int(sizes[lo])
            if a + b > room or (lo == hi and counts[a] < 2):
                hi -= 1
            else:
                best = max(best, (a, b), key=lambda p: (sum(p), p[0]))
                lo += 1
        counts[without] += 1
        return best

    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(counts)[::-1]:
            j = int(j)
            while counts[j]:
                room, low = capacity - j, smallest(j, 3)
                if not low or low[0] > room:
                    take([j])
                elif (top := largest(room, j)) == room or len(low) < 2 or low[0] + low[1] > room:
                    take([j, top])
                elif len(low) == 3 and sum(low) <= room:
                    break
                else:
                    a, b = best_pair(room, j)
                    counts[j] -= 1
                    longer = [int(s) for s in np.flatnonzero(counts[b + 1:])[:2] + b + 1]
                    if longer and counts[longer[0]] > 1:
                        longer = [longer[0]] * 2
                    counts[j] += 1
                    if top >= a + b:
                        take([j, top])
                    elif a == top and (len(longer) < 2 or sum(longer) > room):
                        take([j, a, b])
                    else:
                        break
                changed = True
            if len(low := np.flatnonzero(counts)) and capacity - j >= 3 * int(low[-1]):
                break  # three of any remaining pieces fit beside every shorter one
    return fixed, counts


def best_fit(counts: np.ndarray, capacity: int) -> list[Run]:
    """Best-fit decreasing over counts of lengths, whole groups of equal pieces at a time."""
    open_runs: list[list[Run]] = [[] for _ in range(capacity + 1)]  # by the room that is left
    for s in np.flatnonzero(counts)[::-1]:
        s, left = int(s), int(counts[s])
        while left:
            room = next((r for r in range(s, capacity) if open_runs[r]), capacity)
            fits = room // s
            if room == capacity:
                parts, times = (), -(-left // fits)
            else:
                parts, times = open_runs[room].pop()
            full = min(times, left // fits)
            if full:
                open_runs[room - fits * s].append((parts + ((s, fits),), full))
                left -= full * fits
            if full < times and left:
                open_runs[room - left * s].append((parts + ((s, left),), 1))
                left, full = 0, full + 1
            if full < times and room < capacity:
                open_runs[room].append((parts, times - full))
    return [run for runs in open_runs for run in runs]


def reduced_best_fit(counts: np.ndarray, capacity: int) -> list[Run]:
    """Fix dominating sets first, then best-fit what is left."""
    fixed, rest = fix_dominating(counts, capacity)
    return fixed + best_fit(rest, capacity)


def lookup_of(runs: list[Run]) -> dict[int, np.ndarray]:
    """By length: rows (first number, first sequence, pieces of this length in each sequence, offset of the first)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for parts, times in runs:
        offset = 0
        for s, each in parts:
            first = used.get(s, 0)
            rows.setdefault(s, []).append((first, sequence, each, offset))
            used[s] = first + times * each
            offset += s * each
        sequence += times
    return {s: np.array(r, dtype=np.int64) for s, r in rows.items()}


def placed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces (a written table, as it is read three times).

    Pieces of one length are numbered in about sqrt(n) buckets of sqrt(n) rows, so a length that a third of all pieces
    have is spread over many tasks. Only the histogram (at most `capacity` rows) reaches the driver.
    """
    histogram = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in histogram:
        counts[r["length"]] = r["count"]
    lookup = lookup_of(reduced_best_fit(counts, capacity))

    # at most `capacity` rows
    buckets = pieces.sparkSession.createDataFrame(
        [(int(s), int(np.ceil(np.sqrt(counts[s])))) for s in np.flatnonzero(counts)], "length long, buckets int")
    keyed = (pieces.join(F.broadcast(buckets), "length")
             .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("buckets")).cast("int"))
             .drop("buckets"))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (keyed.withColumn("number", F.row_number().over(within) - 1)
                .join(before, ["length", "bucket"])
                .withColumn("number", F.col("number") + F.coalesce("before", F.lit(0)))
                .drop("before", "bucket"))
    columns = [c for c in pieces.columns]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = dict(zip(batch.schema.names, batch.columns, strict=True))
            length, number = at["length"].to_numpy(), at["number"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for s in np.unique(length):
                mine = length == s
                rows = lookup[int(s)]
                first, base, each, start = rows[np.searchsorted(rows[:, 0], number[mine], side="right") - 1].T
                nth = number[mine] - first
                sequence[mine] = base + nth // each
                offset[mine] = start + (nth % each) * s
            yield pa.RecordBatch.from_arrays([*(at[c] for c in columns), pa.array(sequence), pa.array(offset)],
                                             [*columns, "sequence_id", "offset"])

    return numbered.select(*columns, "number").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None,
                   ranks: str | None = None) -> DataFrame:
    """Best-fit packing after Martello-Toth reduction: one row per piece with its place.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Every piece of every document is placed
    once; the pieces of a sequence lie without gaps from offset 0 and hold at most `capacity` ids. Only documents of
    more than `capacity` ids are cut. Null text is empty. Repeated rows are packed each. An empty table gives no rows.
    """
    pieces = written(tokenized_pieces(docs, capacity, end_id, tokenizer, ranks), "pieces", rows_per_batch=TEXT_ROWS)
    return placed(pieces, capacity)
