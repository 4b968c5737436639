"""Token-id matrices with segment lengths and position resets (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from grouprank.llm.common import narrow, text_slices
from grouprank.llm.packing import SPECIAL, pieces_of
from grouprank.llm.tokenizing import token_ids, tokenizer_path


class RoomTree:
    """Segment tree over the room left in a sequence: leaf r counts the open sequences with room r, nodes hold sums."""

    def __init__(self, capacity: int):
        self.size = 1 << int(capacity).bit_length()
        self.sums = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.sums[at] += n
            at //= 2

    def first_from(self, room: int) -> int | None:
        """The least room of at least `room` that an open sequence has."""
        at = room + self.size
        if self.sums[at]:
            return room
        while at > 1 and not (at % 2 == 0 and self.sums[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.sums[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Sequences as lists of piece indexes: longest pieces first, each into the fullest sequence that has room."""
    tree = RoomTree(capacity)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by the room that is left
    sequences: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = tree.first_from(need)
        if room is None:
            room, at = capacity, len(sequences)
            sequences.append([])
        else:
            at = waiting[room].pop()
            tree.add(room, -1)
        sequences[at].append(i)
        if room > need:
            waiting[room - need].append(at)
            tree.add(room - need, 1)
    return sequences


SCHEMA = ("sequence_id long, n_tokens int, doc_ids array<long>, pieces array<int>, starts array<long>, "
          "cu_seqlens array<int>, position_resets array<int>, ids binary")


def token_matrices(docs: DataFrame, width: int = 2048, end_id: int = 0, pad_id: int = 0,
                   block_tokens: int = 1 << 23, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Packed rows of token ids, one row per sequence of `width` ids.

    Columns: sequence_id; n_tokens (without padding); doc_ids, pieces and starts of the segments in order;
    cu_seqlens (cumulative segment lengths from 0); position_resets (where positions start again from 0: at each
    segment, and at the padding if there is any); ids (width little-endian uint16, padded with pad_id).
    A document longer than width is cut without loss: its pieces in order give back its ids (the first may be shorter).
    Each task packs its documents in blocks of about block_tokens ids by best-fit decreasing, so nothing is shuffled
    and a task holds one block; the cost is at most a few sequences a block that are not full.
    Null text gives the end id alone, a null doc_id stays null, repeated rows are kept each, an empty table gives no
    rows.
    """
    json_path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    ranks_path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")

    def packed(held: list[tuple], first_id: int) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(8)]
        for n, members in enumerate(best_fit_decreasing(np.array([len(h[3]) for h in held]), width)):
            parts = [held[i] for i in members]
            ends = np.cumsum([0] + [len(p[3]) for p in parts])
            total = int(ends[-1])
            ids = np.full(width, pad_id, dtype="<u2")
            ids[:total] = np.concatenate([p[3] for p in parts])
            resets = ends.tolist() if total < width else ends[:-1].tolist()
            row = (first_id + n, total, [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts],
                   ends.tolist(), resets, ids.tobytes())
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()),
                 pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                          [part.split()[0] for part in SCHEMA.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40  # the same again when a lost task is run anew
        held: list[tuple] = []
        n_held = 0
        for batch in text_slices(batches, "text", 4 << 20):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(text or "", json_path, ranks_path, SPECIAL), np.uint32(end_id))
                if ids.max() > np.iinfo("<u2").max:
                    raise ValueError(f"id {ids.max()} doesn't fit the 16 bits of a row")
                ids = ids.astype("<u2")
                for k, (start, length) in enumerate(pieces_of(len(ids), width)):
                    held.append((doc_id, k, start, ids[start:start + length]))
                n_held += len(ids)
                if n_held >= block_tokens:
                    block = packed(held, next_id)
                    next_id += block.num_rows
                    held, n_held = [], 0
                    yield from (block.slice(at, 1024) for at in range(0, block.num_rows, 1024))
        if held:
            yield packed(held, next_id)

    return narrow(docs, ("doc_id", "long"), ("text", "string")).mapInArrow(pack, SCHEMA)


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Write the rows as Parquet files: fixed-width id rows beside their segment lengths and position resets."""
    matrices.write.parquet(path)
