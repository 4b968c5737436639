"""Spelling variants of a vocabulary by dense prefix-suffix tiling (operator 12).

Two words differ by a single edit exactly if their common prefix and common suffix together reach the longer length m
less one. Then one of the two is at least m // 2 long, so words are grouped by (m, side, half): every word takes part
with m its own length and with m one more, by its first and by its last m // 2 characters. A pair has one m, and is
taken on the prefix side if its prefix reaches m // 2, else on the suffix side: it is met once.

The words of a group become two matrices of code points, padded on the right for prefixes and on the left for suffixes.
Groups are cut into blocks, and pairs of blocks are compared position by position for all their pairs at once; runs of
small groups are compared along their diagonals, many groups in one operation.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import TEXT_ROWS, narrow, text_slices, written

#: Shortest words and fewest occurrences that count, and how much more frequent a word's form is.
LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 7, 2, 10
#: One run of so many loses a letter.
DAMAGED = 31
#: Words of a block, of a group that is compared along diagonals, and of words that are compared position by position.
BLOCK, SMALL, SHORT = 512, 24, 64
#: Bytes of one comparison's matrices.
MOST_BYTES = 8 << 20

RUN = re.compile(rb"[a-z\xC0-\xFF]{%d,}" % LEAST_LETTERS)


def damaged_words(doc_id: int | None, text: str) -> Counter:
    """Counts of a document's words as bytes, one for each code point, some with a letter lost by a hash of document and run.

    Code points past U+00FF end a run as any other character that is no letter.
    """
    found = Counter()
    for run, n in Counter(RUN.findall(text.encode("latin-1", "replace").lower())).items():
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run.decode('latin-1')}".encode())
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_LETTERS:
            found[run] += n
    return found


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n), each word once for about 8 MB of texts."""
    for batch in text_slices(batches, "text", 8 << 20):
        total: Counter = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                total.update(damaged_words(doc_id, text))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
                                         ["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of documents that have LEAST_LETTERS code points or more and LEAST_COUNT occurrences."""
    docs = narrow(docs, ("doc_id", "long"), ("text", "string"))
    counts = docs.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts.where(F.col("n") >= LEAST_COUNT), "spelling-words", rows_per_batch=TEXT_ROWS)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches sorted by the keys as tables in which no run of equal keys is cut."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        columns = [table.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        held = table.slice(last)
    if held is not None:
        yield held.combine_chunks()


class Tile:
    """Words of one (m, side) as matrices of code points, and the test for single edits."""

    def __init__(self, words: list[bytes], m: int, suffix: bool):
        self.m, self.suffix, self.half = m, suffix, m // 2
        self.left = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(-1, m)
        # suffixes are read from the end
        self.right = np.frombuffer(b"".join(w.rjust(m, b"\0") for w in words), np.uint8).reshape(-1, m)[:, ::-1]
        self.short = np.array([len(w) < m for w in words])

    def edits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs (rows a, rows b) that differ by one edit and belong to this side."""
        found = []
        step = max(1, MOST_BYTES // self.m)
        for at in range(0, len(a), step):
            x, y = a[at:at + step], b[at:at + step]
            prefix, suffix = (np.where((same := t[x] == t[y]).all(axis=1), self.m, same.argmin(axis=1)) for t in (self.left, self.right))
            mine = (prefix < self.half) if self.suffix else (prefix >= self.half)
            found.append(at + np.flatnonzero((prefix + suffix >= self.m - 1) & mine & ~(self.short[x] & self.short[y])))
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def diagonals(self, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs within runs (equal numbers, one after another) of small groups."""
        rows = np.arange(len(run))
        found = [(rows[:0], rows[:0])]
        for d in range(1, len(run)):
            a = rows[:-d][run[d:] == run[:-d]]
            if not len(a):
                break
            stay = self.edits(a, a + d)
            found.append((a[stay], a[stay] + d))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def dense(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows a with rows b, all compared position by position; of a block with itself, each pair once."""
        near = (self.right if self.suffix else self.left).T, (self.left if self.suffix else self.right).T
        shape = (len(a), len(b))
        shared = []
        # the group's half is shared; the rest of that side, and what the other side needs at most
        for table, lo, hi in ((near[0], self.half, self.m), (near[1], 0, self.m - 1 - self.half)):
            alive, length = np.ones(shape, bool), np.zeros(shape, np.uint8)
            x, y = np.ascontiguousarray(table[:, a]), np.ascontiguousarray(table[:, b])
            for k in range(lo, hi):
                alive &= x[k][:, None] == y[k][None, :]
                length += alive
            shared.append(length)
        likely = self.half + shared[0] + shared[1] >= self.m - 1
        if len(a) == len(b) and (a == b).all():
            likely &= a[:, None] < b[None, :]
        x, y = np.nonzero(likely)
        x, y = a[x], b[y]
        stay = self.edits(x, y)
        return x[stay], y[stay]


def blocks_of(tile: Tile, block: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Single edits of one pair of blocks (rows as in tile); blocks are cut so that matrices stay small."""
    rows = np.arange(len(block))
    left, right = (rows, rows) if i == j else (rows[block == i], rows[block == j])
    if tile.m <= SHORT:
        return tile.dense(left, right)
    found = [(rows[:0], rows[:0])]
    for a in left.tolist():
        b = right[right > a] if i == j else right
        stay = tile.edits(np.full(len(b), a), b)
        found.append((np.full(len(stay), a), b[stay]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def single_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions (word, near, near_n) of the pairs of each group's pair of blocks, of rows sorted by them."""
    for table in whole_runs(batches, ["m", "suffix", "half", "i", "j"]):
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        m, suffix, half, i, j, block = (table.column(c).to_numpy() for c in ("m", "suffix", "half", "i", "j", "block"))
        new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in (m, suffix, half, i, j)], axis=0)))
        run = np.cumsum(new) - 1
        size = np.bincount(run)
        kind = np.concatenate(([0], np.flatnonzero((m[1:] != m[:-1]) | (suffix[1:] != suffix[:-1])) + 1, [len(m)]))
        pairs = []
        for lo, hi in zip(kind[:-1].tolist(), kind[1:].tolist(), strict=True):
            # a short run is one whole group; a pair of blocks is longer
            small = lo + np.flatnonzero((size[run[lo:hi]] <= SMALL) & (i[lo:hi] == j[lo:hi]))
            if len(small):
                a, b = Tile([words[x] for x in small.tolist()], int(m[lo]), bool(suffix[lo])).diagonals(run[small])
                pairs.append((small[a], small[b]))
            starts = lo + np.flatnonzero(new[lo:hi])
            for at, end in zip(starts.tolist(), [*starts[1:].tolist(), hi], strict=True):
                if end - at > SMALL or i[at] != j[at]:
                    a, b = blocks_of(Tile(words[at:end], int(m[at]), bool(suffix[at])), block[at:end], int(i[at]), int(j[at]))
                    pairs.append((at + a, at + b))
        a, b = (pa.array(np.concatenate(x)) for x in zip(*pairs, strict=True))
        both = pa.chunked_array([a, b]), pa.chunked_array([b, a])
        word, n = table.column("word"), table.column("n")
        yield from pa.table({"word": word.take(both[0]), "near": word.take(both[1]), "near_n": n.take(both[1])}).to_batches(max_chunksize=10_000)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways, for the words (word, n) that differ by one inserted, deleted or replaced code point."""
    length = F.length("word")
    side = [F.struct(m.alias("m"), F.lit(s).alias("suffix"), F.xxhash64(F.right("word", half) if s else F.left("word", half)).alias("half"))
            for m in (length, length + 1) for half in [(m / 2).cast("int")] for s in (0, 1)]
    rows = words.select("word", "n", F.explode(F.array(*side)).alias("g")).select("g.*", "word", "n")
    groups = rows.groupBy("m", "suffix", "half").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.join(groups, ["m", "suffix", "half"]).withColumn("blocks", blocks)
    rows = (rows.withColumn("block", F.pmod(F.xxhash64("word", F.lit(12)), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    keys = ["m", "suffix", "half", "i", "j"]
    rows = rows.select(*keys, "block", "word", "n").repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(single_edits, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last word that forms lead to, by doubling the steps taken.

    A form is FORM_RATIO times as frequent as its word, so there is no circle, and a few rounds reach every end.
    """
    now = written(forms.toDF("word", "root"), "spelling-roots")
    while True:
        step = now.toDF("root", "_next")
        further = written(now.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
                          "spelling-roots")
        now = further.select("word", "root")
        if further.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame) -> DataFrame:
    """One row per word of (word, n), which has each word once: word, form, root, n, n_near, form_n.

    Words have 7 code points or more, all up to U+00FF (others are not compared: such rows are an error). Two words are near if they differ by exactly
    one inserted, deleted or replaced code point. form is the near word of largest n (ties: the smallest in code-point order) if that is
    at least 10 times n, else null, and form_n its n; root is the word that forms lead to in the end, the word itself if
    it has no form; n_near counts the near words. An empty table gives no rows.
    """
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = -F.col("best.less") >= FORM_RATIO * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", F.when(frequent, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n"))
    found = written(found, "spelling-forms")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame) -> DataFrame:
    """spelling_variants of the words of documents, in which one run of letters in DAMAGED has lost a letter.

    Runs are maximal in A-Z, a-z and U+00C0-U+00FF; only A-Z become lower case. The hash that picks runs and letters is
    the CRC-32 of `doc_id:run` (a null doc_id: empty). Null and empty texts have no words; repeated rows count again;
    further columns take no part. Texts without words, and empty tables, give no rows.
    """
    return spelling_variants(vocabulary(docs))
