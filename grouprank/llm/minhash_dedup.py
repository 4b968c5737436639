"""Near-duplicate classes by MinHash bands and sequential Bayesian verification (operator 11).

A document's set has its distinct shingles of two words. Sets get HASHES minwise hashes; sets that share all hashes of
one band are candidates. A candidate pair is compared BATCH hashes at a time: with a uniform prior, m equal hashes of n
leave similarity the posterior Beta(m + 1, n - m + 1), and the pair is pruned as soon as the chance that it reaches the
threshold is below MISS. Survivors are confirmed on their full sets.

No pair list of a group is ever made. Each set of a band's bucket first meets the bucket's pivot alone; the links found
give first components. Only sets of different components that share a bucket are then compared, block by block inside
tasks, which report a forest of the links that they find. So a group of copies that the pivots join costs no more than
its size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import TEXT_ROWS, grouped, narrow, text_slices, written
from grouprank.llm.components import components
from grouprank.llm.shingles import STEP, mix, powers

#: Linked from 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Minwise hashes; a pair at the threshold shares no band with (1 - 0.8^4)^32 = 5e-8.
HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
#: Hashes compared at a time, and the posterior chance of a link below which a pair is pruned.
BATCH, MISS = 32, 1e-6
#: Salts over which the sets that meet one pivot are dealt, and sets in a block of an open group.
SALTS, BLOCK = 4096, 256
#: Shingles of a block that are compared at a time, and cells of their matrix.
TOKENS, CELLS = 1 << 20, 1 << 22
#: Bytes of a set's minwise hashes: 16 bits of each.
SKETCH = 2 * HASHES

NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])


def fewest_equal(n: int, miss: float = MISS, percent: int = PERCENT) -> int:
    """The least number of equal hashes of n with which a pair stays.

    The posterior chance of a similarity of at least t is P(Beta(m + 1, n - m + 1) >= t), which is the chance of at most
    m successes in n + 1 draws with t.
    """
    t, below = percent / 100, 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        if below >= miss:
            return m
    return n


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of the two-word shingles of each text (of its one word, if it has just one)."""
    parts = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = NOT_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(1 << int(len(data)).bit_length())
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])))
    words = mix((sums[ends] - sums[starts]) * down[starts])
    first = np.searchsorted(starts, np.cumsum([0, *(len(p) + 1 for p in parts)]))
    pairs = mix((words[:-1] + np.uint64(2)) * np.uint64(STEP) + words[1:])
    found = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        found.append(np.unique(pairs[lo:hi - 1]) if hi - lo > 1 else mix(words[lo:hi] + np.uint64(1)))
    return found


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """A row of HASHES 32-bit minwise hashes for each set, none of which is empty."""
    draw = np.random.default_rng(11)
    factors = draw.integers(0, 1 << 31, HASHES, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = draw.integers(0, 1 << 32, HASHES, dtype=np.int64).astype(np.uint32)
    found = np.empty((len(sets), HASHES), np.uint32)
    if sets:
        low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        first = np.cumsum([0, *(len(s) for s in sets[:-1])])
        for k in range(HASHES):
            h = (low ^ shifts[k]) * factors[k]
            h ^= h >> np.uint32(15)
            found[:, k] = np.minimum.reduceat(h * np.uint32(0x2C1B3C6D), first)
    return found


def band_hashes(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of each row."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(len(hashes), axis=0)
    for k in range(ROWS):
        h = mix(h * np.uint64(STEP) + hashes[:, k::ROWS].astype(np.uint64))
    return h.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, key of the set, bands); the last two are null if the text has no word."""
    for batch in text_slices(batches, "text", 4 << 20):
        sets = shingle_sets(batch.column(1).to_pylist())
        hashes = minwise([s for s in sets if len(s)])
        made = iter(band_hashes(hashes).astype("<i8"))
        rows = [(set_key(s), next(made).tobytes()) if len(s) else (None, None) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*rows, strict=True))],
            ["doc_id", "n_shingles", "key", "bands"])


def band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, rep) of rows (rep, bands)."""
    for batch in batches:
        bands = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(bands), batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))],
                                         ["bucket", "rep"])


def full_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rep, value) of rows (text, key, rep) where the text's set has the key: value is sketch and shingles."""
    for batch in text_slices(batches, "text", 4 << 20):
        rows = zip(shingle_sets(batch.column(0).to_pylist()), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        same = [(s, rep) for s, key, rep in rows if len(s) and set_key(s) == key]
        sketches = minwise([s for s, _ in same]).astype("<u2")
        yield pa.RecordBatch.from_arrays(
            [pa.array([rep for _, rep in same], pa.int64()),
             pa.array([sketch.tobytes() + s.astype("<u8").tobytes() for sketch, (s, _) in zip(sketches, same, strict=True)], pa.binary())],
            ["rep", "value"])


def sketches(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(v[:SKETCH] for v in values), "<u2").reshape(-1, HASHES)


def unpruned(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, done: int = 0, equal: np.ndarray | None = None) -> np.ndarray:
    """Places of the pairs (rows a of left, b of right) that no batch of hashes prunes; the first `done` hashes had so many equal."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64) if equal is None else equal.astype(np.int64)
    for at in range(done, HASHES, BATCH):
        equal += (left[a[alive], at:at + BATCH] == right[b[alive], at:at + BATCH]).sum(axis=1)
        stay = equal >= fewest_equal(at + BATCH)
        alive, equal = alive[stay], equal[stay]
    return alive


def unpruned_pairs(left: np.ndarray, right: np.ndarray, meet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all rows of left with all rows of right, the pairs that meet and that no batch prunes; the first batch is compared for all at once."""
    equal = np.zeros(meet.shape, np.uint8)
    for x, y in zip(np.ascontiguousarray(left[:, :BATCH].T), np.ascontiguousarray(right[:, :BATCH].T), strict=True):
        equal += x[:, None] == y[None, :]
    a, b = np.nonzero(meet & (equal >= fewest_equal(BATCH)))
    stay = unpruned(left, right, a, b, BATCH, equal[a, b])
    return a[stay], b[stay]


def shingles(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<u8", offset=SKETCH)


def reach(common: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether pairs with so many common shingles, and sizes that sum to these, are linked."""
    return 100 * common >= PERCENT * (sizes - common)


def linked(a: bytes, b: bytes) -> bool:
    """Whether two values' full sets reach the threshold."""
    x, y = shingles(a), shingles(b)
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    return bool(reach(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)))


def common_shingles(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common shingles of all sets `left` with all sets `right`, by products of membership matrices.

    Sets are sorted, and taken in ranges of hashes that hold about TOKENS shingles, so that matrices stay small.
    """
    common = np.zeros((len(left), len(right)), np.int64)
    parts = max(1, sum(len(s) for s in sets) // TOKENS)
    edges = (np.arange(1, parts, dtype=np.float64) * 2.0 ** 64 / parts).astype(np.uint64)
    cuts = [np.concatenate(([0], np.searchsorted(s, edges), [len(s)])) for s in sets]
    for part in range(parts):
        some = [s[c[part]:c[part + 1]] for s, c in zip(sets, cuts, strict=True)]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in some])
        _, token, count = np.unique(np.concatenate(some), return_inverse=True, return_counts=True)
        several = count[token] > 1  # shingles of one set alone are common to none
        owner, token = owner[several], np.unique(token[several], return_inverse=True)[1]
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        last, width = int(token[-1]) + 1 if len(token) else 0, max(1, CELLS // len(sets))
        for at in range(0, last, width):
            lo, hi = np.searchsorted(token, [at, at + width])
            table = np.zeros((len(sets), min(width, last - at)), np.float32)
            table[owner[lo:hi], token[lo:hi] - at] = 1
            common += (table[left] @ table[right].T).astype(np.int64)
    return common


def with_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a rep and its pivot, of rows (pivot, salt, rep, value) in which the pivot's own is first.

    A group is read as a stream; only its pivot's value is held.
    """
    held = bytes(SKETCH)
    for batch in batches:
        if not batch.num_rows:
            continue
        pivot, rep = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        values = [held, *batch.column(3).to_pylist()]
        own = np.maximum.accumulate(np.where(pivot == rep, np.arange(1, len(rep) + 1), 0))
        held = values[own[-1]]
        members = np.flatnonzero(pivot != rep)
        table = sketches(values)
        stay = members[unpruned(table, table, members + 1, own[members])]
        stay = [n for n in stay.tolist() if linked(values[n + 1], values[own[n]])]
        yield pa.RecordBatch.from_arrays([pa.array(rep[stay]), pa.array(pivot[stay])], ["a", "b"])


def star(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Links (a, b) among rows (rep, pivot); the reps of one pivot are dealt over SALTS tasks, each with the pivot's value."""
    members = pairs.select("pivot", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).alias("salt"), "rep")
    pivots = members.select("pivot", "salt").distinct().withColumn("rep", F.col("pivot"))
    rows = members.union(pivots).join(values, "rep").select("pivot", "salt", "rep", "value")
    dealt = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", F.col("pivot") != F.col("rep"))
    return dealt.mapInArrow(with_pivot, "a long, b long")


def dealt(rows: DataFrame) -> DataFrame:
    """Deal rows (part, rep, comp) to pairs of blocks (i <= j), so that every two rows of a part and of two comps meet in one.

    A comp of at least BLOCK rows has blocks of its own, which aren't paired with one another; the smaller ones of a part
    share blocks. Adds i, j, block (the row's own).
    """
    sizes = rows.groupBy("part", "comp").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") < BLOCK).groupBy("part").agg(F.sum("n").alias("few"))
    sizes = sizes.join(small, "part", "left").withColumn("own", F.col("n") >= BLOCK)
    sizes = sizes.select("part", "comp", "own", F.ceil(F.when(F.col("own"), F.col("n")).otherwise(F.col("few")) / BLOCK).alias("blocks"))
    salt = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    placed = rows.join(sizes, ["part", "comp"]).withColumn("block", F.when(F.col("own"), F.xxhash64("comp", salt)).otherwise(salt))
    placed = placed.withColumn("pure", F.when(F.col("own"), F.col("comp"))).select("part", "rep", "comp", "block", "pure")
    one = placed.select("part", "block", "pure").distinct()
    other = one.select("part", F.col("block").alias("block2"), F.col("pure").alias("pure2"))
    pairs = one.join(other, "part").where("block <= block2 and not coalesce(pure = pure2, false)")
    ends = pairs.select("part", F.col("block").alias("i"), F.col("block2").alias("j"),
                        F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"))
    return placed.drop("pure").join(ends, ["part", "block"]).select("part", "i", "j", "block", "rep", "comp")


def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forest (a, b) of the components that links join, in each pair of blocks."""
    for table in grouped(batches, ["part", "i", "j"]):
        comp, block = (table.column(c).to_numpy() for c in ("comp", "block"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        values = table.column("value").to_pylist()
        left, right = (np.arange(len(comp)),) * 2 if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))
        meet = comp[left][:, None] != comp[right][None, :]
        if i == j:
            meet &= left[:, None] < right[None, :]
        sketch = sketches(values)
        a, b = unpruned_pairs(sketch[left], sketch[right], meet)
        if len(a) > len(values):  # one product for all pairs; few pairs are compared one by one
            sets = [shingles(v) for v in values]
            size = np.array([len(s) for s in sets])
            stay = reach(common_shingles(sets, left, right)[a, b], size[left[a]] + size[right[b]])
        else:
            stay = np.array([linked(values[m], values[n]) for m, n in zip(left[a].tolist(), right[b].tolist(), strict=True)], bool)
        root: dict[int, int] = {}
        found = []
        for m, n in zip(comp[left[a[stay]]].tolist(), comp[right[b[stay]]].tolist(), strict=True):
            x, y = ending(root, m), ending(root, n)
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append((max(x, y), min(x, y)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])


def ending(root: dict[int, int], x: int) -> int:
    """Where x leads to; the way there is shortened."""
    while root.get(x, x) != x:
        root[x] = root.get(root[x], root[x])
        x = root[x]
    return x


def compared(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Links (a, b) between comps of rows (part, rep, comp) of one part."""
    blocks = dealt(rows).join(values, "rep").select("part", "i", "j", "block", "rep", "comp", "value")
    return blocks.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j").mapInArrow(across, "a long, b long")


def full_sets(docs: DataFrame, sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, value) with the full sets of reps, made anew from the text of the first document that has each."""
    wanted = sets.select("rep", "key", "doc_id").join(reps, "rep", "left_semi")
    rows = docs.join(wanted, "doc_id").select("text", "key", "rep").mapInArrow(full_rows, "rep long, value binary")
    return written(rows.dropDuplicates(["rep"]), "minhash-full", rows_per_batch=TEXT_ROWS)


def relabelled(rows: DataFrame, label: str, found: DataFrame) -> DataFrame:
    """rows with label replaced by the component that found gives it, where it does."""
    return rows.join(found.toDF(label, "_new"), label, "left").withColumn(label, F.coalesce("_new", label)).drop("_new")


def minhash_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z in lower case; a document's set has its distinct shingles
    of two words, or its one word. Documents are linked if 100 * intersection >= 80 * union, which is confirmed on full
    sets. component_id is the least doc_id that links reach, kept says that this is the document's own.
    A pair at the threshold is missed with a chance of about 1e-6 (no shared band, or pruned by mistake).
    Null and empty texts have no shingle and no link. A null doc_id has no link, a null component_id, and is kept.
    Rows that share an id count as copies if their sets are equal, and keep that id. Repeated rows each give a row.
    An empty table gives no rows; further columns take no part.
    """
    docs = narrow(docs, ("doc_id", "long"), ("text", "string"))
    rows = written(docs.mapInArrow(set_rows, "doc_id long, n_shingles long, key binary, bands binary"), "minhash-sets",
                   rows_per_batch=TEXT_ROWS)
    usable = rows.where("doc_id is not null and key is not null")
    # each distinct set with its least doc_id and that row's bands, in one aggregate
    least = usable.groupBy("key").agg(F.min(F.struct("doc_id", "bands")).alias("x"))
    sets = written(least.select("key", F.xxhash64("key").alias("rep"), "x.doc_id", "x.bands"), "minhash-reps", rows_per_batch=TEXT_ROWS)

    in_bucket = written(sets.select("rep", "bands").mapInArrow(band_rows, "bucket long, rep long"), "minhash-buckets")
    # a bucket's pivot is the set whose number, mixed with the bucket's, is least: a set's buckets have different pivots
    buckets = in_bucket.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.expr("rep ^ bucket")).alias("m"), F.sum(F.hash("rep").cast("long")).alias("f"),
                                              F.bit_xor("rep").alias("x")).where("n > 1").withColumn("pivot", F.expr("m ^ bucket"))
    # bands that hold the same sets are one bucket
    buckets = buckets.groupBy("n", "f", "x").agg(F.min("bucket").alias("bucket"), F.min("pivot").alias("pivot"))
    member = written(in_bucket.join(buckets.select("bucket", "pivot", "n"), "bucket"), "minhash-members")
    values = full_sets(docs, sets, member.select("rep"))
    first = components(star(member.where("rep != pivot").select("rep", "pivot").distinct(), values))

    # a bucket of two has met its pivot; of larger ones, those of one component need nothing more
    labelled = relabelled(member.where("n > 2").select(F.col("bucket").alias("part"), "rep", F.col("rep").alias("comp")), "comp", first)
    labelled = written(labelled, "minhash-labelled")
    open_ = labelled.groupBy("part").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("part")
    second = components(compared(labelled.join(open_, "part"), values))

    members = relabelled(sets.select("rep", "key", "doc_id", F.col("rep").alias("comp")), "comp", first)
    members = relabelled(members, "comp", second).select("comp", "key", "doc_id")
    least = members.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_key = members.join(least, "comp").select("key", "component_id")
    found = usable.join(of_key, "key").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("doc_id is null or key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumn("kept", kept())


def kept() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
