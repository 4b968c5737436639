import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from grouprank.llm.packing import best_fit, fix_dominating, pack_documents, pieces_of, reduced_best_fit
from grouprank.llm.token_matrix import best_fit_decreasing, token_matrices, write_matrices
from grouprank.llm.tokenizing import json_tokenizer, tokenizer_path
from tests.llm.helpers import awkward_documents, empty_documents, prose


def ids_of(text):
    return json_tokenizer(tokenizer_path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids + [0]


def used(runs):
    n = Counter()
    for parts, times in runs:
        for s, each in parts:
            n[s] += each * times
    return n


def least_bins(sizes, capacity):
    """Exact, by trying all ways."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1:]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_reduction_keeps_the_optimum():
    draw = np.random.default_rng(3)
    for _ in range(150):
        capacity = int(draw.integers(8, 30))
        sizes = sorted(draw.integers(1, capacity + 1, draw.integers(1, 10)).tolist(), reverse=True)
        counts = np.bincount(sizes, minlength=capacity + 1)
        fixed, rest = fix_dominating(counts, capacity)
        assert used(fixed) + Counter({s: int(n) for s, n in enumerate(rest) if n}) == Counter(sizes)
        left = [s for s in range(capacity, 0, -1) for _ in range(rest[s])]
        assert sum(t for _, t in fixed) + (least_bins(left, capacity) if left else 0) == least_bins(sizes, capacity)


def test_best_fit_equals_the_item_by_item_rule():
    draw = np.random.default_rng(4)
    for _ in range(60):
        capacity = int(draw.integers(5, 60))
        lengths = draw.integers(1, capacity + 1, draw.integers(1, 80))
        bins = []
        for s in sorted(lengths.tolist(), reverse=True):
            fits = [b for b in bins if b[0] >= s]
            if fits:
                b = min(fits, key=lambda b: b[0])
            else:
                bins.append(b := [capacity])
            b[0] -= s
        runs = best_fit(np.bincount(lengths, minlength=capacity + 1), capacity)
        assert used(runs) == Counter(lengths.tolist())
        assert all(sum(s * e for s, e in parts) <= capacity for parts, _ in runs)
        assert sum(t for _, t in runs) == len(bins) == len(best_fit_decreasing(lengths, capacity))


def test_equal_lengths_in_bulk():
    counts = np.zeros(2049, np.int64)
    counts[[1, 700, 1024, 2048]] = [10**9, 10**9, 10**9, 5]
    runs = reduced_best_fit(counts, 2048)
    assert used(runs) == Counter({1: 10**9, 700: 10**9, 1024: 10**9, 2048: 5})
    total = int((counts * np.arange(2049)).sum())
    assert sum(t for _, t in runs) <= 1.4 * math.ceil(total / 2048)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack_documents(spark, capacity):
    docs = awkward_documents(spark)
    rows = pack_documents(docs, capacity).collect()
    expected = Counter()
    for r in docs.collect():
        ids = ids_of(r["text"])
        for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
            expected[r["doc_id"], k, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4"))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in at.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert sum(n for _, n in spans) <= capacity
    total = sum(r["length"] for r in rows)
    assert len(at) <= math.ceil(total / capacity) + 1 + len(rows) // 10


def test_pieces():
    assert pieces_of(5, 5) == [(0, 5)]
    assert pieces_of(11, 5) == [(0, 1), (1, 5), (6, 5)]
    assert pieces_of(10, 5) == [(0, 5), (5, 5)]


def test_matrices_round_trip(spark, tmp_path):
    docs = awkward_documents(spark)
    width = 64
    write_matrices(token_matrices(docs, width, pad_id=9, block_tokens=1000), f"{tmp_path}/m")
    found = defaultdict(dict)
    for r in spark.read.parquet(f"{tmp_path}/m").collect():
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == width and (ids[r["n_tokens"]:] == 9).all()
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert r["position_resets"] == [p for p in r["cu_seqlens"] if p < width]
        for d, k, lo, hi in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"][:-1], r["cu_seqlens"][1:], strict=True):
            found[d].setdefault(k, []).append(ids[lo:hi].tolist())
    for r in docs.collect():
        pieces = [found[r["doc_id"]][k][0] for k in sorted(found[r["doc_id"]])]
        assert sum(pieces, []) == ids_of(r["text"])
    assert len(found[7][0]) == 2  # the repeated row


def test_ids_past_16_bits_are_an_error(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    with pytest.raises(Exception, match="16 bits"):
        token_matrices(docs, 64, end_id=70_000).collect()


def test_empty(spark):
    assert pack_documents(empty_documents(spark)).collect() == []
    assert token_matrices(empty_documents(spark)).collect() == []


def test_ids_equal_the_library(spark):
    from grouprank.llm.packing import SPECIAL
    from grouprank.llm.tokenizing import token_ids
    texts = ["", " ", "a<|endoftext|>b", "don't 've  \n\n x\t", "naïve façade 12,345", "漢字 mixed ✓ text", "a" * 70_000, prose(1, 20_000),
             " " * 50_000, "x\n" * 40_000, "Ünïcode " * 9_000]
    for t in texts:
        got = token_ids(t, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), SPECIAL)
        assert got.tolist() == ids_of(t)[:-1]
