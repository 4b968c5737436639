"""Single edits, forms and roots against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from grouprank.llm import spelling_variants as sv
from tests.llm.helpers import awkward_documents, empty_documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words):
    form, rows = {}, {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
        rows[w] = len(near)
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, rows[w], words[form[w]] if form[w] else None))
    return sorted(out)


def invented(seed, stems, most):
    """Words about a few stems, so that many are near each other, of repeated letters too."""
    draw, words = random.Random(seed), {}
    letters = "abcàÿ÷"
    for _ in range(stems):
        stem = "".join(draw.choice(letters) for _ in range(draw.randrange(7, 13)))
        for _ in range(draw.randrange(1, most)):
            w = list(stem)
            for _ in range(draw.randrange(3)):
                at = draw.randrange(len(w))
                w[at:at + draw.randrange(2)] = draw.choice(["", "a", "b", "à"])
            if len(w) >= 7:
                words["".join(w)] = draw.choice([2, 2, 3, 20, 30, 300, 5000])
    return words


@pytest.mark.parametrize("block,small", [(512, 24), (4, 3), (16, 2)])
def test_variants_equal_brute_force(spark, monkeypatch, block, small):
    """In whole groups, in pairs of small blocks, and along diagonals."""
    monkeypatch.setattr(sv, "BLOCK", block)
    monkeypatch.setattr(sv, "SMALL", small)
    words = invented(block, 30, 14)
    words |= {"a" * k: 10 ** (k % 4) for k in range(7, 30)}  # a word is near the next longer one
    words |= {"x" * 5000: 2, "x" * 4999 + "y": 2, "x" * 5001: 40, "y" + "x" * 4999: 3}
    found = sorted(tuple(r) for r in sv.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect())
    assert found == brute(words)
    assert any(r[1] != r[2] and r[1] for r in found)  # a chain of forms


def test_documents(spark):
    """Damage, letters past Latin-1 and capitals as the contract says; nulls, repeated rows, empty tables."""
    draw = random.Random(4)
    base = ["Réunion", "straßen", "ÀÉÎÕÜÿÿ", "letters", "Windows", "forêtsœuvre", "abcdefgĀhijklmnop", "×÷×÷×÷×", "summers"]
    rows = [(n, " ".join(draw.choice(base) + draw.choice(["", "s", "-", "1", "日本"]) for _ in range(60))) for n in range(40)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (5, None), (6, ""), (7, "q" * 100_000 + " " + "q" * 100_000)]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n long")
    assert sorted(tuple(r) for r in sv.document_variants(df).collect()) == brute(counted(rows))
    awkward = awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in sv.document_variants(awkward).collect()) == brute(counted(rows))
    assert sv.document_variants(empty_documents(spark)).count() == 0
