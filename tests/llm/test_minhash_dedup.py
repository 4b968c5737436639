"""Near-duplicate components against brute force over all pairs, and the sequential test's bounds."""

import math
import random
import re

import numpy as np

from grouprank.llm import minhash_dedup as md
from tests.llm.helpers import awkward_documents, empty_documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def brute(rows):
    """{row number: (doc_id, n_shingles, component_id, kept)} by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                label[find(a)] = find(b)
    out = []
    for a, (doc, _) in enumerate(rows):
        same = [rows[b][0] for b in range(len(rows)) if find(b) == find(a)]
        comp = min(same) if doc is not None else None
        out.append((doc, len(sets[a]), comp, doc == comp))
    return sorted(out, key=str)


def variants(seed, n, words, edits):
    draw, base = random.Random(seed), prose(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(draw.randrange(edits + 1)):
            w[draw.randrange(len(w))] = "new" + str(draw.randrange(10**6))
        out.append(" ".join(w))
    return out


def compare(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in md.minhash_components(df).collect()), key=str)
    assert found == brute(rows)


def test_components_equal_brute_force(spark, monkeypatch):
    """Chains of near copies, groups near the threshold on both sides, and blocks smaller than the groups."""
    monkeypatch.setattr(md, "BLOCK", 8)
    texts = variants(1, 40, 60, 8) + variants(2, 25, 30, 6) + variants(3, 30, 120, 22) + [prose(s, 50) for s in range(10, 40)]
    draw = random.Random(5)
    for n in range(20):  # a chain: each link changes a few words of the one before
        w = texts[-1].split()
        w[draw.randrange(len(w))] = f"chain{n}"
        texts.append(" ".join(w))
    texts += texts[3:9] + [None, "", " \n", "one", "ONE", "one two", "Été à", "été à", "ÉTÉ à"]
    draw.shuffle(texts)
    compare(spark, list(enumerate(texts)))


def test_awkward_rows(spark):
    rows = [(r.doc_id, r.text) for r in awkward_documents(spark).select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in md.minhash_components(awkward_documents(spark)).collect()), key=str)
    want = [(d, n, c, True if d is None else k) for d, n, c, k in brute(rows)]
    assert found == sorted(want, key=str)
    assert md.minhash_components(empty_documents(spark)).count() == 0


def test_pruning_bound_is_the_posterior():
    """The bound is where the Beta posterior, integrated numerically, falls below the chance."""
    x = np.linspace(0, 1, 200_001)
    for n in (32, 64, 128):
        m = md.fewest_equal(n)
        def posterior(k):
            density = x ** k * (1 - x) ** (n - k)
            return density[x >= 0.8].sum() / density.sum()
        assert posterior(m) >= md.MISS > posterior(m - 1)
    chance = sum(math.comb(128, k) * 0.8 ** k * 0.2 ** (128 - k) for k in range(md.fewest_equal(128)))
    assert chance < 1e-5  # a pair at the threshold is hardly ever pruned


def test_dealt_blocks_meet_across_components_once(spark, monkeypatch):
    monkeypatch.setattr(md, "BLOCK", 4)
    draw = random.Random(7)
    rows = [(part, part * 1000 + n, draw.choice([1, 1, 1, 1, 2, 3, 4, 50 + n])) for part in (1, 2) for n in range(40)]
    df = md.dealt(spark.createDataFrame(rows, "part long, rep long, comp long"))
    met = {}
    for r in df.collect():
        met.setdefault((r.part, r.i, r.j), []).append(r)
    count = {}
    for (_, i, j), members in met.items():
        for a in members:
            for b in members:
                if a.rep < b.rep and a.comp != b.comp and (i == j or a.block != b.block):
                    count[a.rep, b.rep] = count.get((a.rep, b.rep), 0) + 1
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] != b[2]}
    assert set(count) == want and set(count.values()) == {1}
