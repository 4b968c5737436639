import random
from collections import Counter

import numpy as np

from grouprank.llm.components import components
from grouprank.llm.jaccard_join import jaccard_classes, labels, runs_needed
from grouprank.llm.shingles import shingle_hashes
from tests.llm.helpers import awkward_documents, empty_documents, prose


def brute(rows):
    shingles, first = shingle_hashes([t for _, t in rows])
    sets = [set(shingles[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
    linked = np.array([[i != j and rows[i][0] is not None and rows[j][0] is not None and bool(a | b) and len(a & b) >= 0.8 * len(a | b)
                        for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    label = np.arange(len(rows))
    ids = np.array([np.inf if d is None else d for d, _ in rows])
    for _ in range(len(rows)):
        for i in range(len(rows)):
            for j in np.flatnonzero(linked[i]):
                label[i] = label[j] = min(label[i], label[j])
    least = [min(ids[label == label[i]]) for i in range(len(rows))]
    return Counter((str(d), str(None if d is None else int(c)), int(n)) for (d, _), c, n in zip(rows, least, linked.sum(axis=1), strict=True))


def found(df):
    return Counter((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in df.collect())


def edited(seed, n, edits):
    draw, words = random.Random(seed * 7919 + edits), prose(seed, n).split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = draw.choice(["zebra", "quartz", "violin", "nectar"])
    return " ".join(words)


def test_equal_to_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, edited(i % 25, 60 + i % 25, draw.randint(0, 3))) for i in range(200)] + [(i + 500, prose(900 + i, 60)) for i in range(60)]
    assert found(jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_large_groups_and_common_lines(spark, monkeypatch):
    import grouprank.llm.jaccard_join as m
    monkeypatch.setattr(m, "NODE_SETS", 8)
    monkeypatch.setattr(m, "BLOCK", 16)
    line = prose(77, 12)
    rows = [(i, edited(1, 150, i % 4) + f" tail{i}") for i in range(90)]
    rows += [(1000 + i, f"{line} {prose(3000 + i, 30)}") for i in range(80)] + [(2000 + i, prose(5, 40)) for i in range(40)]
    assert found(jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    assert found(jaccard_classes(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert jaccard_classes(empty_documents(spark)).collect() == []


def test_runs():
    assert runs_needed(levels=1) <= runs_needed(levels=6) < 20
    lost = 1 - 0.8 * 0.75 - 0.25 * (1 - 0.2 ** 2)
    assert lost ** runs_needed(levels=1) <= 0.001


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 11), (5, 5), (20, 21), (21, 20)] + [(100 + i, 101 + i) for i in range(30)]
    rows = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert rows == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 11: 8, 20: 20, 21: 20, **{100 + i: 100 for i in range(31)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert labels(np.array([[0, 0, 1], [0, 0, 0], [1, 0, 0]], bool)).tolist() == [0, 1, 0]


def test_borderline_neighbours_of_settled_sets_are_linked_to_the_pivot():
    import pyarrow as pa

    import grouprank.llm.jaccard_join as m
    pivot = np.arange(m.MINHASHES, dtype="<u2")
    rows = [pivot + np.uint16(1000) * (np.arange(m.MINHASHES) >= n) for n in (104, 70)]  # settled; at about 0.55
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5, 5]), pa.array([1, 2]), pa.array([r.astype("<u2").tobytes() for r in rows], pa.binary()), pa.array([9, 9]),
         pa.array([pivot.tobytes()] * 2, pa.binary())], ["path", "rep", "sketch", "pivot", "pivot_sketch"])
    made = pa.Table.from_batches(m.node_splitter(iter([batch]))).to_pylist()
    assert {r["rep"] for r in made if r["pivot"] == 9} == {1, 2}
    assert 0 < m.LEVELS * m.settled_loss() < (1 - m.RECALL) / 2
