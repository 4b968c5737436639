import numpy as np

from grouprank.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, ids string"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r", "i") for i, v in vectors], SCHEMA)


def brute(vectors, k=5):
    ok = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, np.array(v, np.float32).astype(float))
    want = {}
    for q in ok:
        if q % 50 == 0:
            near = sorted((-round(float(ok[q] @ v / np.sqrt((ok[q] @ ok[q]) * (v @ v))), 12), i) for i, v in ok.items() if i != q)[:k]
            want[q] = [(n + 1, i) for n, (_, i) in enumerate(near)]
    return want


def got(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    return found


def test_small_tables_are_exact_with_copies_and_bad_rows(spark):
    draw = np.random.default_rng(1)
    vectors = [(i, draw.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(i, vectors[0][1]) for i in range(1000, 1400)]  # one vector very often, some of them queries
    vectors += [(350, None), (400, [0.0] * 8), (450, [None] * 8), (500, [float("nan")] * 8), (550, [float("inf")] + [1.0] * 7),
                (600, [1.0, 2.0]), (None, [1.0] * 8), vectors[50], vectors[50]]
    rows = nearest(table(spark, vectors)).collect()
    want = brute([v for v in vectors if v[1] is None or len(v[1]) == 8])
    assert got(rows) == want
    for r in rows[:50]:
        a, b = (np.array(dict(vectors)[r[c]], np.float32).astype(float) for c in ("query_id", "vec_id"))
        assert abs(r["score"] - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_ties_go_to_the_smaller_id(spark):
    """Scaled copies have a cosine of exactly one with each other, but are different vectors."""
    draw = np.random.default_rng(4)
    one = draw.standard_normal(8).astype(np.float32)
    vectors = [(i, (one * np.float32(2.0 ** (i % 60 - 30))).tolist()) for i in range(60)]
    vectors += [(i, draw.standard_normal(8).astype(np.float32).tolist()) for i in range(60, 400)]
    found = got(nearest(table(spark, vectors)).collect())
    assert found[0] == [(n + 1, i) for n, i in enumerate([1, 2, 3, 4, 5])]
    assert found[50] == [(n + 1, i) for n, i in enumerate([0, 1, 2, 3, 4])]


def test_few_rows(spark):
    assert nearest(table(spark, [])).collect() == []
    assert nearest(table(spark, [(0, [1.0, 0.0])])).collect() == []
    assert got(nearest(table(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])])).collect()) == {0: [(1, 2), (2, 1)]}


def test_recall(spark):
    from tests.conftest import SF01
    items = spark.read.parquet(SF01.replace("0.01", "0.1") + "/embeddings.parquet")
    found = got(nearest(items).collect())
    want = brute([(r["vec_id"], r["embedding"]) for r in items.collect()])
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(w) for w in want.values())
