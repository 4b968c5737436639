"""Postings joins: frequent terms split, bounds that lose no pair, against plain dot products."""

import random

import pytest
from pyspark.sql import functions as F

from grouprank.operators import text
from grouprank.operators.basic import materialize


def weights(seed, docs, words, most):
    """Unit vectors of a few words; some words are in many documents."""
    draw, rows = random.Random(seed), []
    for n in range(docs):
        terms = {f"t{min(int(draw.expovariate(4 / words)), words)}" for _ in range(draw.randrange(1, most))}
        w = {t: draw.random() for t in terms}
        length = sum(v * v for v in w.values()) ** 0.5
        rows += [(f"g{n % 2}", f"d{n:04d}", t, v / length) for t, v in w.items()]
    return rows


def plain(rows, queries):
    docs = {}
    for g, d, t, w in rows:
        docs.setdefault((g, d), {})[t] = w
    out = {}
    for (g, q), x in docs.items():
        if q in queries:
            for (h, c), y in docs.items():
                if g == h and q != c and x.keys() & y.keys():
                    out[g, q, c] = sum(w * y[t] for t, w in x.items() if t in y)
    return out


def frames(spark, rows):
    c = materialize(spark.createDataFrame(rows, "genre string, track_id string, term string, w double"))
    return c.filter(F.col("track_id").endswith("7")), c


@pytest.mark.parametrize("split", [100_000, 5])
@pytest.mark.parametrize("least", [None, 0.05, 0.4, 0.9])
def test_cosines_equal_plain_products(spark, monkeypatch, split, least):
    monkeypatch.setattr(text, "SPLIT_ROWS", split)
    rows = weights(2, 200, 40, 12)
    q, c = frames(spark, rows)
    got = {(r.genre, r.qid, r.cid): r.text_cos for r in text.text_cosine(q, c, min_cosine=least).collect()}
    want = {k: v for k, v in plain(rows, {r[1] for r in rows if r[1].endswith("7")}).items() if least is None or v >= least}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_bounds_leave_few_pairs(spark):
    """Common words of little weight and rare ones of much: only pairs that share a rare word are summed."""
    draw, rows = random.Random(3), []
    for n in range(400):
        w = {f"common{k}": 0.1 + 0.1 * draw.random() for k in draw.sample(range(20), 10)}
        w |= {f"rare{draw.randrange(600)}": 0.5 + draw.random() for _ in range(4)}
        length = sum(v * v for v in w.values()) ** 0.5
        rows += [("g", f"d{n:04d}", t, v / length) for t, v in w.items()]
    q, c = frames(spark, rows)
    names = [x.withColumnsRenamed(n) for x, n in ((q, {"track_id": "qid", "w": "wq"}), (c, {"track_id": "cid", "w": "wc"}))]
    every = text.text_cosine(q, c).count()
    likely = text.likely_pairs(text.bounded_terms(*names, "genre", 0.4), names[1], "genre", 0.4).count()
    reached = text.text_cosine(q, c, min_cosine=0.4).count()
    assert 0 < reached <= likely < 0.05 * every


def test_a_term_in_half_of_all_documents_spreads(spark, monkeypatch):
    """Without adaptive execution, which could split a skewed join by itself."""
    monkeypatch.setattr(text, "SPLIT_ROWS", 300)
    rows = spark.range(8000).select(F.lit("g").alias("genre"), F.concat(F.lit("d"), F.col("id")).alias("cid"),
                                    F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 900)).alias("term"), F.lit(1.0).alias("wc"))
    c = materialize(rows)
    q = c.filter(F.col("cid").isin("d0", "d2", "d3")).select("genre", F.col("cid").alias("qid"), "term", F.col("wc").alias("wq"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        tasks = [r["count"] for r in text.postings_join(q, c).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(tasks) == 2 * 3999 + 8 and max(tasks) < 0.35 * sum(tasks) and len(tasks) > 5


def test_least_must_be_positive(spark):
    q, c = frames(spark, weights(1, 5, 5, 3))
    with pytest.raises(ValueError):
        text.text_cosine(q, c, min_cosine=0.0)


def test_terms_are_counted_without_rows_of_terms_in_a_shuffle(spark):
    """Repeated, null and empty documents; the only exchange carries whole texts."""
    rows = [("g", "a", "x y x"), ("g", "a", "y z"), ("g", None, "n n"), (None, "a", "x"), ("g", "b", ""), ("g", "c", None), ("h", "a", " X  \u00c4 ")]
    df = spark.createDataFrame(rows, "genre string, track_id string, lyrics string")
    got = text.term_counts(df, ["genre", "track_id"], "lyrics")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("g", "a", "x", 2), ("g", "a", "y", 2), ("g", "a", "z", 1), ("g", None, "n", 2), (None, "a", "x", 1), ("h", "a", "x", 1), ("h", "a", "\u00e4", 1)], key=str)
    assert not [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x and "term" in x]


@pytest.mark.parametrize("least", [None, 0.2])
def test_few_queries_need_no_shuffle_of_pairs(spark, least):
    rows = weights(5, 150, 40, 12)
    q, c = frames(spark, rows)
    got = text.text_cosine(materialize(q), c, min_cosine=least, few_queries=True)
    want = {k: v for k, v in plain(rows, {r[1] for r in rows if r[1].endswith("7")}).items() if least is None or v >= least}
    found = {(r.genre, r.qid, r.cid): r.text_cos for r in got.collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - v) < 1e-9 for k, v in want.items())
    exchanges = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert exchanges and not [x for x in exchanges if "term" in x or "qid" in x]


def test_lengths_are_the_same_for_frequent_and_rare_terms(spark, monkeypatch):
    import math
    from collections import Counter

    from grouprank.params import Params
    from grouprank.plans import evaluate
    p = Params(features=["tempo"], text_n_queries=2)
    texts = [f"every a{i % 2} b{i % 5} b{i % 5} own{i}" for i in range(20)]
    df = materialize(spark.createDataFrame([("g", str(i), f"e{i % 4}", float(i), t) for i, t in enumerate(texts)],
                                           "genre string, track_id string, artist_id_primary string, tempo double, lyrics string"))
    asked = materialize(df.filter("track_id IN ('3', '4')"))
    count = Counter(w for t in texts for w in set(t.split()))
    want = [math.sqrt(sum((n * math.log(21 / (count[w] + 1))) ** 2 for w, n in Counter(t.split()).items())) for t in texts]
    found = []
    for share in (1, 20, 10_000):  # no term is frequent, some are, all are
        monkeypatch.setattr(evaluate, "FREQUENT_SHARE", share)
        rows = evaluate.blend_inputs(df, p, queries=asked, few=True).lengths.collect()
        rows = sorted(rows, key=lambda r: int(r["track_id"]))
        assert [round(r["length"], 9) for r in rows] == [round(x, 9) for x in want]
        found.append([(round(r["u_query"], 9), round(r["u_candidate"], 9)) for r in rows])
    assert found[0] == found[1] == found[2]


def test_documents_of_one_row_are_counted_where_they_lie(spark):
    from grouprank.operators.text import doc_terms, term_rows
    from grouprank.params import Params
    from grouprank.plans import evaluate
    rows = [("g" if i % 2 else "h", str(i // 2), "e", float(i), f"every a{i % 3} a{i % 3} own{i}" if i % 5 else None) for i in range(20)]
    df = materialize(spark.createDataFrame(rows, "genre string, track_id string, artist_id_primary string, tempo double, lyrics string"))
    doc = ["genre", "track_id"]
    single = doc_terms(df, doc, "lyrics", single=True)
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, doc_terms(df, doc, "lyrics").collect()))

    p = Params(features=["tempo"], text_n_queries=2)
    asked = materialize(df.filter("track_id IN ('3', '4')"))
    twice = materialize(df.unionByName(df.filter("track_id = '6'").withColumn("lyrics", F.lit("every second row"))))
    for few in (True, False):
        plain, grouped = (evaluate.blend_inputs(x, p, queries=asked, few=few) for x in (df, twice))
        terms = {(r.genre, r.track_id, r.term): r.tf for r in term_rows(grouped.docs, *doc).collect()}
        assert terms["g", "6", "every"] == 2 and terms["g", "6", "second"] == 1
        by_group = {(r.genre, r.term): (r.n, r.n_asked) for r in plain.asked.collect()}
        # rows 1, 7, 13 and 19 of g hold a1, rows 2, 8 and 14 of h hold a2; the queries are rows 6 to 9
        assert by_group["g", "a1"] == (4, 1) and by_group["h", "a2"] == (3, 1) and ("g", "own1") not in by_group


def test_only_rows_of_the_queries_terms_are_dealt(spark):
    """Rows that share no term with a query aren't shuffled, and pairs without any further term keep their sum."""
    rows = [("g0", f"d{n:04d}", f"own{n}", 0.6) for n in range(300)] + [("g0", f"d{n:04d}", "both", 0.8) for n in range(10)]
    q, c = frames(spark, rows)
    names = q.select("genre", F.col("track_id").alias("qid"), "term", F.col("w").alias("wq")), c.select("genre", F.col("track_id").alias("cid"), "term", F.col("w").alias("wc"))
    query = names[0].filter("qid = 'd0007'")
    assert text._by_candidate(names[1], query, "genre").count() == 10 + 1
    found = text.text_cosine(q.filter("track_id = 'd0007'"), c, min_cosine=0.5, few_queries=True).collect()
    assert sorted((r.qid, r.cid, round(r.text_cos, 9)) for r in found) == [("d0007", f"d{n:04d}", 0.64) for n in range(10) if n != 7]
