"""The evaluations against a direct re-enactment of the per-query ranking loop
(sort candidates, skip the query itself, stop at the first same-entity hit or at K),
run in NumPy on the same items and query sample (sf0.001)."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from grouprank.operators.basic import materialize
from grouprank.plans import queries as Q
from grouprank.plans.evaluate import audio_queries, eval_items, text_eval_items, text_queries
from grouprank.plans.curate import enrich_with_text
from tests.conftest import SF001, small_params



def loop_metrics(ids, ents, qids, score_fn, k, descending):
    hits, rr = 0, 0.0
    pos = {i: n for n, i in enumerate(ids)}
    for q in qids:
        s = score_fn(pos[q])
        keys = (-s if descending else s)
        order = sorted(range(len(ids)), key=lambda j: (keys[j], ids[j]))
        rank = 0
        for j in order:
            if ids[j] == q:
                continue
            rank += 1
            if ents[j] == ents[pos[q]]:
                hits += 1
                rr += 1.0 / rank
                break
            if rank >= k:
                break
    return hits / len(qids), rr / len(qids)


def test_numeric_eval_matches_loop(spark):
    p = small_params()
    items = eval_items(Q.curated(spark, SF001), p)
    queries = materialize(audio_queries(items, p))
    from grouprank.plans.evaluate import evaluate_audio
    got = {r.genre: (r.recall_at_k, r.mrr_at_k) for r in evaluate_audio(Q.curated(spark, SF001), p).collect()}
    rows = items.collect()
    qrows = defaultdict(list)
    for r in queries.collect():
        qrows[r.genre].append(r.id)
    assert got
    for g, (rec, mrr) in got.items():
        grp = [r for r in rows if r.genre == g]
        ids = [r.id for r in grp]
        ents = [r.artist_id_primary for r in grp]
        mat = np.array([[float(r[f]) for f in p.features] for r in grp])
        want = loop_metrics(ids, ents, qrows[g], lambda i: np.sqrt(((mat - mat[i]) ** 2).sum(axis=1)), p.k, False)
        assert rec == pytest.approx(want[0], abs=1e-12)
        assert mrr == pytest.approx(want[1], abs=1e-12)


def test_blended_eval_matches_loop(spark):
    import re
    p = small_params()
    cur = Q.curated(spark, SF001)
    text = enrich_with_text(cur, Q.text_records(spark, SF001))
    items = text_eval_items(cur, text, p)
    queries = text_queries(items, p)
    from grouprank.plans.evaluate import evaluate_audio_text
    got = {r.genre: (r.recall_at_k, r.mrr_at_k, r.n_tracks_in_genre)
           for r in evaluate_audio_text(cur, text, p).collect()}
    rows = items.collect()
    qrows = defaultdict(list)
    for r in queries.collect():
        qrows[r.genre].append(r.track_id)
    # idf over every selected row (all groups together)
    docs = [[t for t in re.split(r"[ \t\n\x0b\f\r]+", r.lyrics.lower()) if t] for r in rows]
    df = Counter(t for d in docs for t in set(d))
    m = len(rows)
    idf = {t: math.log((m + 1) / (c + 1)) for t, c in df.items()}
    vecs = []
    for d in docs:
        w = {t: c * idf[t] for t, c in Counter(d).items() if idf[t] > 0}
        n = math.sqrt(sum(v * v for v in w.values())) or 1.0
        vecs.append({t: v / n for t, v in w.items()})
    assert got
    for g, (rec, mrr, n_rows) in got.items():
        idx = [i for i, r in enumerate(rows) if r.genre == g]
        assert n_rows == len(idx)
        ids = [rows[i].track_id for i in idx]
        ents = [rows[i].artist_id_primary for i in idx]
        a = np.array([[float(rows[i][f]) for f in p.features] for i in idx])
        sd = a.std(axis=0)
        sd[sd == 0] = 1.0
        z = (a - a.mean(axis=0)) / sd
        nz = np.linalg.norm(z, axis=1, keepdims=True)
        nz[nz == 0] = 1.0
        u = z / nz
        tv = [vecs[i] for i in idx]

        def score(qi):
            audio = u @ u[qi]
            text = np.array([sum(w * tv[qi].get(t, 0.0) for t, w in v.items()) for v in tv])
            return p.alpha * audio + (1.0 - p.alpha) * text
        want = loop_metrics(ids, ents, qrows[g], score, p.k, True)
        assert rec == pytest.approx(want[0], abs=1e-12)
        assert mrr == pytest.approx(want[1], abs=1e-12)
