"""Nearest-neighbour evaluations (C5 numeric, C11 numeric + text blend)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grouprank.operators.basic import complete_rows, materialize, require_columns, text_available
from grouprank.operators.groups import group_counts, keep_groups, select_groups
from grouprank.operators.knn import (distance_column, first_hit_from_topk, first_hit_rank, hit_metrics, knn_topk,
                                     pair_join)
from grouprank.operators.sampling import sample_per_group, shuffle_tasks
from grouprank.operators.text import TERMS_PER_TASK, doc_terms, document_tasks, hashed_doc_terms, term_rows
from grouprank.operators.vectors import group_stats, l2_normalize, zscore
from grouprank.params import Params


def _run_ts(run_ts):
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def few_groups(p: Params, groups: DataFrame | None = None) -> bool:
    """Whether parameters bound the number of groups."""
    return groups is None and p.top_groups is not None and (p.group_mode == "top_n" or p.variety_groups is not None)


def chosen_groups(df: DataFrame, p: Params, min_rows: int, groups: DataFrame | None) -> DataFrame:
    """The given group table, or the chooser's groups."""
    if groups is not None:
        return groups.select(p.group).distinct()
    return select_groups(df, group=p.group, mode=p.group_mode, top=p.top_groups, variety=p.variety_groups,
                         min_rows=min_rows, seed=p.seed)


def eval_items(items: DataFrame, p: Params, groups: DataFrame | None = None) -> DataFrame:
    """Complete rows of the chosen groups (the input of the numeric evaluation).

    ``groups``: a stored group table to use instead of the chooser.
    """
    few = few_groups(p, groups)
    keys = [p.item, p.group, p.entity]
    df = complete_rows(require_columns(items, keys + p.features).select(*keys, *p.features),
                       keys + p.features)
    df = keep_groups(df, chosen_groups(df, p, p.min_rows, groups), p.group, few_groups=few)
    if p.n_queries is not None:  # gate: a group needs n_queries + 50 rows
        sizes = group_counts(df, p.group).filter(F.col("n") >= p.n_queries + 50)
        df = keep_groups(df, sizes, p.group, few_groups=few)
    return materialize(df, spread=True)


def audio_queries(items: DataFrame, p: Params, *, few: bool | None = None) -> DataFrame:
    return sample_per_group(items, p.group, p.n_queries, id_col=p.item, seed=p.seed, salt="query",
                            few_groups=few_groups(p) if few is None else few)


def audio_pairs(items: DataFrame, p: Params, scale: str = "none", queries: DataFrame | None = None, *,
                few: bool | None = None, carried: list[str] | None = None) -> DataFrame:
    """(query, candidate, distance) for every sampled query and every item of its group.

    ``queries`` (default: sampled from ``items``) carries the item columns, and those named in ``carried``; it is
    broadcast if parameters bound it (``few``, by default as ``p`` says). With
    ``scale="zscore"`` both sides use the same group statistics of ``items``.
    """
    few = few_groups(p) if few is None else few
    cols = list(p.features)
    if queries is None:
        queries = audio_queries(items, p, few=few)
    if scale == "zscore":
        stats = group_stats(items, p.group, cols)
        items = zscore(items, p.group, cols, stats=stats, few_groups=few)
        queries = zscore(queries, p.group, cols, stats=stats, few_groups=few)
        cols = [f"z_{c}" for c in cols]
    elif scale != "none":
        raise ValueError("scale must be 'none' or 'zscore'")
    pairs = pair_join(queries, items, group=p.group, id_col=p.item, entity=p.entity, cols=cols,
                      few_queries=few and p.n_queries is not None, carried=carried)
    return pairs.withColumn("dist", distance_column(cols))


def evaluate_audio(items: DataFrame, p: Params | None = None, *, scale: str = "none",
                   run_ts=None, groups: DataFrame | None = None) -> DataFrame:
    """Recall@K and MRR@K per chosen group, numeric features, Euclidean distance.

    Queries: ``n_queries`` per group in sample-key order. Candidates: every item
    of the group (no cap), the query itself excluded. ``groups``: a stored group table
    to use instead of the chooser.
    Columns: genre, n_queries, k, recall_at_k, mrr_at_k, run_ts.
    """
    p = p or Params()
    few = few_groups(p, groups)
    df = eval_items(items, p, groups)
    queries = materialize(audio_queries(df, p, few=few))
    pairs = audio_pairs(df, p, scale, queries=queries, few=few)

    def meet(best: DataFrame) -> DataFrame:
        known = queries.join(best.withColumnRenamed("qid", p.item), [p.group, p.item])
        return audio_pairs(df, p, scale, queries=known, few=few, carried=["_best", "_hit"])
    hits = first_hit_rank(pairs, p.k, score="dist", ascending=True, group=p.group,
                          few_queries=few and p.n_queries is not None, meet=meet)
    m = hit_metrics(queries.select(p.group, F.col(p.item).alias("qid")), hits, group=p.group)
    return m.select(p.group, "n_queries", F.lit(p.k).cast("int").alias("k"),
                    "recall_at_k", "mrr_at_k", _run_ts(run_ts).alias("run_ts"))


# --------------------------------------------------------------------------- text blend

def text_candidates(items: DataFrame, text: DataFrame, p: Params) -> DataFrame:
    """Complete items with text, of all groups. Key column: track_id.

    The group is compared after the join, which is on the item alone: texts that lie by item, as enriched ones do, stay
    where they are.
    """
    named = items.select(F.col(p.item).alias("track_id"), p.group, p.entity, *p.features)
    found = text.select(F.col("track_id").alias("_track"), F.col(p.group).alias("_group"), "lyrics", "lyrics_found")
    same_group = (F.col(p.group) <= F.col("_group")) & (F.col(p.group) >= F.col("_group"))
    df = named.join(found, (F.col("track_id") == F.col("_track")) & same_group).drop("_track", "_group")
    return complete_rows(text_available(df), p.features)


def text_eval_items(items: DataFrame, text: DataFrame, p: Params, groups: DataFrame | None = None) -> DataFrame:
    """Items with text of the chosen groups, plus n_tracks_in_genre. Key column: track_id."""
    g, few = p.group, few_groups(p, groups)
    df = text_candidates(items, text, p)
    df = keep_groups(df, chosen_groups(df, p, p.text_min_rows, groups), g, few_groups=few)
    sizes = group_counts(df, g, "n_tracks_in_genre").filter(F.col("n_tracks_in_genre") >= p.text_min_rows)
    return materialize(df.join(F.broadcast(sizes) if few else sizes, g), spread=True, dealt=few)


def text_queries(df: DataFrame, p: Params, *, few: bool | None = None) -> DataFrame:
    return sample_per_group(df, p.group, p.text_n_queries, id_col="track_id", seed=p.seed, salt="query",
                            few_groups=few_groups(p) if few is None else few)


#: A term is frequent when it has more than one in FREQUENT_SHARE of all (document, term) rows: so at most that many terms are.
FREQUENT_SHARE = 1_000_000


@dataclass(frozen=True)
class BlendInputs:
    """What both ways of scoring read, all written: documents with their terms, what is known of terms, and unit vectors."""

    docs: DataFrame       # group, track_id, entity, terms: array of (term, tf)
    by_document: Callable[..., DataFrame]   # (keys...) -> keys..., terms: counted again from the texts, which are smaller than terms to shuffle
    idf: DataFrame        # term, idf (above 0)
    asked: DataFrame      # group, term, n, n_asked: the queries' terms, with the documents and the queries that hold them
    lengths: DataFrame    # group, track_id, length, u_query, u_candidate (see shared_postings)
    numeric: DataFrame    # group, track_id, entity, u_z_<feature>...
    keys: DataFrame       # group, track_id of the queries
    unit: list[str]
    tasks: int


def blend_inputs(df: DataFrame, p: Params, *, tokens: str = "words", queries: DataFrame | None = None, few: bool) -> BlendInputs:
    """``df`` is counted: it should be a written table.

    Terms stay in their document's row wherever rows are shuffled: only sums by term and by document leave the tasks.
    """
    g, e = p.group, p.entity
    if queries is None:
        queries = materialize(text_queries(df, p, few=few))
    keys, bounded = queries.select(g, "track_id"), few and p.text_n_queries is not None
    doc, tasks, m = [g, "track_id", e], document_tasks(df), df.count()

    def by_document(*cols: str) -> DataFrame:
        keys = list(cols)
        return hashed_doc_terms(df, keys, "lyrics", p.hash_buckets) if tokens == "hashed" else doc_terms(df, keys, "lyrics", tokens, tasks)
    # texts need no shuffle where no document has several rows
    single = tokens != "hashed" and df.groupBy(*doc).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").isEmpty()
    docs = materialize(doc_terms(df, doc, "lyrics", tokens, single=True) if single else by_document(*doc))
    marks = keys.withColumn("mine", F.lit(1))
    rows = docs.join(F.broadcast(marks) if bounded else marks, [g, "track_id"], "left").withColumn("mine", F.coalesce("mine", F.lit(0)))
    rows = term_rows(rows, g, "track_id", "mine")
    count = F.count(F.lit(1))
    if bounded:  # counts by group are needed for the queries' terms only, and these are broadcast
        mine = materialize(rows.filter("mine = 1").groupBy(g, "term").agg(count.alias("n_asked")))
        counts = rows.join(F.broadcast(mine), [g, "term"]).groupBy(g, "term", "n_asked").agg(count.alias("n"))
        by_term = rows.groupBy("term").agg(count.alias("df"))
    else:
        counts = materialize(rows.groupBy(g, "term").agg(count.alias("n"), F.sum("mine").alias("n_asked")))
        by_term = counts.groupBy("term").agg(F.sum("n").alias("df"))
    known = materialize(by_term.select("term", "df", F.ln((F.lit(float(m)) + 1.0) / (F.col("df") + 1.0)).alias("idf")))
    idf = known.filter(F.col("idf") > 0).select("term", "idf")
    asked = materialize(counts.filter("n_asked > 0").join(idf.select("term"), "term", "left_semi").select(g, "term", "n", "n_asked"))

    # most rows are those of frequent terms, which are broadcast; the others meet their term in tasks that grow with them
    least = (known.agg(F.sum("df")).first()[0] or 0) / FREQUENT_SHARE
    frequent, rare = known.filter(F.col("df") > least), known.filter(F.col("df") <= least)
    dealt = shuffle_tasks(df, -(-(rare.agg(F.sum("df")).first()[0] or 0) // TERMS_PER_TASK))
    met = rows.join(F.broadcast(frequent.select("term", F.col("idf").alias("_idf"))), "term", "left")
    often = met.filter("_idf > 0").withColumnRenamed("_idf", "idf")
    others = (met.filter("_idf IS NULL").drop("_idf").repartition(dealt, "term")
              .join(rare.filter("idf > 0").select("term", "idf").repartition(dealt, "term"), "term"))
    few_asked = F.broadcast(asked) if bounded else asked

    def part(flag: Column) -> Column:
        return F.sum(F.when(flag, F.col("_w2")).otherwise(0.0))

    def sums(side: DataFrame) -> DataFrame:
        weighed = side.join(few_asked, [g, "term"], "left").withColumn("_w2", F.col("tf") * F.col("idf") * F.col("tf") * F.col("idf"))
        return weighed.groupBy(g, "track_id").agg(F.sum("_w2").alias("_all"), part((F.col("mine") > 0) & (F.col("n") > 1)).alias("_query"),
                                                  part(F.col("n_asked") > F.col("mine")).alias("_candidate"))
    both = sums(often).unionByName(sums(others)).groupBy(g, "track_id").agg(*[F.sum(c).alias(c) for c in ("_all", "_query", "_candidate")])
    lengths = materialize(both.select(g, "track_id", F.sqrt("_all").alias("length"), F.sqrt(F.col("_query") / F.col("_all")).alias("u_query"),
                                      F.sqrt(F.col("_candidate") / F.col("_all")).alias("u_candidate")))
    zcols = [f"z_{c}" for c in p.features]
    unit = [f"u_{c}" for c in zcols]
    scaled = l2_normalize(zscore(df.select(*doc, *p.features), g, p.features, stats=group_stats(df, g, p.features), few_groups=few), zcols)
    return BlendInputs(docs, by_document, idf, asked, lengths, materialize(scaled.select(*doc, *unit), spread=True), keys, unit, tasks)


def query_terms(x: BlendInputs, p: Params, *, few: bool) -> DataFrame:
    """(group, qid, q_entity, term, wq), written: the weight in a query's unit vector times the term's idf, so that a
    candidate's term frequency over its length makes it a product of weights."""
    g = p.group
    marks = x.keys.join(x.lengths, [g, "track_id"])
    docs = x.docs.join(F.broadcast(marks) if few and p.text_n_queries is not None else marks, [g, "track_id"])
    rows = term_rows(docs, g, "track_id", p.entity, "length").join(x.idf, "term")
    weight = F.col("tf") * F.col("idf") * F.col("idf") / F.col("length")
    return materialize(_as_query(rows.select(g, "track_id", p.entity, "term", weight.alias("wq")), p))


def _as_query(df: DataFrame, p: Params, **names: str) -> DataFrame:
    return df.withColumnsRenamed({"track_id": "qid", p.entity: "q_entity", **names})


def _as_candidate(df: DataFrame, p: Params, **names: str) -> DataFrame:
    return df.withColumnsRenamed({"track_id": "cid", p.entity: "c_entity", **names})


def _audio_cosine(unit: list[str]) -> Column:
    return reduce(lambda x, y: x + y, [F.col(f"q_{c}") * F.col(c) for c in unit])


def blended_pairs(df: DataFrame, p: Params, *, tokens: str = "words", queries: DataFrame | None = None,
                  few: bool | None = None) -> DataFrame:
    """Scored pairs: alpha * audio cosine (z-scored, unit) + (1 - alpha) * text TF-IDF cosine,
    for every sampled query and every other item of its group.

    A pair gets one row from the nine numeric columns (documents joined to the
    queries of their group) and one row per shared term (a document's terms joined to
    the queries' on group and term). Where parameters bound the queries (``few``),
    their rows are broadcast and both sides are dealt by candidate, over tasks that grow
    with the documents, so the sum per pair needs no shuffle of terms or pairs; otherwise
    Spark joins by size.
    ``tokens="hashed"``: hashed term frequencies. For the best candidates only, use ``blended_topk``.
    Columns: group, qid, cid, q_entity, c_entity, audio_cos, text_cos, score.
    """
    g = p.group
    few = few_groups(p) if few is None else few
    x = blend_inputs(df, p, tokens=tokens, queries=queries, few=few)

    def some(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if few and p.text_n_queries is not None else side
    q_text = some(query_terms(x, p, few=few))
    mine = materialize(x.numeric.join(x.keys, [g, "track_id"], "left_semi"))
    q_numeric = _as_query(some(mine), p, **{c: f"q_{c}" for c in x.unit})
    pair = [g, "cid", "qid", "q_entity", "c_entity"]
    by_text = term_rows(_as_candidate(x.by_document(g, "track_id", p.entity), p), g, "cid", "c_entity").join(q_text, [g, "term"])
    numeric = x.numeric.join(x.lengths.select(g, "track_id", "length"), [g, "track_id"], "left")
    by_number = _as_candidate(numeric, p).repartition(x.tasks, g, "cid", "c_entity").join(q_numeric, g)
    none = F.lit(0.0)
    rows = (by_text.select(*pair, none.alias("audio_cos"), (F.col("wq") * F.col("tf")).alias("_text"), none.alias("length"))
            .unionByName(by_number.select(*pair, _audio_cosine(x.unit).alias("audio_cos"), none.alias("_text"), F.coalesce("length", F.lit(1.0)).alias("length"))))
    # entities depend on the ids; as keys they keep the aggregate a hash aggregate. Every pair has a row with the length.
    sums = (rows.filter(F.col("qid") != F.col("cid")).groupBy(*pair)
            .agg(F.sum("audio_cos").alias("audio_cos"), (F.sum("_text") / F.max("length")).alias("text_cos")))
    return sums.select(g, "qid", "cid", "q_entity", "c_entity", "audio_cos", "text_cos",
                       (p.alpha * F.col("audio_cos") + (1.0 - p.alpha) * F.col("text_cos")).alias("score"))


#: Sums of products differ in their last digits with the order of their terms; bounds give way by this much.
SLACK = 1e-9


def shared_postings(x: BlendInputs, p: Params, *, few: bool) -> tuple[DataFrame, DataFrame]:
    """The queries' terms that meet another document's, and the length of what each document has of such terms.

    A query's weights count where another document of the group has the term, a candidate's where a query other than
    itself has it. By Cauchy and Schwarz the text cosine of a pair is at most ``u_query`` of the one times
    ``u_candidate`` of the other. Lengths: group, track_id, length, u_query, u_candidate.
    """
    shared = x.asked.filter("n > 1").select(p.group, "term")
    return query_terms(x, p, few=few).join(shared, [p.group, "term"], "left_semi"), x.lengths


def blended_survivors(x: BlendInputs, p: Params, lengths: DataFrame, k: int, *, few: bool) -> DataFrame:
    """The pairs whose blended score can be among the query's ``k`` best, by their numeric part and a bound on the text part.

    The text part is never negative, so the k-th best numeric part is a score that k candidates reach (``floor``, null
    with fewer candidates). A pair whose numeric part with the most that its text could add stays below it is dropped.
    Columns: group, qid, q_entity, cid, c_entity, length, audio_cos, floor.
    """
    g = p.group
    vectors = x.numeric.join(lengths, [g, "track_id"], "left").fillna(0.0, ["u_query", "u_candidate"]).fillna(1.0, ["length"])
    vectors = materialize(vectors, spread=True)
    q = materialize(vectors.drop("u_candidate", "length").join(x.keys, [g, "track_id"], "left_semi"))
    bounded = few and p.text_n_queries is not None
    q = _as_query(F.broadcast(q) if bounded else q, p, **{c: f"q_{c}" for c in x.unit})
    pairs = (_as_candidate(vectors.drop("u_query"), p).join(q, g).filter(F.col("qid") != F.col("cid"))
             .select(g, "qid", "q_entity", "cid", "c_entity", "length", _audio_cosine(x.unit).alias("audio_cos"),
                     F.least(F.lit(1.0), F.col("u_query") * F.col("u_candidate")).alias("_most")))
    nearest = knn_topk(pairs, k, score="audio_cos", ascending=False, group=g, group_sizes=group_counts(vectors, g), few_queries=bounded)
    floor = materialize(nearest.groupBy(g, "qid").agg(F.min("audio_cos").alias("floor"), F.count(F.lit(1)).alias("_have"))
                        .filter(F.col("_have") >= k).select(g, "qid", (p.alpha * F.col("floor") - SLACK).alias("floor")))
    best = p.alpha * F.col("audio_cos") + (1.0 - p.alpha) * F.col("_most")
    kept = pairs.join(F.broadcast(floor) if bounded else floor, [g, "qid"], "left").filter(F.col("floor").isNull() | (best >= F.col("floor")))
    return materialize(kept.drop("_most"), spread=True)


def blended_topk(df: DataFrame, p: Params, k: int, *, tokens: str = "words", queries: DataFrame | None = None,
                 few: bool | None = None) -> DataFrame:
    """The ``k`` best candidates of each query by the score of ``blended_pairs``, without scoring every pair's text.

    Exact: numeric parts and bounds on the text parts rule pairs out first (``blended_survivors``); only the others meet
    terms: whole texts are dealt to them by candidate, over tasks that grow with the documents, and their terms are
    joined to the query's; only scores that reach the query's floor are ranked.
    Columns: group, qid, q_entity, cid, c_entity, score, rank.
    """
    if not 0.0 <= p.alpha <= 1.0:
        raise ValueError("alpha must be between 0 and 1")
    g = p.group
    few = few_groups(p) if few is None else few
    x = blend_inputs(df, p, tokens=tokens, queries=queries, few=few)
    shared, lengths = shared_postings(x, p, few=few)
    survivors = blended_survivors(x, p, lengths, k, few=few)
    q_text = materialize(shared.select(g, "qid", "term", "wq"))
    q_text = F.broadcast(q_text) if few and p.text_n_queries is not None else q_text
    docs = x.by_document(g, "track_id").withColumnRenamed("track_id", "cid")
    # floor, length and entities depend on the ids; as keys they keep the aggregate a hash aggregate
    met = survivors.join(docs, [g, "cid"], "left").select(*survivors.columns, F.explode_outer("terms").alias("_t"))
    sums = (met.select(*survivors.columns, "_t.term", "_t.tf").join(q_text, [g, "qid", "term"], "left").groupBy(*survivors.columns)
            .agg(F.sum(F.coalesce(F.col("wq") * F.col("tf") / F.col("length"), F.lit(0.0))).alias("text_cos")))
    scored = sums.withColumn("score", p.alpha * F.col("audio_cos") + (1.0 - p.alpha) * F.col("text_cos"))
    reach = scored.filter(F.col("floor").isNull() | (F.col("score") >= F.col("floor")))
    return knn_topk(reach, k, score="score", ascending=False, group=g, bounded=False)


def evaluate_audio_text(items: DataFrame, text: DataFrame, p: Params | None = None, *,
                        run_ts=None, tokens: str = "words", groups: DataFrame | None = None) -> DataFrame:
    """Recall@K and MRR@K per group for the blended score (descending), ties by id.

    ``tokens="hashed"`` uses hashed term frequencies (``p.hash_buckets``); ``groups`` is a
    stored group table to use instead of the chooser.

    Columns: genre, n_tracks_in_genre, n_queries, k, alpha_audio_weight, recall_at_k, mrr_at_k, run_ts.
    """
    p = p or Params()
    g = p.group
    few = few_groups(p, groups)
    df = text_eval_items(items, text, p, groups)
    queries = materialize(text_queries(df, p, few=few))
    top = blended_topk(df, p, p.k, tokens=tokens, queries=queries, few=few)
    hits = first_hit_from_topk(top, group=g)
    m = hit_metrics(queries.select(g, F.col("track_id").alias("qid")), hits, group=g)
    sizes = df.select(g, "n_tracks_in_genre").distinct()
    return (m.join(sizes, g)
             .select(g, F.col("n_tracks_in_genre").cast("int").alias("n_tracks_in_genre"), "n_queries",
                     F.lit(p.k).cast("int").alias("k"), F.lit(float(p.alpha)).alias("alpha_audio_weight"),
                     "recall_at_k", "mrr_at_k", _run_ts(run_ts).alias("run_ts")))
