"""Text features: tokens, TF-IDF and sparse cosine.

Documents are rows keyed by ``doc_cols``. Vectors stay in long form
(doc..., term, weight) and are never densified. The exact vocabulary is the
default; ``tfidf_hashed`` gives the hashed 4096-bucket variant with Spark ML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grouprank.functions.columns import WHITESPACE
from grouprank.operators.basic import materialize
from grouprank.operators.sampling import shuffle_tasks

TOKEN_MODES = ("words", "ml")


def tokens(text: Column | str, mode: str = "words") -> Column:
    """Lower-cased whitespace tokens, punctuation kept.

    ``words`` splits on runs of whitespace (no empty tokens); ``ml`` splits on
    single whitespace characters like Spark ML's Tokenizer, so empty tokens appear
    for repeated or leading whitespace (trailing ones are dropped).
    """
    text = F.col(text) if isinstance(text, str) else text
    if mode == "words":
        return F.filter(F.split(F.lower(text), WHITESPACE + "+"), lambda t: t != "")
    if mode == "ml":
        parts = F.split(F.lower(text), WHITESPACE)
        # drop trailing empties only, as String.split does
        keep_upto = F.aggregate(F.transform(parts, lambda t, i: F.when(t != "", i + 1).otherwise(0)),
                                F.lit(0), lambda acc, v: F.greatest(acc, v))
        # an empty text is one empty token there
        return F.when(text == "", F.array(F.lit(""))).otherwise(F.slice(parts, 1, keep_upto))
    raise ValueError(f"token mode must be one of {TOKEN_MODES}")


#: Documents of a task, and term rows of one, where rows are dealt by document; the number of tasks grows with the rows.
DOCS_PER_TASK = 2_000
TERMS_PER_TASK = 500_000


def document_tasks(df: DataFrame) -> int:
    """Tasks for the documents of ``df``, which is counted (it should be a written table); as many as a shuffle has at least."""
    return shuffle_tasks(df, -(-df.count() // DOCS_PER_TASK))


def doc_terms(df: DataFrame, doc_cols: list[str], text_col: str, mode: str = "words", tasks: int | None = None, *,
              single: bool = False) -> DataFrame:
    """(doc..., terms): an array of (term, tf) in order of the terms, one row per document.

    Whole texts are brought together by document; their tokens are sorted and counted within the row, so no row per token
    or term is shuffled or held. Documents of several rows have the tokens of all. ``tasks``: over how many tasks the
    documents are dealt (by default as Spark shuffles). ``single`` says that no document has several rows: texts stay where they are.
    """
    some = df.select(*doc_cols, F.col(text_col).alias("_text"))
    if single:
        texts = some.select(*doc_cols, F.array_compact(F.array("_text")).alias("_texts"))
    else:
        texts = (some.repartition(tasks, *doc_cols) if tasks else some).groupBy(*doc_cols).agg(F.collect_list("_text").alias("_texts"))
    words = texts.select(*doc_cols, F.sort_array(F.flatten(F.transform("_texts", lambda t: tokens(t, mode)))).alias("_w"))
    every = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1)).otherwise(F.array().cast("array<int>"))
    first = words.withColumn("_at", F.filter(every, lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1))))
    counted = F.transform("_at", lambda i, k: F.struct(
        F.get("_w", i).alias("term"), (F.coalesce(F.get("_at", k + 1), F.size("_w")) - i).cast("long").alias("tf")))
    return first.select(*doc_cols, counted.alias("terms"))


def term_rows(docs: DataFrame, *cols: str) -> DataFrame:
    """(cols..., term, tf): a row for each term of ``doc_terms``."""
    # an outer explode: for a plain one Spark repeats the whole array's expression in a filter
    rows = docs.select(*cols, F.explode_outer("terms").alias("_t")).select(*cols, "_t.term", "_t.tf")
    return rows.filter(F.col("term").isNotNull())


def term_counts(df: DataFrame, doc_cols: list[str], text_col: str, mode: str = "words", tasks: int | None = None) -> DataFrame:
    """(doc..., term, tf): raw term frequency per document."""
    return term_rows(doc_terms(df, doc_cols, text_col, mode, tasks), *doc_cols)


# The constants of 32-bit Murmur3, and the seed that HashingTF takes.
MURMUR_SEED = 42
MURMUR_BLOCK = (0xCC9E2D51, 0x1B873593)
MURMUR_END = (0x85EBCA6B, 0xC2B2AE35)
_MASK = 0xFFFFFFFF


def _times(col: Column, factor: int) -> Column:
    """The low 32 bits of a product of 32-bit numbers, without a product past 64 bits."""
    high = ((col * (factor >> 16)).bitwiseAND(0xFFFF)) * (1 << 16)
    return (col * (factor & 0xFFFF) + high).bitwiseAND(_MASK)


def _folded(col: Column, shift: int) -> Column:
    return col.bitwiseXOR(F.shiftright(col, shift))


def with_ml_bucket(df: DataFrame, term: str, num_features: int, name: str) -> DataFrame:
    """Add ``name``: the bucket that Spark ML's HashingTF gives the text in ``term``.

    HashingTF takes Murmur3 with the last one to three bytes as one block; the SQL function ``hash`` agrees with it on
    whole blocks of four bytes only. So the blocks go through ``hash``, whose last mixing is undone, and the rest is
    added here. A column for each step keeps the expression from growing.
    """
    inverse = [pow(c, -1, 1 << 32) for c in MURMUR_END]
    data, h = F.encode(F.col(term), "UTF-8"), F.col("_h")
    out = df.withColumn("_n", F.octet_length(F.col(term)).cast("long")).withColumn("_r", F.col("_n") % 4)
    whole = F.substr(data, F.lit(1), (F.col("_n") - F.col("_r")).cast("int"))
    out = out.withColumn("_h", F.hash(whole).cast("long").bitwiseAND(_MASK))
    rest = F.hex(F.substr(data, (F.col("_n") - F.col("_r") + 1).cast("int"), F.col("_r").cast("int")))
    byte = [F.when(F.col("_r") > k, F.conv(F.substring(rest, 2 * k + 1, 2), 16, 10).cast("long") * (1 << 8 * k)).otherwise(0) for k in range(3)]
    out = out.withColumn("_k", _times(byte[0] + byte[1] + byte[2], MURMUR_BLOCK[0]))
    out = out.withColumn("_k", _times((F.col("_k") * (1 << 15)).bitwiseAND(_MASK).bitwiseOR(F.shiftright("_k", 17)), MURMUR_BLOCK[1]))
    out = out.withColumn("_h", _folded(h, 16)).withColumn("_h", _times(h, inverse[1]))
    out = out.withColumn("_h", _folded(h, 13).bitwiseXOR(F.shiftright(h, 26))).withColumn("_h", _times(h, inverse[0]))
    out = out.withColumn("_h", _folded(h, 16).bitwiseXOR(F.col("_n") - F.col("_r")).bitwiseXOR(F.col("_k")).bitwiseXOR(F.col("_n")))
    out = out.withColumn("_h", _folded(h, 16)).withColumn("_h", _times(h, MURMUR_END[0]))
    out = out.withColumn("_h", _folded(h, 13)).withColumn("_h", _times(h, MURMUR_END[1])).withColumn("_h", _folded(h, 16))
    signed = h - F.when(h >= 1 << 31, 1 << 32).otherwise(0)
    return out.withColumn(name, F.pmod(signed, F.lit(num_features)).cast("int")).drop("_n", "_r", "_h", "_k")


def hashed_term_counts(df: DataFrame, doc_cols: list[str], text_col: str, num_features: int = 4096) -> DataFrame:
    """(doc..., term, tf) where a term is a bucket of ``num_features``: the buckets and counts of Spark ML's HashingTF.

    ``df`` is counted (a written table): documents are dealt once, over tasks that grow with them, and stay there.
    """
    counts = with_ml_bucket(term_counts(df, doc_cols, text_col, "ml", document_tasks(df)), "term", num_features, "_bucket")
    return counts.groupBy(*doc_cols, F.col("_bucket").cast("string").alias("term")).agg(F.sum("tf").alias("tf"))


def hashed_doc_terms(df: DataFrame, doc_cols: list[str], text_col: str, num_features: int = 4096) -> DataFrame:
    """``hashed_term_counts`` in the form of ``doc_terms``."""
    counts = hashed_term_counts(df, doc_cols, text_col, num_features)
    return counts.groupBy(*doc_cols).agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("terms"))


def idf_table(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln((m + 1) / (df + 1)), m = rows of ``docs``.

    ``tf`` has one row per (doc, term). Document frequency is a per-term count, a
    hash aggregate with map-side combine, so frequent terms do not skew it.
    """
    m = docs.count()
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return dfreq.select("term", "df", F.ln((F.lit(float(m)) + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(df: DataFrame, doc_cols: list[str], text_col: str, mode: str = "words") -> DataFrame:
    """(doc..., term, tf, df, idf, weight) with idf = ln((m + 1) / (df + 1)), m = documents.

    ``df`` is counted: it should be a written table.
    """
    docs = materialize(doc_terms(df, doc_cols, text_col, mode, document_tasks(df)))
    tf = term_rows(docs, *doc_cols)
    # written, so that Spark knows whether it is small enough to be broadcast
    idf = materialize(idf_table(tf, df))
    return (tf.join(idf, "term")
              .withColumn("weight", F.col("tf") * F.col("idf"))
              .select(*doc_cols, "term", "tf", "df", "idf", "weight"))


def term_weights(df: DataFrame, doc_cols: list[str], text_col: str, mode: str = "words") -> DataFrame:
    """(doc..., term, w): TF-IDF weights scaled to unit L2 norm per document.

    Terms with idf 0 (in every document) are dropped; they add nothing to
    norms or dot products. Lengths are summed where a document's terms lie, and joined to whole documents.
    ``df`` is counted: it should be a written table.
    """
    tasks = document_tasks(df)
    docs = materialize(doc_terms(df, doc_cols, text_col, mode, tasks))
    idf = materialize(idf_table(term_rows(docs, *doc_cols), df)).filter(F.col("idf") > 0).select("term", "idf")
    weight = F.col("tf") * F.col("idf")
    lengths = term_rows(docs, *doc_cols).join(idf, "term").groupBy(*doc_cols).agg(F.sqrt(F.sum(weight * weight)).alias("_length"))
    lengths = materialize(lengths).withColumnsRenamed({c: f"_r_{c}" for c in doc_cols})
    dealt = docs.repartition(tasks, *doc_cols)
    whole = dealt.join(lengths, [dealt[c].eqNullSafe(F.col(f"_r_{c}")) for c in doc_cols])
    return term_rows(whole, *doc_cols, "_length").join(idf, "term").select(*doc_cols, "term", (weight / F.col("_length")).alias("w"))


#: A term is split when it has more postings than one in SPLIT_SHARE of all, and than SPLIT_ROWS: so at most SPLIT_SHARE
#: terms are, and no task gets more than such a share of a term's postings.
SPLIT_SHARE = 1000
SPLIT_ROWS = 100_000
#: Sums of products differ in their last digits with the order of their terms; bounds give way by this much.
SLACK = 1e-9


def postings_join(queries: DataFrame, candidates: DataFrame, *, group: str = "genre") -> DataFrame:
    """Rows of ``queries`` (group, qid, term, ...) with the ``candidates`` rows (group, cid, term, ...) of the same term.

    The candidates of a frequent term are dealt over sub-keys by their id, and the query rows of that term copied to each,
    so a term that half of all documents have fills no task. ``candidates`` is counted: it should be a written table.
    """
    share = max(candidates.count() / SPLIT_SHARE, SPLIT_ROWS)
    frequent = (candidates.groupBy(group, "term").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > share)
                .select(group, "term", F.ceil(F.col("_n") / share).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    # at most SPLIT_SHARE rows, whatever the data
    c = candidates.join(F.broadcast(frequent), [group, "term"], "left").withColumn("_part", F.pmod(F.xxhash64("cid"), parts).cast("int"))
    q = queries.join(F.broadcast(frequent), [group, "term"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return q.drop("_parts").join(c.drop("_parts"), [group, "term", "_part"]).drop("_part").filter(F.col("qid") != F.col("cid"))


def text_cosine(query_weights: DataFrame, cand_weights: DataFrame, *, group: str = "genre",
                id_col: str = "track_id", min_cosine: float | None = None, few_queries: bool = False) -> DataFrame:
    """Cosine of unit TF-IDF vectors for (query, candidate) pairs of a group sharing a term.

    An inverted-index equi-join on (group, term), frequent terms split, summed per pair. Pairs that
    share no term are absent (their cosine is 0). With ``min_cosine`` (above 0) only pairs that reach it are
    returned, and others are ruled out by bounds before they are summed (``likely_pairs``).
    ``cand_weights`` should be a written table. ``few_queries`` says that parameters bound the queries: their rows are
    broadcast and candidates are dealt by id over tasks that grow with them, so no row per pair is shuffled.
    """
    q = query_weights.select(group, F.col(id_col).alias("qid"), "term", F.col("w").alias("wq"))
    c = cand_weights.select(group, F.col(id_col).alias("cid"), "term", F.col("w").alias("wc"))
    if min_cosine is not None:
        return _reaching(q, c, group, min_cosine, few_queries)
    return _met(q, c, group, few_queries).groupBy(group, "qid", "cid").agg(F.sum(F.col("wq") * F.col("wc")).alias("text_cos"))


def _of_terms(c: DataFrame, terms: DataFrame, group: str) -> DataFrame:
    """The rows of ``c`` with a (group, term) of ``terms``, whose queries parameters bound."""
    return c.join(F.broadcast(terms.select(group, "term")), [group, "term"], "left_semi")


def _by_candidate(c: DataFrame, terms: DataFrame, group: str) -> DataFrame:
    """The rows of ``c`` with a term of ``terms``, dealt by candidate: rows of other terms aren't shuffled."""
    return _of_terms(c, terms, group).repartition(shuffle_tasks(c, -(-c.count() // TERMS_PER_TASK)), group, "cid")


def _met(q: DataFrame, c: DataFrame, group: str, few_queries: bool) -> DataFrame:
    """The rows of ``postings_join``; with few queries they lie by candidate."""
    if not few_queries:
        return postings_join(q, c, group=group)
    return _by_candidate(c, q, group).join(F.broadcast(q), [group, "term"]).filter(F.col("qid") != F.col("cid"))


def bounded_terms(q: DataFrame, c: DataFrame, group: str, least: float, few_queries: bool = False) -> DataFrame:
    """The queries' terms with what each and all of lesser weight can add to a cosine: group, qid, term, wq, reach, lead.

    Terms are taken in order of their largest weight among the candidates. ``reach`` is the lesser of the sum of products
    with those weights and, by Cauchy and Schwarz, the length of the query's part. A pair that shares no ``lead`` term
    (one whose reach is at least ``least``) stays below ``least``.
    """
    largest = (_of_terms(c, q, group) if few_queries else c).groupBy(group, "term").agg(F.max("wc").alias("_most"))
    up_to = Window.partitionBy(group, "qid").orderBy("_most", "term").rowsBetween(Window.unboundedPreceding, 0)
    rows = q.join(largest, [group, "term"])
    reach = F.least(F.sum(F.col("wq") * F.col("_most")).over(up_to), F.sqrt(F.sum(F.col("wq") * F.col("wq")).over(up_to)))
    return rows.withColumn("reach", reach).select(group, "qid", "term", "wq", "reach", (F.col("reach") >= least - SLACK).alias("lead"))


def likely_pairs(terms: DataFrame, c: DataFrame, group: str, least: float, few_queries: bool = False) -> DataFrame:
    """(group, qid, cid, part): pairs that share a lead term, with the sum over those, where the other terms could make up the rest."""
    rest = terms.filter(~F.col("lead")).groupBy(group, "qid").agg(F.max("reach").alias("_rest"))
    lead = terms.filter("lead").select(group, "qid", "term", "wq")
    found = _met(lead, c, group, few_queries).groupBy(group, "qid", "cid").agg(F.sum(F.col("wq") * F.col("wc")).alias("part"))
    found = found.join(F.broadcast(rest) if few_queries else rest, [group, "qid"], "left")
    return found.filter(F.col("part") + F.coalesce("_rest", F.lit(0.0)) >= least - SLACK).drop("_rest")


def _reaching(q: DataFrame, c: DataFrame, group: str, least: float, few_queries: bool) -> DataFrame:
    if least <= 0:
        raise ValueError("min_cosine must be above 0")
    terms = materialize(bounded_terms(q, c, group, least, few_queries))
    pairs = materialize(likely_pairs(terms, c, group, least, few_queries))
    others = terms.filter(~F.col("lead")).select(group, "qid", "term", "wq")
    more = F.sum(F.coalesce(F.col("wq") * F.col("wc"), F.lit(0.0)))
    if few_queries:  # a pair's candidate comes with its terms, one at least: no row per pair and term is shuffled
        rows = _by_candidate(c, terms, group).join(pairs, [group, "cid"]).join(F.broadcast(others), [group, "qid", "term"], "left")
    else:
        rows = pairs.join(others, [group, "qid"], "left").join(c, [group, "cid", "term"], "left")
    whole = rows.groupBy(group, "qid", "cid", "part").agg(more.alias("_more"))
    return whole.select(group, "qid", "cid", (F.col("part") + F.col("_more")).alias("text_cos")).filter(F.col("text_cos") >= least)


def tfidf_hashed(df: DataFrame, text_col: str, num_features: int = 4096,
                 out: str = "lyr_vec", keep: list[str] | None = None) -> DataFrame:
    """Spark ML Tokenizer -> HashingTF -> IDF, as a sparse vector column ``out``.

    Frequencies are written with the ``keep`` columns (by default all of ``df``), so texts are tokenised once.
    """
    from pyspark.ml.feature import IDF, HashingTF, Tokenizer

    words = Tokenizer(inputCol=text_col, outputCol="_words").transform(df)
    tf = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features).transform(words)
    tf = materialize(tf.select(*(df.columns if keep is None else keep), "_tf"))
    return IDF(inputCol="_tf", outputCol=out).fit(tf).transform(tf).drop("_tf")
