"""Independent SQL (DuckDB dialect) for each registered query, at the sf0.01 parameters.

The SQL is written from the operator definitions, not from the Spark plans:
plain windows (row_number, running sums) where the Spark side uses
distributed equivalents (hash-histogram sampling, aggregate-based first-hit ranks,
range-partitioned prefix sums). Fixture CTEs are the statements in FIXTURES.md.
"""

from __future__ import annotations

from grouprank.params import CURATED_COLUMNS, FEATURES

Q = "chr(39)"   # a single quote, spelled the same in both engines

FX_ARTISTS = f"""fx_artists AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         CASE WHEN c_custkey % 10 = 0 THEN '[]'
              WHEN c_custkey % 10 = 1 THEN '[' || {Q} || c_mktsegment || ' ' || {Q} || ']'
              WHEN c_custkey % 10 = 2 THEN CAST(NULL AS VARCHAR)
              ELSE '[' || {Q} || c_mktsegment || {Q} || ', ' || {Q} || n_name || {Q} || ']' END AS genres
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

FX_TRACKS = f"""fx_tracks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS name,
         CAST(o_orderkey % 100 AS INTEGER) AS popularity,
         CASE WHEN o_orderkey % 20 = 0 THEN '[' || {Q} || CAST(o_custkey AS VARCHAR) || {Q} || ', ' || {Q} || 'x' || {Q} || ']'
              WHEN o_orderkey % 20 = 1 THEN '[]'
              ELSE '[' || {Q} || CAST(o_custkey AS VARCHAR) || {Q} || ']' END AS id_artists,
         CASE WHEN o_orderkey % 50 = 2 THEN '99' WHEN o_orderkey % 50 = 3 THEN 'abcd'
              WHEN o_orderkey % 50 = 4 THEN substr(CAST(o_orderdate AS VARCHAR), 1, 4)
              ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 10) END AS release_date,
         mn_q AS danceability, mx_q AS energy, mn_d AS loudness, mx_d AS speechiness, mn_t AS acousticness,
         mx_t AS instrumentalness, mn_p AS liveness, mx_p AS valence, o_totalprice AS tempo
  FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_quantity) AS mn_q, max(l_quantity) AS mx_q, min(l_discount) AS mn_d,
           max(l_discount) AS mx_d, min(l_tax) AS mn_t, max(l_tax) AS mx_t,
           min(l_extendedprice) AS mn_p, max(l_extendedprice) AS mx_p
    FROM lineitem GROUP BY l_orderkey) agg ON o_orderkey = l_orderkey)"""

FX_RESPONSES = """fx_responses AS (
  SELECT CAST(doc_id AS VARCHAR) AS track_id,
         CASE WHEN doc_id % 7 = 0 THEN '[]'
              WHEN doc_id % 7 = 1 THEN '[{"plainLyrics":"","syncedLyrics":' || CAST(to_json(text) AS VARCHAR) || '},{"plainLyrics":"second"}]'
              WHEN doc_id % 7 = 2 THEN 'not json'
              WHEN doc_id % 7 = 3 THEN '{"plainLyrics":' || CAST(to_json(text) AS VARCHAR) || '}'
              ELSE '[{"plainLyrics":' || CAST(to_json(text) AS VARCHAR) || ',"syncedLyrics":null}]' END AS response_json
  FROM documents)"""

FX_LYRICS = """fx_lyrics AS (
  SELECT CAST(doc_id AS VARCHAR) AS track_id, lang AS genre,
         CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS VARCHAR) ELSE text END AS lyrics,
         doc_id % 7 <> 0 AS lyrics_found
  FROM documents)"""

FX_VEC = """fx_vec_items AS (
  SELECT vec_id AS id, 'g' || CAST(vec_id % 4 AS VARCHAR) AS genre, label AS artist_id_primary, embedding
  FROM embeddings)"""

PARSED = f"trim(replace(regexp_replace(CAST(genres AS VARCHAR), '^\\[|\\]$', '', 'g'), {Q}, ''))"
SINGLE_ID = f"'^\\[' || {Q} || '([^' || {Q} || ']+)' || {Q} || '\\]'"
FIRST_ID = f"'^\\[' || {Q} || '([^' || {Q} || ']+)' || {Q}"

F = FEATURES
FCOLS = ", ".join(F)


def _cols(prefix: str = "", alias_prefix: str | None = None) -> str:
    if alias_prefix is None:
        return ", ".join(f"{prefix}{c}" for c in F)
    return ", ".join(f"{prefix}{c} AS {alias_prefix}{c}" for c in F)


def _not_null(cols, prefix: str = "") -> str:
    return " AND ".join(f"{prefix}{c} IS NOT NULL" for c in cols)


ENT = f"""ent AS (
  SELECT id AS artist_id_primary, name AS artist_name_primary,
         CASE WHEN length({PARSED}) = 0 THEN CAST([] AS VARCHAR[])
              ELSE regexp_split_to_array({PARSED}, '\\s*,\\s*') END AS artist_genres
  FROM fx_artists)"""

ENT_RAW = f"""ent_raw AS (
  SELECT id, name, genres,
         CASE WHEN length({PARSED}) = 0 THEN CAST([] AS VARCHAR[])
              ELSE regexp_split_to_array({PARSED}, '\\s*,\\s*') END AS artist_genres
  FROM fx_artists)"""

ENT_G = """ent_g AS (
  SELECT DISTINCT artist_id_primary, artist_name_primary, genre FROM (
    SELECT artist_id_primary, artist_name_primary, lower(trim(g)) AS genre
    FROM (SELECT artist_id_primary, artist_name_primary, unnest(artist_genres) AS g FROM ent))
  WHERE genre IS NOT NULL AND genre <> '')"""

CURATED_SELECT = f"""t.id, t.name, t.popularity, t.id_artists, e.artist_id_primary, e.artist_name_primary, t.release_date,
         CASE WHEN length(t.release_date) >= 4 THEN TRY_CAST(substr(t.release_date, 1, 4) AS INTEGER) END AS release_year,
         {_cols('t.')}, e.genre"""

CURATED = f"""cur_j AS (
  SELECT {CURATED_SELECT}
  FROM (SELECT *, regexp_extract(id_artists, {SINGLE_ID}, 1) AS artist_id_primary FROM fx_tracks) t
  JOIN ent_g e ON t.artist_id_primary = e.artist_id_primary),
curated AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id, genre ORDER BY name NULLS FIRST, popularity NULLS FIRST,
                                 id_artists NULLS FIRST, artist_id_primary NULLS FIRST) AS rn
    FROM cur_j) WHERE rn = 1)"""

TEXT_RECORDS = """text_records AS (
  SELECT track_id, lower(trim(genre)) AS genre, lyrics, CAST(lyrics_found AS BOOLEAN) AS lyrics_found FROM fx_lyrics)"""

ENRICHED = """enriched AS (
  SELECT c.id AS track_id, c.artist_id_primary, c.artist_name_primary, l.lyrics, l.lyrics_found,
         lower(trim(c.genre)) AS genre
  FROM curated c JOIN (
    SELECT track_id, lyrics, lyrics_found FROM (
      SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY lyrics_found DESC NULLS LAST,
                                   lyrics ASC NULLS LAST) AS rn FROM text_records) WHERE rn = 1) l
  ON c.id = l.track_id)"""

LOOKUP_ROWS = """lookup_rows AS (
  SELECT id AS track_id, name AS track_name, artist_name_primary, genre FROM curated)"""

PICK = ("CASE WHEN json_valid(response_json) THEN coalesce("
        "nullif(json_extract_string(response_json, '$[0].plainLyrics'), ''), "
        "nullif(json_extract_string(response_json, '$[0].syncedLyrics'), '')) END")

def _strip(c: str) -> str:
    """Without white space at either end."""
    return f"coalesce(regexp_replace({c}, '^[\\s\\v]+|[\\s\\v]+$', '', 'g'), '')"


RESOLVED = f"""clean_in AS (
  SELECT {_strip('track_id')} AS track_id, {_strip('track_name')} AS track_name,
         {_strip('artist_name_primary')} AS artist_name_primary, lower({_strip('genre')}) AS genre
  FROM lookup_rows),
valid_in AS (
  SELECT * FROM clean_in WHERE track_id <> '' AND track_name <> '' AND artist_name_primary <> '' AND genre <> ''),
resp AS (
  SELECT track_id, lyrics FROM (
    SELECT track_id, lyrics, row_number() OVER (PARTITION BY track_id ORDER BY lyrics ASC NULLS LAST) AS rn
    FROM (SELECT track_id, {PICK} AS lyrics FROM fx_responses)) WHERE rn = 1),
resolved AS (
  SELECT v.track_id, v.track_name, v.artist_name_primary, v.genre, r.lyrics, r.lyrics IS NOT NULL AS lyrics_found
  FROM valid_in v LEFT JOIN resp r ON v.track_id = r.track_id)"""

BASE = ",\n".join([FX_ARTISTS, FX_TRACKS, ENT, ENT_G, CURATED])
WITH_TEXT = ",\n".join([BASE, FX_LYRICS, TEXT_RECORDS, ENRICHED])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _sample(src: str, part: str, salt: str, idcol: str, n: int, extra_order: str = "") -> str:
    order = f"md5(concat_ws(':', '42', '{salt}', CAST({idcol} AS VARCHAR))), {idcol}{extra_order}"
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn "
            f"FROM {src}) WHERE rn <= {n}")


def _chosen(src: str, min_rows: int, top: int) -> str:
    return (f"SELECT genre FROM (SELECT genre, count(*) AS n FROM {src} WHERE genre IS NOT NULL GROUP BY genre "
            f"HAVING count(*) >= {min_rows}) ORDER BY n DESC, genre ASC LIMIT {top}")


# ---------------------------------------------------------------- numeric evaluation

def audio_ctes(min_rows=500, top=10, n_q=150, k=10, zscore=False, groups=None) -> str:
    def value(side: str, c: str) -> str:
        return f"({side}.{c} - s.mu_{c}) / s.sd_{c}" if zscore else f"{side}.{c}"
    dist = " + ".join(f"({value('q', c)} - {value('c', c)}) * ({value('q', c)} - {value('c', c)})" for c in F)
    stats = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN CAST(1 AS DOUBLE) "
                      f"ELSE stddev_pop({c}) END AS sd_{c}" for c in F)
    return f"""cc AS (
  SELECT id, genre, artist_id_primary, {FCOLS} FROM curated
  WHERE {_not_null(['id', 'genre', 'artist_id_primary'] + F)}),
chosen AS ({groups or _chosen('cc', min_rows, top)}),
ei AS (
  SELECT * FROM cc WHERE genre IN (SELECT genre FROM chosen)
    AND genre IN (SELECT genre FROM cc GROUP BY genre HAVING count(*) >= {n_q + 50})),
aq AS ({_sample('ei', 'genre', 'query', 'id', n_q)}),
apairs AS (
  SELECT q.genre, q.id AS qid, q.artist_id_primary AS q_entity, c.id AS cid, c.artist_id_primary AS c_entity,
         sqrt({dist}) AS dist
  FROM aq q JOIN ei c ON q.genre = c.genre AND q.id <> c.id
    JOIN (SELECT genre, {stats} FROM ei GROUP BY genre) s ON q.genre = s.genre),
aranked AS (
  SELECT *, row_number() OVER (PARTITION BY genre, qid ORDER BY dist, cid) AS rk FROM apairs),
afh AS (
  SELECT genre, qid, min(rk) AS first_hit_rank FROM aranked
  WHERE q_entity = c_entity AND rk <= {k} GROUP BY genre, qid),
ea AS (
  SELECT q.genre, CAST(count(*) AS INTEGER) AS n_queries, CAST({k} AS INTEGER) AS k,
         avg(CASE WHEN f.first_hit_rank IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS recall_at_k,
         avg(CASE WHEN f.first_hit_rank IS NOT NULL THEN CAST(1 AS DOUBLE) / f.first_hit_rank ELSE CAST(0 AS DOUBLE) END) AS mrr_at_k
  FROM aq q LEFT JOIN afh f ON q.genre = f.genre AND q.id = f.qid
  GROUP BY q.genre)"""


# ---------------------------------------------------------------- text blend evaluation

def hashed_ctes(src: str, buckets: int = 4096) -> str:
    """mtf (track_id, genre, term, tf): tokens by single white space characters, terms by buckets of 32-bit Murmur3 with seed 42.

    Bytes are read as hexadecimal text: blocks of four as little-endian numbers, the last one to three as one block.
    """
    ws, M = r"'[ \t\n\x0B\f\r]'", "4294967295"

    def mixed(k: str) -> str:
        return (f"list_transform(list_transform(list_transform({k}, lambda k: (k * 3432918353) & {M}), "
                f"lambda k: ((k << 15) | (k >> 17)) & {M}), lambda k: (k * 461845907) & {M})")

    def little(first: str, n: int) -> str:
        return "CAST('0x' || " + " || ".join(f"substr(x, {first} + {2 * b}, 2)" for b in reversed(range(n))) + " AS UBIGINT)"
    rest = " ".join(f"WHEN {r} THEN {little('2 * n - ' + str(2 * r - 1), r)}" for r in (1, 2, 3))
    return f"""mparts AS (SELECT track_id, genre, lyrics, string_split_regex(lower(lyrics), {ws}) AS parts FROM {src}),
mtok AS (
  SELECT track_id, genre, unnest(CASE WHEN lyrics = '' THEN [''] ELSE list_slice(parts, 1, list_max(list_transform(range(1, len(parts) + 1),
    lambda i: CASE WHEN parts[i] <> '' THEN i ELSE 0 END))) END) AS token FROM mparts),
mhex AS (SELECT token, hex(encode(token)) AS x, octet_length(encode(token)) AS n FROM (SELECT DISTINCT token FROM mtok)),
mblocks AS (
  SELECT token, n, list_transform(range(0, n // 4), lambda i: {little('8 * i + 1', 4)}) AS body,
         [CASE n % 4 {rest} ELSE CAST(0 AS UBIGINT) END] AS tail FROM mhex),
mbody AS (
  SELECT token, CAST(n AS UBIGINT) AS n, {mixed('tail')}[1] AS tail,
         list_reduce(list_concat([CAST(42 AS UBIGINT)], {mixed('body')}),
                     lambda h, k: ((((xor(h, k) << 13) | (xor(h, k) >> 19)) & {M}) * 5 + 3864292196) & {M}) AS h FROM mblocks),
m0 AS (SELECT token, xor(xor(h, tail), n) AS h FROM mbody),
m1 AS (SELECT token, (xor(h, h >> 16) * 2246822507) & {M} AS h FROM m0),
m2 AS (SELECT token, (xor(h, h >> 13) * 3266489909) & {M} AS h FROM m1),
mbucket AS (SELECT token, CAST(xor(h, h >> 16) % {buckets} AS VARCHAR) AS term FROM m2),
mtf AS (
  SELECT t.track_id, t.genre, b.term, count(*) AS tf FROM mtok t JOIN mbucket b ON t.token = b.token
  GROUP BY t.track_id, t.genre, b.term)"""


def text_ctes(min_rows=30, top=10, n_q=100, k=10, alpha=0.8, hashed=False) -> str:
    counted = hashed_ctes("ti") + ",\nttf AS (SELECT * FROM mtf)" if hashed else None
    stats = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN CAST(1 AS DOUBLE) "
                      f"ELSE stddev_pop({c}) END AS sd_{c}" for c in F)
    zcols = ", ".join(f"(ti.{c} - s.mu_{c}) / s.sd_{c} AS z_{c}" for c in F)
    nrm = " + ".join(f"z_{c} * z_{c}" for c in F)
    ucols = ", ".join(f"z_{c} / (CASE WHEN nrm = 0 THEN CAST(1 AS DOUBLE) ELSE nrm END) AS u_z_{c}" for c in F)
    acos = " + ".join(f"q.u_z_{c} * c.u_z_{c}" for c in F)
    ws = r"'[ \t\n\x0B\f\r]+'"
    plain = f"""ttok AS (
  SELECT track_id, genre, unnest(string_split_regex(lower(lyrics), {ws})) AS term FROM ti),
ttf AS (SELECT track_id, genre, term, count(*) AS tf FROM ttok WHERE term <> '' GROUP BY track_id, genre, term)"""
    return f"""ti0 AS (
  SELECT c.id AS track_id, c.genre, c.artist_id_primary, {_cols('c.')}, e.lyrics, e.lyrics_found
  FROM curated c JOIN enriched e ON c.id = e.track_id AND c.genre = e.genre
  WHERE e.lyrics_found = true AND e.lyrics IS NOT NULL AND {_not_null(F, 'c.')}),
tchosen AS ({_chosen('ti0', min_rows, top)}),
ti AS (
  SELECT t.*, s.n_tracks_in_genre FROM ti0 t JOIN (
    SELECT genre, count(*) AS n_tracks_in_genre FROM ti0 WHERE genre IN (SELECT genre FROM tchosen)
    GROUP BY genre HAVING count(*) >= {min_rows}) s ON t.genre = s.genre),
zstats AS (SELECT genre, {stats} FROM ti GROUP BY genre),
zt AS (SELECT ti.track_id, ti.genre, ti.artist_id_primary, {zcols} FROM ti JOIN zstats s ON ti.genre = s.genre),
ut AS (SELECT track_id, genre, artist_id_primary, {ucols} FROM (SELECT *, sqrt({nrm}) AS nrm FROM zt)),
tq AS ({_sample('ti', 'genre', 'query', 'track_id', n_q)}),
tpairs_a AS (
  SELECT q.genre, q.track_id AS qid, c.track_id AS cid, q.artist_id_primary AS q_entity,
         c.artist_id_primary AS c_entity, {acos} AS audio_cos
  FROM ut q JOIN ut c ON q.genre = c.genre AND q.track_id <> c.track_id
  WHERE (q.track_id, q.genre) IN (SELECT track_id, genre FROM tq)),
{counted or plain},
tdf AS (SELECT term, count(*) AS df FROM ttf GROUP BY term),
tidf AS (
  SELECT term, df, ln((CAST((SELECT count(*) FROM ti) AS DOUBLE) + 1) / (CAST(df AS DOUBLE) + 1)) AS idf FROM tdf),
tfidf AS (
  SELECT f.track_id, f.genre, f.term, f.tf, i.df, i.idf, f.tf * i.idf AS weight
  FROM ttf f JOIN tidf i ON f.term = i.term),
tw AS (
  SELECT track_id, genre, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY track_id, genre)) AS w
  FROM tfidf WHERE idf > 0),
tcos AS (
  SELECT qw.genre, qw.track_id AS qid, cw.track_id AS cid, sum(qw.w * cw.w) AS text_cos
  FROM tw qw JOIN tw cw ON qw.genre = cw.genre AND qw.term = cw.term AND qw.track_id <> cw.track_id
  WHERE (qw.track_id, qw.genre) IN (SELECT track_id, genre FROM tq)
  GROUP BY qw.genre, qw.track_id, cw.track_id),
tscored AS (
  SELECT a.genre, a.qid, a.cid, a.q_entity, a.c_entity, a.audio_cos, coalesce(t.text_cos, CAST(0 AS DOUBLE)) AS text_cos,
         CAST({alpha} AS DOUBLE) * a.audio_cos
           + (CAST(1 AS DOUBLE) - CAST({alpha} AS DOUBLE)) * coalesce(t.text_cos, CAST(0 AS DOUBLE)) AS score
  FROM tpairs_a a LEFT JOIN tcos t ON a.genre = t.genre AND a.qid = t.qid AND a.cid = t.cid),
tranked AS (
  SELECT *, row_number() OVER (PARTITION BY genre, qid ORDER BY score DESC, cid ASC) AS rk FROM tscored),
tfh AS (
  SELECT genre, qid, min(rk) AS first_hit_rank FROM tranked
  WHERE q_entity = c_entity AND rk <= {k} GROUP BY genre, qid),
et AS (
  SELECT q.genre, CAST(max(q.n_tracks_in_genre) AS INTEGER) AS n_tracks_in_genre,
         CAST(count(*) AS INTEGER) AS n_queries, CAST({k} AS INTEGER) AS k, CAST({alpha} AS DOUBLE) AS alpha_audio_weight,
         avg(CASE WHEN f.first_hit_rank IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS recall_at_k,
         avg(CASE WHEN f.first_hit_rank IS NOT NULL THEN CAST(1 AS DOUBLE) / f.first_hit_rank ELSE CAST(0 AS DOUBLE) END) AS mrr_at_k
  FROM tq q LEFT JOIN tfh f ON q.genre = f.genre AND q.track_id = f.qid
  GROUP BY q.genre)"""


# ---------------------------------------------------------------- feature importance

def importance_ctes(min_rows=500, top=10, min_items=50, min_entities=5) -> str:
    return f"""fcc AS (
  SELECT id, genre, artist_id_primary, {FCOLS} FROM curated
  WHERE {_not_null(['id', 'genre', 'artist_id_primary'] + F)}),
fchosen AS ({_chosen('fcc', min_rows, top)}),
fitems AS (SELECT * FROM fcc WHERE genre IN (SELECT genre FROM fchosen)),
fent AS (SELECT genre, artist_id_primary, count(*) AS n_a FROM fitems GROUP BY genre, artist_id_primary),
fg AS (
  SELECT genre, count(*) AS k FROM fent GROUP BY genre
  HAVING sum(n_a) >= {min_items} AND count(*) >= {min_entities} AND sum(CASE WHEN n_a >= 2 THEN 1 ELSE 0 END) >= 1),
flong AS (
  SELECT u.genre, u.artist_id_primary AS a, u.feature, CAST(u.x AS DOUBLE) AS x, CAST(1 AS DOUBLE) / e.n_a AS w
  FROM (UNPIVOT (SELECT genre, artist_id_primary, {FCOLS} FROM fitems) ON {FCOLS} INTO NAME feature VALUE x) u
  JOIN fent e ON u.genre = e.genre AND u.artist_id_primary = e.artist_id_primary
  WHERE u.genre IN (SELECT genre FROM fg)),
fvals AS (SELECT genre, feature, x, sum(w) AS sw FROM flong GROUP BY genre, feature, x),
ftw AS (
  SELECT *, coalesce(sum(sw) OVER (PARTITION BY genre, feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wl,
         sum(sw) OVER (PARTITION BY genre, feature) AS wt
  FROM fvals),
ft AS (SELECT genre, feature, sum(x * sw * (wl - (wt - wl - sw))) AS t FROM ftw GROUP BY genre, feature),
fva AS (SELECT genre, feature, a, x, count(*) AS c FROM flong GROUP BY genre, feature, a, x),
fta AS (
  SELECT *, coalesce(sum(c) OVER (PARTITION BY genre, feature, a ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
         sum(c) OVER (PARTITION BY genre, feature, a) AS na
  FROM fva),
fd AS (
  SELECT genre, feature, a, max(na) AS na, sum(x * c * (l - (na - l - c))) AS d FROM fta GROUP BY genre, feature, a),
fagg AS (
  SELECT genre, feature, sum(d / (CAST(na AS DOUBLE) * na)) AS i,
         avg(CASE WHEN na >= 2 THEN 2 * d / (CAST(na AS DOUBLE) * (na - 1)) END) AS pos
  FROM fd GROUP BY genre, feature),
fraw AS (
  SELECT a.genre, a.feature, 2 * (t.t - a.i) / (CAST(g.k AS DOUBLE) * (g.k - 1)) - a.pos AS importance_raw
  FROM fagg a JOIN ft t ON a.genre = t.genre AND a.feature = t.feature JOIN fg g ON a.genre = g.genre),
fi AS (
  SELECT genre, feature, importance_raw, abs(importance_raw) AS importance_abs,
         importance_raw / (CASE WHEN sum(abs(importance_raw)) OVER (PARTITION BY genre) = 0 THEN CAST(1 AS DOUBLE)
                                ELSE sum(abs(importance_raw)) OVER (PARTITION BY genre) END) AS importance_norm
  FROM fraw)"""


def sampled_importance_ctes(draws=30_000, min_items=50, min_entities=5) -> str:
    """Draws by number; entities and items numbered by plain windows. Needs importance_ctes before it."""
    def u(salt: str, part: int) -> str:
        return f"CAST(('0x' || substr(md5(concat_ws(':', '42', '{salt}', genre, CAST(draw AS VARCHAR))), {8 * part + 1}, 8)) AS BIGINT)"
    cells = " UNION ALL ".join(f"SELECT genre, same, '{c}' AS feature, CAST(abs(one.{c} - two.{c}) AS DOUBLE) AS d FROM sdraw" for c in F)
    return f"""sent AS (
  SELECT genre, artist_id_primary AS a, n_a, row_number() OVER (PARTITION BY genre ORDER BY artist_id_primary) - 1 AS e FROM fent),
sgate AS (SELECT genre, count(*) AS k FROM fent GROUP BY genre HAVING sum(n_a) >= {min_items} AND count(*) >= {min_entities}),
sitem AS (SELECT *, row_number() OVER (PARTITION BY genre, artist_id_primary ORDER BY id) - 1 AS i FROM fitems),
snum AS (
  SELECT genre, draw, k, {", ".join(f"{u(salt, part)} AS u{n}" for n, (salt, part) in enumerate([("pair", 0), ("pair", 1), ("pair", 2), ("item", 0), ("item", 1)]))}
  FROM sgate CROSS JOIN (SELECT unnest(range({draws})) AS draw)),
spick AS (
  SELECT *, u0 < 2147483648 AS same, (u1 * k) >> 32 AS e1, (u2 * (k - 1)) >> 32 AS o FROM snum),
sboth AS (
  SELECT p.*, a.a AS a1, a.n_a AS n1, b.a AS a2, b.n_a AS n2
  FROM (SELECT *, CASE WHEN same THEN e1 WHEN o >= e1 THEN o + 1 ELSE o END AS e2 FROM spick) p
  JOIN sent a ON a.genre = p.genre AND a.e = p.e1 JOIN sent b ON b.genre = p.genre AND b.e = p.e2
  WHERE NOT (same AND a.n_a < 2)),
sidx AS (
  SELECT *, (u3 * n1) >> 32 AS i1, CASE WHEN same THEN (u4 * (n2 - 1)) >> 32 ELSE (u4 * n2) >> 32 END AS j FROM sboth),
sdraw AS (
  SELECT x.genre, x.same, one, two
  FROM (SELECT *, CASE WHEN same AND j >= i1 THEN j + 1 ELSE j END AS i2 FROM sidx) x
  JOIN sitem one ON one.genre = x.genre AND one.artist_id_primary = x.a1 AND one.i = x.i1
  JOIN sitem two ON two.genre = x.genre AND two.artist_id_primary = x.a2 AND two.i = x.i2),
scell AS ({cells}),
sstat AS (
  SELECT genre, feature, avg(d) FILTER (NOT same) - avg(d) FILTER (same) AS importance_raw,
         sqrt(var_samp(d) FILTER (same) / count(*) FILTER (same) + var_samp(d) FILTER (NOT same) / count(*) FILTER (NOT same)) AS std_error,
         count(*) FILTER (same) AS n_same, count(*) FILTER (NOT same) AS n_different
  FROM scell GROUP BY genre, feature HAVING count(*) FILTER (same) > 0 AND count(*) FILTER (NOT same) > 0),
sraw AS (
  SELECT *, CASE WHEN sum(abs(importance_raw)) OVER (PARTITION BY genre) = 0 THEN CAST(1 AS DOUBLE)
                 ELSE sum(abs(importance_raw)) OVER (PARTITION BY genre) END AS total FROM sstat)"""


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


def _per_query(src: str, value: str, places: int = 6) -> str:
    return (f"SELECT genre, qid, count(*) AS pairs, round(sum({value}), {places}) AS total, round(min({value}), 6) AS least, "
            f"round(max({value}), 6) AS most FROM {src} GROUP BY genre, qid")


def _eval_select(src: str) -> str:
    return f"SELECT genre, n_queries, k, {_r('recall_at_k', 'recall_at_k')}, {_r('mrr_at_k', 'mrr_at_k')} FROM {src}"


def _delta_select(join: str) -> str:
    has = "a.genre IS NOT NULL"
    return f"""SELECT CAST(CASE WHEN {has} THEN 1 ELSE 0 END AS INTEGER) AS baseline_available,
       round(a.recall_at_k, 6) AS recall_audio, round(al.recall_at_k, 6) AS recall_audio_lyrics,
       round(CASE WHEN {has} THEN al.recall_at_k - a.recall_at_k END, 6) AS delta_recall,
       round(a.mrr_at_k, 6) AS mrr_audio, round(al.mrr_at_k, 6) AS mrr_audio_lyrics,
       round(CASE WHEN {has} THEN al.mrr_at_k - a.mrr_at_k END, 6) AS delta_mrr,
       round(al.alpha_audio_weight, 6) AS alpha_audio_weight, al.n_queries, al.n_tracks_in_genre, al.genre
FROM et al {join} ea a ON a.genre = al.genre"""


def _vec_ctes(min_rows=100, top=10, n_q=50, k=10) -> str:
    dist = ("sqrt(list_reduce(list_transform(range(1, len(q.embedding) + 1), lambda i: "
            "(CAST(q.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE)) * "
            "(CAST(q.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE))), lambda x, y: x + y))")
    return f"""vi0 AS (SELECT * FROM fx_vec_items WHERE id IS NOT NULL AND genre IS NOT NULL
                AND artist_id_primary IS NOT NULL AND embedding IS NOT NULL),
vch AS ({_chosen('vi0', min_rows, top)}),
vi AS (SELECT * FROM vi0 WHERE genre IN (SELECT genre FROM vch)
       AND genre IN (SELECT genre FROM vi0 GROUP BY genre HAVING count(*) >= {n_q + 50})),
vq AS ({_sample('vi', 'genre', 'query', 'id', n_q)}),
vpairs AS (SELECT q.genre, q.id AS qid, c.id AS cid, q.artist_id_primary AS q_entity, c.artist_id_primary AS c_entity,
                  {dist} AS dist
           FROM vq q JOIN vi c ON q.genre = c.genre AND q.id <> c.id),
vranked AS (SELECT *, row_number() OVER (PARTITION BY genre, qid ORDER BY dist, cid) AS rk FROM vpairs),
vfh AS (SELECT genre, qid, min(rk) AS first_hit_rank FROM vranked WHERE q_entity = c_entity AND rk <= {k} GROUP BY genre, qid),
ev AS (
  SELECT q.genre, CAST(count(*) AS INTEGER) AS n_queries, CAST({k} AS INTEGER) AS k,
         avg(CASE WHEN f.first_hit_rank IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS recall_at_k,
         avg(CASE WHEN f.first_hit_rank IS NOT NULL THEN CAST(1 AS DOUBLE) / f.first_hit_rank ELSE CAST(0 AS DOUBLE) END) AS mrr_at_k
  FROM vq q LEFT JOIN vfh f ON q.genre = f.genre AND q.id = f.qid GROUP BY q.genre)"""


def _variety_ctes() -> str:
    """Top groups and further ones in sample order, with the reason."""
    return """gc AS (SELECT genre, count(*) AS n_tracks FROM curated WHERE genre IS NOT NULL GROUP BY genre),
tg AS (SELECT genre, n_tracks, 'top_n' AS reason FROM gc ORDER BY n_tracks DESC, genre LIMIT 5),
vg AS (SELECT genre, n_tracks, 'variety' AS reason FROM gc
       WHERE genre NOT IN (SELECT genre FROM tg) AND n_tracks >= 300
       ORDER BY md5(concat_ws(':', '42', 'group', genre)), genre, n_tracks LIMIT 5)"""


def _portable_rounding(sql: str) -> str:
    """round(x, 6) -> round(x * 1e6) / 1e6 + 0.0 (the same steps as the Spark side; no -0.0)."""
    out, i, pat = [], 0, "round("
    while True:
        j = sql.find(pat, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(pat)])
            i = j + len(pat)
            continue
        depth, k = 1, j + len(pat)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(pat):k - 1]
        expr, _, places = inner.rpartition(",")
        scale = f"CAST({10 ** int(places.strip())} AS DOUBLE)"
        out.append(sql[i:j])
        out.append(f"(round(({_portable_rounding(expr)}) * {scale}) / {scale} + CAST(0 AS DOUBLE))")
        i = k


_QUALITY = (
    "SELECT genre, count(*) AS tracks_in_curated, "
    "CAST(sum(CASE WHEN lyrics IS NOT NULL AND length(lyrics) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tracks_with_lyrics "
    "FROM enriched GROUP BY genre")

_LOOKED_UP = (
    "SELECT track_id, track_name, artist_name_primary, genre FROM ("
    "SELECT id AS track_id, name AS track_name, artist_name_primary, genre, row_number() OVER ("
    "PARTITION BY genre ORDER BY md5(concat_ws(':', '42', 'lookup', id)), id) AS rn FROM curated "
    f"WHERE genre IN ({_chosen('curated', 1000, 20)})) WHERE rn <= 40")


def oracle_sql() -> dict[str, str]:
    return {k: _portable_rounding(v) for k, v in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    A = audio_ctes()
    T = text_ctes()
    I = importance_ctes()
    curated_cols = ("id, name, popularity, id_artists, artist_id_primary, artist_name_primary, release_date, "
                    f"release_year, {FCOLS}, genre")
    s: dict[str, str] = {}

    # scans, sources, sinks
    s["scan_table"] = "SELECT * FROM documents"
    s["csv_roundtrip"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
    s["csv_inferred"] = _with(FX_TRACKS) + (
        "SELECT CAST(id AS INTEGER) AS id, name, popularity, id_artists, release_date, " + FCOLS + " FROM fx_tracks")
    s["catalog_tables"] = _with(BASE) + (
        "SELECT 'grouprank_db' AS database, 'group_counts' AS table_name, count(DISTINCT genre) AS groups, "
        "count(*) AS track_rows FROM curated")
    s["jsonl_roundtrip"] = _with(BASE, FX_RESPONSES, LOOKUP_ROWS, RESOLVED) + "SELECT * FROM resolved"
    s["positional_csv"] = ("SELECT CAST(doc_id AS VARCHAR) AS track_id, text AS track_name, source AS artist_name_primary, "
                           "lang AS genre FROM documents")
    s["partitioned_sink"] = _with(BASE) + f"SELECT {curated_cols} FROM curated"
    s["ctas_partitioned"] = _with(BASE) + "SELECT genre, count(*) AS track_rows FROM curated GROUP BY genre"

    # projections, filters
    s["select_existing"] = _with(FX_TRACKS) + f"SELECT id, name, popularity, id_artists, release_date, {FCOLS} FROM fx_tracks"
    s["complete_rows"] = _with(FX_TRACKS) + f"SELECT * FROM fx_tracks WHERE {_not_null(['id'] + F)}"
    s["text_available"] = (_with(WITH_TEXT)
                           + "SELECT * FROM enriched WHERE lyrics_found = true AND lyrics IS NOT NULL")
    s["clean_lookup_input"] = (_with(BASE, FX_RESPONSES, LOOKUP_ROWS, RESOLVED)
                               + "SELECT * FROM valid_in")
    s["group_semi_filter"] = (_with(BASE) + "SELECT id, genre FROM curated WHERE genre IN ("
                              + _chosen("curated", 500, 10) + ")")
    s["release_year"] = _with(FX_TRACKS) + (
        "SELECT id, release_date, CASE WHEN length(release_date) >= 4 "
        "THEN TRY_CAST(substr(release_date, 1, 4) AS INTEGER) END AS release_year FROM fx_tracks")

    # joins
    s["curate_items"] = _with(BASE) + f"SELECT {curated_cols} FROM curated"
    s["join_left"] = _with(FX_ARTISTS, FX_TRACKS, ENT) + (
        "SELECT t.artist_id_primary, e.artist_name_primary, count(*) AS items, CAST(max(len(e.artist_genres)) AS INTEGER) AS n_genres "
        f"FROM (SELECT id, nullif(regexp_extract(id_artists, {SINGLE_ID}, 1), '') AS artist_id_primary FROM fx_tracks) t "
        "LEFT JOIN ent e ON t.artist_id_primary = e.artist_id_primary GROUP BY t.artist_id_primary, e.artist_name_primary")
    s["curate_first_id"] = _with(FX_ARTISTS, FX_TRACKS, ENT, ENT_G) + (
        "SELECT e.genre, count(DISTINCT t.id) AS track_rows, count(DISTINCT e.artist_id_primary) AS entities "
        f"FROM (SELECT id, regexp_extract(id_artists, {FIRST_ID}, 1) AS a FROM fx_tracks) t JOIN ent_g e ON t.a = e.artist_id_primary "
        "GROUP BY e.genre")
    without = ["popularity", "release_date"]
    left = [c for c in CURATED_COLUMNS if c not in without + ["duration_ms", "explicit", "artists", "key", "mode", "time_signature"]]
    s["optional_columns"] = _with(BASE) + f"SELECT id, genre, CAST(NULL AS INTEGER) AS release_year, '{','.join(left)}' AS columns FROM curated"
    s["enrich_text"] = _with(WITH_TEXT) + "SELECT * FROM enriched"
    s["join_composite"] = _with(WITH_TEXT) + (
        "SELECT c.id AS track_id, c.genre, c.artist_id_primary, round(c.tempo, 6) AS tempo, e.lyrics_found "
        "FROM curated c JOIN enriched e ON c.id = e.track_id AND c.genre = e.genre")
    s["join_composite_bucketed"] = s["join_composite"]
    s["pair_join"] = _with(BASE, A) + _per_query("apairs", "dist", 2)
    s["text_cosine"] = _with(WITH_TEXT, T) + _per_query("tcos", "text_cos")
    s["text_cosine_min"] = _with(WITH_TEXT, T) + (
        "SELECT genre, qid, cid, round(text_cos, 6) AS text_cos FROM tcos WHERE text_cos >= 0.2")

    # aggregations
    s["group_distribution"] = _with(BASE) + (
        "SELECT genre, count(*) AS track_rows FROM curated GROUP BY genre ORDER BY track_rows DESC, genre LIMIT 50")
    s["table_row_counts"] = _with(BASE) + (
        "SELECT (SELECT count(*) FROM fx_tracks) AS tracks_rows, (SELECT count(*) FROM fx_artists) AS artists_rows, "
        "(SELECT count(*) FROM curated) AS curated_rows")
    s["text_quality_total"] = _with(BASE, FX_RESPONSES, LOOKUP_ROWS, RESOLVED) + (
        "SELECT count(*) AS lyric_rows, CAST(sum(CASE WHEN lyrics_found THEN 1 ELSE 0 END) AS BIGINT) AS found_rows "
        "FROM resolved")
    s["text_quality_by_group"] = _with(WITH_TEXT) + _QUALITY
    s["eligible_groups"] = _with(BASE) + (
        "SELECT genre, count(*) AS track_rows FROM curated WHERE genre IS NOT NULL GROUP BY genre HAVING count(*) >= 500")
    s["distinct_groups"] = _with(BASE) + "SELECT DISTINCT genre FROM curated ORDER BY genre"
    s["dedupe_by_key"] = _with(BASE) + (
        "SELECT id, genre, artist_id_primary FROM (SELECT id, genre, artist_id_primary, "
        "row_number() OVER (PARTITION BY id ORDER BY genre) AS rn FROM curated) WHERE rn = 1")
    s["distinct_items_per_group"] = _with(BASE) + (
        "SELECT genre, count(DISTINCT id) AS distinct_tracks FROM curated GROUP BY genre")
    s["distinct_items_sketched"] = _with(BASE) + (
        "SELECT genre, count(DISTINCT id) AS distinct_tracks, true AS estimate_near FROM curated GROUP BY genre")
    s["stage_counts"] = _with(WITH_TEXT) + (
        "SELECT 'curated' AS stage, count(*) AS n_rows FROM curated UNION ALL SELECT 'enriched', count(*) FROM enriched")
    s["importance_rollup"] = _with(BASE, I) + (
        "SELECT genre, feature, CAST(GROUPING_ID(genre, feature) AS INTEGER) AS level, count(*) AS scores, "
        "round(sum(importance_norm), 6) AS importance_norm_sum, round(max(abs(importance_norm)), 6) AS strongest "
        "FROM fi GROUP BY GROUPING SETS ((genre, feature), (feature), ())")
    s["feature_importance"] = _with(BASE, I) + (
        "SELECT genre, feature, round(importance_raw, 4) AS importance_raw, round(importance_abs, 4) AS importance_abs, "
        "round(importance_norm, 6) AS importance_norm FROM fi")
    s["pair_sample_importance"] = _with(BASE, I, sampled_importance_ctes()) + (
        "SELECT r.genre, r.feature, round(r.importance_raw, 4) AS importance_raw, round(abs(r.importance_raw), 4) AS importance_abs, "
        "round(r.importance_raw / r.total, 6) AS importance_norm, round(r.std_error, 4) AS std_error, r.n_same, r.n_different, "
        "round(f.importance_raw, 4) AS expected_raw FROM sraw r JOIN fi f ON r.genre = f.genre AND r.feature = f.feature")
    s["importance_by_feature"] = _with(BASE, I) + (
        "SELECT feature, round(sum(importance_norm), 6) AS importance_norm_sum FROM fi GROUP BY feature")
    s["top_features"] = _with(BASE, I) + (
        "SELECT genre, feature, round(importance_norm, 6) AS importance_norm, place FROM (SELECT *, CAST(row_number() OVER ("
        "ORDER BY importance_norm DESC, feature) AS INTEGER) AS place FROM fi WHERE genre = 'building') WHERE place <= 20")
    s["eval_audio"] = _with(BASE, A) + _eval_select("ea")
    s["eval_audio_text"] = _with(WITH_TEXT, T) + (
        "SELECT genre, n_tracks_in_genre, n_queries, k, round(alpha_audio_weight, 6) AS alpha_audio_weight, "
        "round(recall_at_k, 6) AS recall_at_k, round(mrr_at_k, 6) AS mrr_at_k FROM et")
    s["eval_report"] = _with(WITH_TEXT, T) + (
        "SELECT genre, n_tracks_in_genre, n_queries, k, round(alpha_audio_weight, 6) AS alpha_audio_weight, "
        "round(recall_at_k, 6) AS recall_at_k, round(mrr_at_k, 6) AS mrr_at_k, "
        "CAST(row_number() OVER (ORDER BY et.recall_at_k DESC, genre) AS INTEGER) AS place FROM et")
    s["eval_report_audio"] = _with(BASE, A) + (
        "SELECT genre, n_queries, k, round(recall_at_k, 6) AS recall_at_k, round(mrr_at_k, 6) AS mrr_at_k, "
        "CAST(row_number() OVER (ORDER BY ea.recall_at_k DESC, genre) AS INTEGER) AS place FROM ea")
    s["run_timestamp"] = _with(BASE, A) + "SELECT genre, '2024-01-02 03:04:05' AS run_ts FROM ea"
    s["predictor_groups"] = _with(BASE, I) + "SELECT DISTINCT genre FROM fi"
    s["eval_audio_zscore"] = _with(BASE, audio_ctes(zscore=True)) + _eval_select("ea")
    s["eval_audio_variety"] = _with(BASE, _variety_ctes(), audio_ctes(groups="SELECT genre FROM tg UNION SELECT genre FROM vg")) + _eval_select("ea")
    zc = ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in F)
    uc = ", ".join(f"round(u_z_{c}, 6) AS u_z_{c}" for c in F)
    s["zscore"] = _with(WITH_TEXT, T) + f"SELECT track_id, genre, {zc} FROM zt"
    s["l2_normalize"] = _with(WITH_TEXT, T) + f"SELECT track_id, genre, {uc} FROM ut"
    s["tfidf"] = _with(WITH_TEXT, T) + (
        "SELECT track_id, genre, term, tf, df, round(idf, 6) AS idf, round(weight, 6) AS weight FROM tfidf")
    ws = r"'[ \t\n\x0B\f\r]+'"
    s["tokenize"] = _with(WITH_TEXT) + (
        "SELECT track_id, genre, term, count(*) AS tf FROM ("
        f"SELECT track_id, genre, unnest(string_split_regex(lower(lyrics), {ws})) AS term FROM enriched "
        "WHERE lyrics_found = true AND lyrics IS NOT NULL) WHERE term <> '' GROUP BY track_id, genre, term")
    H = text_ctes(hashed=True)
    s["hashed_term_counts"] = _with(WITH_TEXT, H) + (
        "SELECT track_id, genre, count(*) AS buckets, CAST(sum(tf) AS BIGINT) AS tokens FROM mtf GROUP BY track_id, genre")
    s["tfidf_hashed"] = _with(WITH_TEXT, H) + (
        "SELECT track_id, genre, CAST(count(*) FILTER (weight <> 0) AS INTEGER) AS nonzero_terms, round(sum(weight), 6) AS total_weight "
        "FROM tfidf GROUP BY track_id, genre")
    s["eval_audio_text_hashed"] = _with(WITH_TEXT, H) + s["eval_audio_text"][s["eval_audio_text"].rindex("SELECT genre, n_tracks_in_genre"):]
    s["audio_cosine"] = _with(WITH_TEXT, T) + _per_query("tscored", "audio_cos")
    s["blended_rank"] = _with(WITH_TEXT, T) + (
        'SELECT genre, qid, cid, round(score, 6) AS score, CAST(rk AS INTEGER) AS "rank" FROM tranked WHERE rk <= 10')

    # windows, sorts, sampling
    s["sample_per_group"] = _with(BASE) + (
        "SELECT genre, id, CAST(rn AS INTEGER) AS \"rank\" FROM (SELECT genre, id, row_number() OVER ("
        "PARTITION BY genre ORDER BY md5(concat_ws(':', '42', 'cap', id)), id) AS rn FROM curated "
        f"WHERE {_not_null(['id', 'genre', 'artist_id_primary'] + F)}) WHERE rn <= 40")
    s["knn_topk"] = _with(BASE, A) + (
        'SELECT genre, qid, cid, round(dist, 6) AS dist, CAST(rk AS INTEGER) AS "rank" FROM aranked WHERE rk <= 10')
    s["knn_cells"] = s["knn_topk"]
    s["first_hit_rank"] = _with(BASE, A) + (
        "SELECT q.genre, q.id AS qid, CAST(f.first_hit_rank AS INTEGER) AS first_hit_rank "
        "FROM aq q LEFT JOIN afh f ON q.genre = f.genre AND q.id = f.qid")
    s["top_groups"] = _with(BASE) + (
        "SELECT genre, count(*) AS track_rows FROM curated WHERE genre IS NOT NULL GROUP BY genre "
        "ORDER BY track_rows DESC, genre LIMIT 10")
    s["capped_sample"] = _with(BASE, LOOKUP_ROWS) + (
        "SELECT * FROM lookup_rows ORDER BY md5(concat_ws(':', '42', 'capped', track_id)), "
        "track_id, track_name, artist_name_primary, genre LIMIT 5000")
    s["delta_report"] = _with(WITH_TEXT, A, T) + (
        "SELECT genre, baseline_available, delta_recall, delta_mrr, alpha_audio_weight, CAST(row_number() OVER ("
        "ORDER BY baseline_available, delta_recall DESC NULLS LAST, genre) AS INTEGER) AS place FROM (" + _delta_select("LEFT JOIN") + ")")
    s["select_groups_top"] = _with(BASE) + _chosen("curated", 500, 10)
    s["preview_rows"] = _with(BASE) + (
        "SELECT * FROM (SELECT 'tracks' AS table_name, id, name, name AS label FROM fx_tracks ORDER BY id LIMIT 5) UNION ALL "
        "SELECT * FROM (SELECT 'artists', id, name, name FROM fx_artists ORDER BY id LIMIT 5) UNION ALL "
        "SELECT * FROM (SELECT 'curated', id, name, genre FROM curated ORDER BY id, genre LIMIT 5)")
    s["select_groups_sql"] = _with(BASE, _variety_ctes()) + "SELECT * FROM tg UNION ALL SELECT * FROM vg"
    variety_both = f"""gc AS (SELECT genre, count(*) AS n FROM curated WHERE genre IS NOT NULL GROUP BY genre HAVING count(*) >= 300),
tg AS (SELECT genre FROM gc ORDER BY n DESC, genre LIMIT 5),
vg AS (SELECT genre FROM gc WHERE genre NOT IN (SELECT genre FROM tg)
       ORDER BY md5(concat_ws(':', '42', 'group', genre)), genre, n LIMIT 5)"""
    s["select_groups_variety"] = _with(BASE, variety_both) + "SELECT genre FROM tg UNION SELECT genre FROM vg"

    # scalar functions
    s["primary_entity_id"] = _with(FX_TRACKS) + (
        f"SELECT id, id_artists, regexp_extract(id_artists, {SINGLE_ID}, 1) AS artist_id_primary, "
        f"regexp_extract(id_artists, {FIRST_ID}, 1) AS artist_id_first FROM fx_tracks")
    s["parse_list_string"] = _with(FX_ARTISTS, ENT_RAW) + (
        "SELECT id, genres, array_to_string(artist_genres, '|') AS genre_list, "
        "CAST(len(artist_genres) AS INTEGER) AS n_genres FROM ent_raw")
    s["normalize_label"] = _with(FX_ARTISTS, ENT) + (
        "SELECT artist_id_primary, pos, raw, lower(trim(raw)) AS label FROM ("
        "SELECT artist_id_primary, CAST(generate_subscripts(artist_genres, 1) - 1 AS INTEGER) AS pos, "
        "unnest(artist_genres) AS raw FROM ent)")
    s["explode_groups"] = _with(FX_ARTISTS, ENT, ENT_G) + "SELECT artist_id_primary, genre FROM ent_g"
    s["coalesce_existing"] = _with(BASE, LOOKUP_ROWS) + "SELECT * FROM lookup_rows"
    s["pick_text"] = _with(FX_RESPONSES) + f"SELECT track_id, {PICK} AS lyrics, ({PICK}) IS NOT NULL AS lyrics_found FROM fx_responses"
    field = "json_type(response_json, '$[0].{0}Lyrics') = 'VARCHAR' AND json_extract_string(response_json, '$[0].{0}Lyrics') <> ''"
    other = "coalesce(json_type(response_json, '$[0].{0}Lyrics') NOT IN ('VARCHAR', 'NULL'), false)"
    s["pick_text_variant"] = _with(FX_RESPONSES) + f"""
SELECT track_id, CASE WHEN reason = 'ok' THEN text END AS lyrics, reason FROM (
  SELECT *, CASE WHEN response_json IS NULL THEN 'no_response' WHEN NOT json_valid(response_json) THEN 'not_json'
                 WHEN json_type(response_json) <> 'ARRAY' THEN 'no_array' WHEN text IS NOT NULL THEN 'ok'
                 WHEN {other.format('plain')} OR {other.format('synced')} THEN 'not_text' ELSE 'empty' END AS reason
  FROM (SELECT *, CASE WHEN NOT json_valid(response_json) THEN NULL
                       WHEN {field.format('plain')} THEN json_extract_string(response_json, '$[0].plainLyrics')
                       WHEN {field.format('synced')} THEN json_extract_string(response_json, '$[0].syncedLyrics') END AS text
        FROM (SELECT track_id, CASE WHEN CAST(track_id AS BIGINT) % 11 = 5 THEN '[{{"plainLyrics":' || track_id || '}}]' ELSE response_json END AS response_json
              FROM fx_responses)))"""
    s["clean_list_value"] = _with(FX_ARTISTS, ENT_RAW) + (
        "SELECT id, coalesce(trim(array_to_string(list_transform(list_filter(artist_genres, "
        "lambda x: x IS NOT NULL), lambda x: trim(x)), ' ')), '') AS genres_clean, "
        "coalesce(trim(name), '') AS name_clean FROM ent_raw")

    # composite stages
    s["lookup_input_top"] = _with(BASE) + _LOOKED_UP
    s["lookup_input_stratified"] = _with(BASE) + (
        "SELECT track_id, track_name, artist_name_primary, genre FROM ("
        "SELECT id AS track_id, name AS track_name, artist_name_primary, genre, row_number() OVER ("
        "PARTITION BY genre ORDER BY md5(concat_ws(':', '42', 'strat', id)), id) AS rn FROM curated "
        "WHERE id IS NOT NULL AND name IS NOT NULL AND artist_name_primary IS NOT NULL AND genre IS NOT NULL) "
        "WHERE rn <= 10 ORDER BY md5(concat_ws(':', '42', 'capped', track_id)), track_id, track_name, "
        "artist_name_primary, genre LIMIT 5000")
    s["resolve_lookups"] = s["jsonl_roundtrip"]
    s["convert_text"] = s["jsonl_roundtrip"]
    s["delta_flagged"] = _with(WITH_TEXT, A, T) + _delta_select("LEFT JOIN")
    s["delta_unflagged"] = _with(WITH_TEXT, A, T) + _delta_select("JOIN")
    s["pipeline_delta"] = s["delta_flagged"]
    s["pipeline_incremental"] = s["delta_flagged"]
    looked_up = f"lookup_rows AS ({_LOOKED_UP})"
    records = """text_records AS (
  SELECT track_id, lower(trim(genre)) AS genre, lyrics, lyrics_found FROM resolved)"""
    s["pipeline_lookups"] = _with(BASE, looked_up, FX_RESPONSES, RESOLVED, records, ENRICHED) + _QUALITY
    s["eval_vectors"] = _with(FX_VEC, _vec_ctes()) + _eval_select("ev")
    return s
