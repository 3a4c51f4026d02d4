"""DuckDB SQL for every registered query that SQL can express, over the whole tables."""

from __future__ import annotations

from minelark.functions.text import PRIME, hash_parameters, narrow_hash_parameters
from minelark.sources.views import sql

EDGES, RATINGS, CONDITIONS = sql("edges"), sql("ratings"), sql("conditions")
EVENTS, VECTORS = sql("user_events"), sql("vectors")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

PAIRS = f"""
e AS ({EDGES}),
pairs AS (
  SELECT x.dst AS a, y.dst AS b, count(*) AS score
  FROM e x JOIN e y ON x.src = y.src AND x.dst < y.dst
  WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.src = x.dst AND f.dst = y.dst)
    AND NOT EXISTS (SELECT 1 FROM e f WHERE f.src = y.dst AND f.dst = x.dst)
  GROUP BY x.dst, y.dst),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, suggested) AS rank
  FROM (SELECT a AS "user", b AS suggested, score FROM pairs
        UNION ALL SELECT b, a, score FROM pairs))"""

BASKETS = f"""
b AS (SELECT DISTINCT PATIENT AS basket, CODE AS item FROM ({CONDITIONS})),
support AS (SELECT item, count(*) AS n FROM b GROUP BY item),
items AS (SELECT item, n FROM support WHERE item IS NOT NULL AND n >= (SELECT ceil(avg(n)) FROM support)),
fb AS (SELECT b.* FROM b JOIN items USING (item)),
p AS (SELECT x.item AS i, y.item AS j, count(*) AS n FROM fb x JOIN fb y USING (basket)
      WHERE x.item < y.item GROUP BY x.item, y.item)"""
TRIPLES = """
t AS (SELECT x.item AS i, y.item AS j, z.item AS z, count(*) AS n
      FROM fb x JOIN fb y USING (basket) JOIN fb z USING (basket)
      WHERE x.item < y.item AND y.item < z.item GROUP BY x.item, y.item, z.item)"""
LITERAL_PAIRS = """
lp AS (SELECT i, j, n FROM p UNION ALL SELECT j, i, n FROM p UNION ALL SELECT item, item, n FROM items)"""

CODES = " + ".join(f"l[i + {p}]::BIGINT * {128 ** (8 - p)}" for p in range(9))
CLEAN = r"lower(regexp_replace(text, '[^\x00-\x7F]', '', 'g'))"
SHINGLES = f"""
d AS (SELECT min(doc_id) AS doc_id, t FROM (SELECT doc_id, {CLEAN} AS t FROM documents) GROUP BY t),
chars AS (SELECT doc_id, [ascii(c) for c in string_split(t, '')] AS l FROM d),
s AS (SELECT DISTINCT doc_id, code FROM (
        SELECT doc_id, unnest([{CODES} for i in range(1, len(l) - 8)]) AS code FROM chars)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)"""
SEEDS = ", ".join(f"({s}, {a}, {b})" for s, (a, b) in enumerate(hash_parameters(100)))
SIGNATURES = f"""{SHINGLES},
sig AS (SELECT doc_id, seed, min((a * (code % {PRIME}) + b) % {PRIME}) AS value
        FROM s, (VALUES {SEEDS}) h(seed, a, b) GROUP BY doc_id, seed)"""
GIVEN_PRIME = 1_000_003
GIVEN_HASHES = [(7, 1), (1_009, 77), (999_999, 500_000)]


def _signatures(hashes: list[tuple[int, int]], prime: int) -> str:
    seeds = ", ".join(f"({s}, {a}, {b})" for s, (a, b) in enumerate(hashes))
    return f"""
        WITH {SHINGLES}
        SELECT doc_id, seed, min((a * (code % {prime}) + b) % {prime}) AS value
        FROM s, (VALUES {seeds}) h(seed, a, b) GROUP BY doc_id, seed"""


CANDIDATES = f"""{SIGNATURES},
bands AS (SELECT doc_id, seed // 5 AS band, list(value ORDER BY seed) AS key FROM sig GROUP BY doc_id, seed // 5),
cand AS (SELECT x.doc_id AS i, y.doc_id AS j, count(*) AS bands FROM bands x JOIN bands y
         ON x.band = y.band AND x.key = y.key AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id)"""


def _jaccard(pairs: str) -> str:
    return f"""
shared AS (SELECT x.doc_id AS i, y.doc_id AS j, count(*) AS inter
           FROM s x JOIN s y ON x.code = y.code AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
measured AS (SELECT c.i, c.j, coalesce(inter, 0) AS inter, x.n + y.n - coalesce(inter, 0) AS "union"
             FROM {pairs} c LEFT JOIN shared ON shared.i = c.i AND shared.j = c.j
             JOIN sizes x ON x.doc_id = c.i JOIN sizes y ON y.doc_id = c.j)"""


SIMILARITY = f"""
r AS ({RATINGS}),
n AS (SELECT count(DISTINCT user_id) AS c FROM r),
terms AS (SELECT item_id, sum(rating) AS s, sum(rating * rating) AS q, sum(rating) / max(c) AS m,
                 sum(rating * rating) - sum(rating) * sum(rating) / max(c) AS v FROM r, n GROUP BY item_id)"""
ITEM_SIMS = f"""{SIMILARITY},
dots AS (SELECT x.item_id AS i, y.item_id AS j, sum(x.rating * y.rating) AS dot
         FROM r x JOIN r y ON x.user_id = y.user_id AND x.item_id < y.item_id GROUP BY x.item_id, y.item_id),
sims AS (SELECT i, j, round(CASE WHEN a.v > 0 AND b.v > 0
                THEN (dot - a.s * b.s / c) / (sqrt(a.v) * sqrt(b.v)) ELSE 0 END, 6) AS sim
         FROM dots JOIN terms a ON a.item_id = i JOIN terms b ON b.item_id = j, n)"""
TO_ITEM = f"""{SIMILARITY},
one AS (SELECT * FROM r WHERE item_id = 1),
sims AS (SELECT t.item_id, CASE WHEN t.v > 0 AND o.v > 0
                THEN (coalesce(dot, 0) - t.s * o.s / c) / (sqrt(t.v) * sqrt(o.v)) ELSE 0 END AS sim
         FROM terms t LEFT JOIN (SELECT r.item_id, sum(r.rating * one.rating) AS dot
                                 FROM r JOIN one ON r.user_id = one.user_id GROUP BY r.item_id) USING (item_id),
              (SELECT * FROM terms WHERE item_id = 1) o, n)"""
USER_TERMS = f"""{SIMILARITY},
base AS (SELECT sum(m * m) AS b FROM terms),
u AS (SELECT user_id, sum(m * rating) AS x, sum(rating * rating) - 2 * sum(m * rating) + max(b) AS v
      FROM r JOIN terms USING (item_id), base GROUP BY user_id)"""
DRAW = "('0x' || substr(md5('0:' || user_id || ':' || item_id), 1, 8))::BIGINT / 4294967296.0"


def _user_sims(source: str) -> str:
    return f"""
dots AS (SELECT x.user_id AS i, y.user_id AS j, sum(x.rating * y.rating) AS dot
         FROM {source} x JOIN {source} y ON x.item_id = y.item_id AND x.user_id < y.user_id
         GROUP BY x.user_id, y.user_id)
SELECT i, j, round(CASE WHEN a.v > 0 AND c.v > 0
         THEN (dot - a.x - c.x + b) / (sqrt(a.v) * sqrt(c.v)) ELSE 0 END, 4) AS sim
FROM dots JOIN u a ON a.user_id = i JOIN u c ON c.user_id = j, base"""


EVENT_MATRIX = f"""
r AS ({EVENTS}),
m AS (SELECT user_id, {", ".join(f"coalesce(max(rating) FILTER (item_id = '{t}'), 0) AS {t}" for t in EVENT_TYPES)}
      FROM r GROUP BY user_id)"""
ROW_MEAN = "(" + " + ".join(EVENT_TYPES) + f") / {len(EVENT_TYPES)}"

MIDDLES = f"""
v AS ({VECTORS}),
parts AS (SELECT id, cluster, unnest(features) AS x, unnest(range(64)) AS dim FROM v),
means AS (SELECT cluster, dim, avg(x) AS x FROM parts GROUP BY cluster, dim),
middle AS (SELECT cluster, list(x ORDER BY dim) AS centroid FROM means GROUP BY cluster)"""


def _extent(vectors: str) -> str:
    return f"""
w AS ({vectors}),
pd AS (SELECT x.cluster, max(list_distance(x.features, y.features)) AS diameter,
              min(list_distance(x.features, y.features)) AS min_distance
       FROM w x JOIN w y ON x.cluster = y.cluster AND x.id < y.id GROUP BY x.cluster)"""


# one merge a step over all clusters left; a cluster is named by its lowest id
WARD = f"""
v AS ({VECTORS}),
steps AS (
  SELECT 0 AS step, id AS cid, 1::BIGINT AS n, features AS c, NULL::BIGINT AS "left", NULL::BIGINT AS "right", NULL::DOUBLE AS height
  FROM v
  UNION ALL
  SELECT s.step + 1, s.cid, CASE WHEN s.cid = b.l THEN s.n + y.n ELSE s.n END,
         CASE WHEN s.cid = b.l THEN list_transform(list_zip(s.c, y.c), lambda p: (p[1] * s.n + p[2] * y.n) / (s.n + y.n)) ELSE s.c END,
         b.l, b.r, b.h
  FROM (SELECT x.cid AS l, y.cid AS r, sqrt(2 * x.n * y.n / (x.n + y.n)) * list_distance(x.c, y.c) AS h
        FROM steps x JOIN steps y ON x.cid < y.cid ORDER BY h, l, r LIMIT 1) b
  JOIN steps y ON y.cid = b.r JOIN steps s ON s.cid <> b.r),
merges AS MATERIALIZED (SELECT "left", "right", height, n AS size, step FROM steps WHERE cid = "left")"""


RULES = f"""
r AS (SELECT i AS antecedent, j AS consequent, n AS support FROM p
      UNION ALL SELECT j, i, n FROM p),
scored AS (SELECT antecedent, consequent, support, support / a.n AS confidence,
                  support / a.n - c.n / (SELECT count(DISTINCT basket) FROM b) AS interest
           FROM r JOIN support a ON a.item = antecedent JOIN support c ON c.item = consequent)"""


def oracle_sql() -> dict[str, str]:
    return {
        "adjacency_parse": f"""
            WITH lines AS (SELECT string_split(value, chr(9)) AS f FROM ({sql("adjacency_lines")}))
            SELECT f[1]::BIGINT AS "user", CASE WHEN len(f) > 1 THEN len(string_split(f[2], ',')) ELSE 0 END AS n_friends,
                   friend::BIGINT AS friend
            FROM (SELECT f, unnest(CASE WHEN len(f) > 1 THEN string_split(f[2], ',') ELSE ['-1'] END) AS friend
                  FROM lines)""",
        "adjacency_file": f"""
            WITH lines AS (SELECT string_split(value, chr(9)) AS f FROM ({sql("adjacency_lines")}))
            SELECT f[1]::BIGINT AS "user", CASE WHEN len(f) > 1 THEN len(string_split(f[2], ',')) ELSE 0 END AS n_friends,
                   friend::BIGINT AS friend
            FROM (SELECT f, unnest(CASE WHEN len(f) > 1 THEN string_split(f[2], ',') ELSE ['-1'] END) AS friend
                  FROM lines)""",
        "conditions_file": CONDITIONS,
        "inferred_table_file": f"""
            SELECT * REPLACE (l_linenumber::BIGINT AS l_linenumber, strftime(shipped, '%Y-%m-%d') AS shipped, reduced::BIGINT AS reduced),
                   'bigint,bigint,double,double,date,boolean,string,string,string' AS types
            FROM ({sql("mixed_types")})""",
        "ratings_file": RATINGS,
        "movies_file": sql("movies"),
        "features_file": f"""
            SELECT id, dim::INTEGER AS dim, round(x, 4) AS value
            FROM (SELECT id, unnest(features) AS x, unnest(range(64)) AS dim FROM ({VECTORS}))""",
        "common_neighbour_pairs": f"WITH {PAIRS} SELECT a, b, score FROM pairs",
        "common_neighbour_pairs_split": f"WITH {PAIRS} SELECT a, b, score FROM pairs",
        "friend_suggestions_topn": f"""
            WITH {PAIRS} SELECT "user", rank::INTEGER AS rank, suggested, score FROM ranked WHERE rank <= 10""",
        "friend_suggestions_ranked": f"""
            WITH {PAIRS} SELECT "user", rank::INTEGER AS rank, suggested, score FROM ranked WHERE rank <= 10""",
        "friend_suggestion_lines": f"""
            WITH {PAIRS} SELECT "user" || chr(9) || string_agg(suggested::VARCHAR, ', ' ORDER BY rank) AS value
            FROM ranked WHERE rank <= 10 GROUP BY "user" """,
        "friend_suggestions_all": f"""
            WITH {PAIRS} SELECT "user", rank, suggested, score FROM ranked""",
        "friend_suggestion_lines_all": f"""
            WITH {PAIRS} SELECT "user" || chr(9) || string_agg(suggested::VARCHAR, ', ' ORDER BY rank) AS value
            FROM ranked GROUP BY "user", (rank - 1) // 20""",
        "baskets": f"SELECT DISTINCT PATIENT AS basket, CODE AS item FROM ({CONDITIONS})",
        "item_support": f"WITH {BASKETS} SELECT item, n FROM support",
        "frequent_items": f"WITH {BASKETS} SELECT item, n FROM items",
        "infrequent_items": f"WITH {BASKETS} SELECT item, n FROM support WHERE item IS NOT NULL AND n < 1000",
        "frequent_pairs": f"WITH {BASKETS} SELECT i, j, n FROM p",
        "frequent_pairs_split": f"WITH {BASKETS} SELECT i, j, n FROM p",
        "frequent_triples_pruned": f"WITH {BASKETS}, {TRIPLES} SELECT i, j, z, n FROM t WHERE n >= 2",
        "ordered_pairs": f"WITH {BASKETS}, {LITERAL_PAIRS} SELECT i, j, n FROM lp",
        "frequent_triples_top10": f"""
            WITH {BASKETS}, {TRIPLES} SELECT i, j, z, n FROM t ORDER BY n DESC, i, j, z LIMIT 10""",
        "ordered_triples": f"""
            WITH {BASKETS}, {LITERAL_PAIRS} SELECT x.item AS i, y.item AS j, z.item AS z, count(*) AS n
            FROM fb x JOIN fb y USING (basket) JOIN fb z USING (basket) GROUP BY x.item, y.item, z.item""",
        "association_rules": f"""
            WITH {BASKETS}, {RULES}
            SELECT antecedent, consequent, support, round(confidence, 6) AS confidence,
                   round(interest, 6) AS interest
            FROM scored WHERE confidence >= 0.05 AND interest >= 0.01""",
        "association_rules_from_triples": f"""
            WITH {BASKETS}, {TRIPLES},
            r AS (SELECT i AS antecedent_1, j AS antecedent_2, z AS consequent, n AS support FROM t
                  UNION ALL SELECT i, z, j, n FROM t UNION ALL SELECT j, z, i, n FROM t),
            scored AS (SELECT antecedent_1, antecedent_2, consequent, support, support / p.n AS confidence,
                              support / p.n - c.n / (SELECT count(DISTINCT basket) FROM b) AS interest
                       FROM r JOIN p ON p.i = antecedent_1 AND p.j = antecedent_2
                       JOIN support c ON c.item = consequent)
            SELECT antecedent_1, antecedent_2, consequent, support, round(confidence, 6) AS confidence,
                   round(interest, 6) AS interest
            FROM scored WHERE confidence >= 0.05 AND interest >= 0.05""",
        "legacy_rule_scores": f"""
            WITH {BASKETS}, {LITERAL_PAIRS}
            SELECT i, j, n, round(1000 / n, 6) AS confidence,
                   floor((1000 / n - 0.9) * (SELECT count(*) FROM lp))::BIGINT AS max_occurrences
            FROM lp WHERE 1000 / n >= 0.9 AND floor((1000 / n - 0.9) * (SELECT count(*) FROM lp)) >= 0""",
        "code_description_dim": f'SELECT DISTINCT CODE AS "CODE", DESCRIPTION AS "DESCRIPTION" FROM ({CONDITIONS})',
        "document_parse": f"""
            SELECT doc_id, length(t) AS n_chars, md5(t) AS digest FROM (
              SELECT doc_id, {CLEAN.replace("text", "string_split(text, chr(9))[1]")} AS t FROM documents)""",
        "document_copies": f"""
            SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS first_id
            FROM (SELECT doc_id, {CLEAN} AS t FROM documents)""",
        "shingle_counts": f"WITH {SHINGLES} SELECT doc_id, n FROM sizes",
        "minhash_signatures": f"WITH {SIGNATURES} SELECT doc_id, seed, value FROM sig",
        "minhash_narrow": _signatures(narrow_hash_parameters(100), 100),
        "minhash_given_hashes": _signatures(GIVEN_HASHES, GIVEN_PRIME),
        "lsh_band_candidates": f"WITH {CANDIDATES} SELECT i, j, bands FROM cand",
        "lsh_bucket_members": f"""
            WITH {CANDIDATES}
            SELECT band::INTEGER AS band, doc_id, first_id, array_to_string(key, ',') AS key
            FROM (SELECT *, min(doc_id) OVER (PARTITION BY band, key) AS first_id, count(*) OVER (PARTITION BY band, key) AS n FROM bands)
            WHERE n > 1""",
        "lsh_star_jaccard": f"""
            WITH {CANDIDATES},
            stars AS (SELECT DISTINCT first_id AS i, doc_id AS j
                      FROM (SELECT *, min(doc_id) OVER (PARTITION BY band, key) AS first_id FROM bands) WHERE doc_id <> first_id),
            {_jaccard("stars")}
            SELECT i, j, inter, "union", round(inter / "union", 6) AS jaccard FROM measured""",
        "lsh_candidates_of_some": f"""
            WITH {CANDIDATES}
            SELECT doc_id, other, bands FROM (SELECT i AS doc_id, j AS other, bands FROM cand UNION ALL SELECT j, i, bands FROM cand)
            WHERE doc_id % 20 = 0""",
        "lsh_jaccard": f"""
            WITH {CANDIDATES}, {_jaccard("cand")}
            SELECT i, j, inter, "union", round(inter / "union", 6) AS jaccard FROM measured""",
        "lsh_jaccard_lines": f"""
            WITH {CANDIDATES}, {_jaccard("cand")}
            SELECT printf('Key : (%d, %d) , Value : %.6f', i, j, inter / "union") AS value FROM measured""",
        "jaccard_all_pairs": f"""
            WITH {SHINGLES}, {_jaccard("shared").replace("FROM shared c LEFT JOIN shared ON shared.i = c.i AND shared.j = c.j", "FROM shared c")}
            SELECT i, j, inter, "union", round(inter / "union", 6) AS jaccard
            FROM measured WHERE inter / "union" >= 0.5""",
        "ratings_pivot": f"WITH {EVENT_MATRIX} SELECT * FROM m",
        "demeaned_matrix": f"""
            WITH {EVENT_MATRIX} SELECT user_id,
            {", ".join(f"round({t} - {ROW_MEAN}, 6) AS {t}" for t in EVENT_TYPES)} FROM m""",
        "demeaned_ratings": f"""
            WITH {SIMILARITY} SELECT user_id, item_id, rating, round(m, 6) AS mean, round(rating - m, 6) AS centred
            FROM r JOIN terms USING (item_id)""",
        "similarity_to_item": f"WITH {TO_ITEM} SELECT item_id, round(sim, 6) AS sim FROM sims",
        "similarity_sign_counts": f"""
            WITH {TO_ITEM} SELECT count(*) FILTER (sim < 0) AS negative_count,
            count(*) FILTER (NOT coalesce(sim < 0, false)) AS positive_count FROM sims""",
        "item_similarity": f"WITH {ITEM_SIMS} SELECT i, j, sim FROM sims",
        "item_similarity_split": f"WITH {ITEM_SIMS} SELECT i, j, sim FROM sims",
        "user_similarity": f"WITH {USER_TERMS}, {_user_sims('r')}",
        "user_similarity_dimsum": f"""
            WITH {USER_TERMS},
            norms AS (SELECT user_id, sqrt(10 * ln(nu) / 0.05) / sqrt(sum(rating * rating)) AS p
                      FROM r, (SELECT count(DISTINCT user_id) AS nu FROM r) GROUP BY user_id, nu),
            kept AS (SELECT user_id, item_id, rating / least(1, p) AS rating FROM r JOIN norms USING (user_id)
                     WHERE {DRAW} < least(1, p)), {_user_sims('kept')}""",
        "nearest_items": f"""
            WITH {ITEM_SIMS}
            SELECT item_id, neighbour, sim FROM (
              SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, neighbour) AS rank
              FROM (SELECT i AS item_id, j AS neighbour, sim FROM sims UNION ALL SELECT j, i, sim FROM sims))
            WHERE rank <= 10""",
        "predicted_ratings": f"""
            WITH {ITEM_SIMS},
            both_ways AS (SELECT i AS item_id, j AS neighbour, sim FROM sims UNION ALL SELECT j, i, sim FROM sims),
            wanted AS (SELECT user_id, item_id + 1 AS item_id FROM r EXCEPT SELECT user_id, item_id FROM r),
            ranked AS (SELECT w.user_id, w.item_id, sim, rating,
                              row_number() OVER (PARTITION BY w.user_id, w.item_id ORDER BY sim DESC, neighbour) AS rank
                       FROM wanted w JOIN both_ways b ON b.item_id = w.item_id
                       JOIN r ON r.user_id = w.user_id AND r.item_id = b.neighbour),
            scores AS (SELECT user_id, item_id, sum(sim * rating) AS s, sum(abs(sim)) AS w
                       FROM ranked WHERE rank <= 10 GROUP BY user_id, item_id)
            SELECT user_id, item_id, round(s / w, 4) AS predicted, p_name AS title
            FROM scores JOIN part ON p_partkey = item_id WHERE w > 0""",
        "subset_semi_join": f"SELECT id FROM ({VECTORS}) WHERE cluster < 5",
        "feature_slice": f"""
            SELECT id, len(features[4:20]) AS width, round(list_sum(features[4:20]), 4) AS total FROM ({VECTORS})""",
        "l2_normalized": f"""
            WITH v AS ({VECTORS}), parts AS (SELECT id, unnest(features) AS x, unnest(range(64)) AS dim FROM v),
            norms AS (SELECT id, sqrt(sum(x * x)) AS norm FROM parts GROUP BY id)
            SELECT id, dim::INTEGER AS dim, round(CASE WHEN norm > 0 THEN x / norm ELSE x END, 4) AS value
            FROM parts JOIN norms USING (id)""",
        "pairwise_distance": f"""
            WITH v AS ({VECTORS}), first AS (SELECT cluster, min(id) AS i FROM v GROUP BY cluster)
            SELECT i, y.id AS j, round(list_distance(x.features, y.features), 4) AS d
            FROM first JOIN v x ON x.id = i JOIN v y ON y.cluster = first.cluster AND y.id > i""",
        "distance_extremes": f"""
            WITH {_extent(f"SELECT id, features, 0 AS cluster FROM ({VECTORS})")}
            SELECT round(diameter, 4) AS diameter, round(min_distance, 4) AS min_distance FROM pd""",
        "cluster_extent": f"""
            WITH {MIDDLES}, {_extent("SELECT * FROM v")},
            radii AS (SELECT cluster, count(*) AS n, max(list_distance(features, centroid)) AS radius
                      FROM v JOIN middle USING (cluster) GROUP BY cluster)
            SELECT cluster, n, round(coalesce(diameter, 0), 4) AS diameter, round(min_distance, 4) AS min_distance,
                   round(radius, 4) AS radius, round(CASE WHEN radius > 0 THEN n / radius END, 4) AS density
            FROM radii LEFT JOIN pd USING (cluster)""",
        "centroids": f"""
            WITH {MIDDLES} SELECT cluster, dim::INTEGER AS dim, round(x, 4) AS value FROM means""",
        "inter_cluster_distance": f"""
            WITH v AS ({VECTORS}),
            m AS (SELECT x.cluster AS cluster_i, y.cluster AS cluster_j,
                         avg(list_distance(x.features, y.features)) AS d
                  FROM v x, v y GROUP BY x.cluster, y.cluster)
            SELECT cluster_i, cluster_j, round(d, 4) AS mean_distance,
                   round(d / (SELECT max(d) FROM m), 4) AS relative FROM m""",
        "ward_merges": f"""
            WITH RECURSIVE {WARD} SELECT "left", "right", round(height, 4) AS height, size FROM merges""",
        "ward_merges_by_rounds": f"""
            WITH RECURSIVE {WARD} SELECT "left", "right", round(height, 4) AS height, size FROM merges""",
        "ward_cut_k6": f"""
            WITH RECURSIVE {WARD},
            kept AS MATERIALIZED (SELECT "left", "right" FROM merges ORDER BY height DESC, step DESC OFFSET 5),
            up AS (SELECT id, id AS cluster FROM v UNION ALL SELECT id, "left" FROM up JOIN kept ON cluster = "right")
            SELECT id, min(cluster) AS cluster FROM up GROUP BY id""",
        "cluster_summary": f"""
            SELECT id, round(features[1], 4) AS first_feature, round(features[64], 4) AS last_feature, cluster
            FROM ({VECTORS})""",
    }
