"""DuckDB SQL for the queries that SQL can express."""

from minelark.llm import quality as Q

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"
WHITE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_STEP = "(1::BIGINT << greatest(length(bin({})) - %d, 0)::BIGINT)" % Q.SKETCH_BITS
_LOWS = " ".join(f"WHEN '{name}' THEN {low}" for name, (low, _) in Q.MEASURES.items() if low is not None)
_HIGHS = " ".join(f"WHEN '{name}' THEN {high}" for name, (_, high) in Q.MEASURES.items())


def _level(k: int) -> str:
    """Median and outer quantiles of the merged sketches over the first k columns of the group."""
    keys = ", ".join((*Q.GROUP[:k], "measure"))
    return f"""
  SELECT {keys}, max(total) AS n, min(bucket) FILTER (100 * below >= 50 * total) AS mid,
    min(bucket) FILTER (100 * below >= CASE measure {_LOWS} END * total) AS low,
    min(bucket + {_STEP.format("bucket")} - 1) FILTER (100 * below >= CASE measure {_HIGHS} END * total) AS high
  FROM (SELECT {keys}, bucket, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY {keys}) AS total
        FROM (SELECT {keys}, bucket, sum(n)::BIGINT AS n FROM sketches GROUP BY {keys}, bucket)) GROUP BY {keys}"""


QUALITY = f"""
WITH words AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
counted AS (
  SELECT doc_id, lang, source, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[!?]'))::BIGINT AS n_shouts,
    list_filter(string_split(text, chr(10)), lambda l: trim(l, {WHITE}) <> '') AS lines
  FROM words),
windows AS (
  SELECT doc_id, pos, list_slice(w, pos, pos + 4) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS pos FROM counted)),
twice AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(5, coalesce(pos - before, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM twice) GROUP BY doc_id),
docs AS (
  SELECT c.doc_id, lang, source, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_shouts // greatest(n_words, 1) AS shouts,
    1000 * (len(lines) - len(list_distinct(lines))) // greatest(len(lines), 1) AS dup_lines,
    100 * word_chars // greatest(n_words, 1) AS word_length,
    1000 * greatest(n_symbols - 1, 0) // greatest(n_words, 1) AS symbols_less,
    1000 * greatest(n_shouts - 1, 0) // greatest(n_words, 1) AS shouts_less,
    1000 * greatest(len(lines) - len(list_distinct(lines)) - 1, 0) // greatest(len(lines), 1) AS dup_lines_less,
    100 * greatest(word_chars - 1, 0) // greatest(n_words, 1) AS word_length_less
  FROM counted c LEFT JOIN covered USING (doc_id)),
long AS (
  {" UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m}::BIGINT AS value FROM docs" for m in Q.MEASURES)}),
sketches AS (SELECT lang, source, measure, value - value % {_STEP.format("value")} AS bucket, count(*) AS n FROM long GROUP BY ALL),
fine AS ({_level(2)}), coarse AS ({_level(1)}), every AS ({_level(0)}),
chosen AS (
  SELECT f.lang, f.source, f.measure,
    {", ".join(f"CASE WHEN f.n >= {Q.MIN_DOCUMENTS} THEN f.{q} WHEN c.n >= {Q.MIN_DOCUMENTS} THEN c.{q} ELSE e.{q} END AS {q}" for q in ("mid", "low", "high"))}
  FROM fine f JOIN coarse c ON f.lang IS NOT DISTINCT FROM c.lang AND f.measure = c.measure JOIN every e ON f.measure = e.measure),
fences AS (
  SELECT lang, source, measure, low - {Q.MARGIN} * (mid - low) AS low, high + {Q.MARGIN} * (high - mid) AS high FROM chosen),
bounds AS (
  SELECT lang, source, {", ".join(f"max(low) FILTER (measure = '{m}') AS {m}_low, max(high) FILTER (measure = '{m}') AS {m}_high" for m in Q.MEASURES)}
  FROM fences GROUP BY lang, source),
judged AS (
  SELECT d.*, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    {" AND ".join(f"{m}_less <= {m}_high" + (f" AND {m} >= {m}_low" if low is not None else "") for m, (low, _) in Q.MEASURES.items())} AS inside
  FROM docs d JOIN bounds b ON d.lang IS NOT DISTINCT FROM b.lang AND d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept FROM judged
"""

_SHINGLES = f"""
  SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: list_slice(w, k, k + 4))
    WHEN len(w) > 0 THEN [w] ELSE [] END) AS shingle
  FROM (SELECT id, {WORDS} AS w FROM
    (SELECT {{id}} AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM {{table}}))"""

DECONTAMINATION = f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
sizes AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*)::BIGINT AS n_shared, max(n)::BIGINT AS n_item, count(*) / max(n) AS containment
FROM d JOIN b ON d.shingle = b.shingle JOIN sizes s ON s.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 75 * max(n)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), n)) AS crc)"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of the UTF-8 bytes of a string of code points below U+0100, beside ``crc_table``."""
    code = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    utf8 = f"flatten(list_transform({code}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [194 + (u - 128) // 64, 128 + u % 64] END))"
    return f"xor(list_reduce({utf8}, lambda s, b: xor(crc[(xor(s, b) & 255) + 1], s >> 8), 4294967295), 4294967295)"


SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents) GROUP BY doc_id, run),
hashed AS (SELECT run, times, {_crc32("doc_id || ':' || run")} AS h FROM runs, crc_table),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
without AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*)::BIGINT AS n_near, max(other_n) AS form_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
forms AS (
  SELECT f.word, min(other) AS form FROM formed f JOIN near e ON e.word = f.word AND e.other_n = f.form_n GROUP BY f.word),
led AS (SELECT word, form AS root FROM forms UNION ALL SELECT led.word, forms.form FROM led JOIN forms ON led.root = forms.word),
ends AS (SELECT word, root FROM led WHERE root NOT IN (SELECT word FROM forms))
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n
FROM formed f LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""

_LEVELS = 7  # eights of documents in a language that the SQL can climb


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_field(f) for f in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


def _climb(name: str, group: str) -> str:
    """The levels of a tree as ``<name>0`` to ``<name><_LEVELS>`` of group, pos, node; a group ends where it has one node."""
    steps = []
    for k in range(_LEVELS):
        below = f"(SELECT *, count(*) OVER (PARTITION BY {group}) AS total FROM {name}{k})"
        steps.append(f"""{name}{k + 1} AS (
  SELECT {group}, pos // 8 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node FROM {below} WHERE total > 1 GROUP BY {group}, pos // 8)""")
    return ",\n".join(steps)


def _siblings(name: str, group: str, start: str) -> str:
    """Per node of level 0 its siblings on all levels, before and behind it."""
    levels = " UNION ALL ".join(
        f"""SELECT s.{group}, s.pos, {k} AS level, coalesce(string_agg(o.node, '' ORDER BY o.pos) FILTER (o.pos < s.pos // {8**k}), '') AS before,
       coalesce(string_agg(o.node, '' ORDER BY o.pos) FILTER (o.pos > s.pos // {8**k}), '') AS behind
  FROM {name}0 s JOIN {name}{k} o ON o.{group} IS NOT DISTINCT FROM s.{group} AND o.pos // 8 = s.pos // {8 ** (k + 1)}
  JOIN {name}{k + 1} up ON up.{group} IS NOT DISTINCT FROM s.{group} AND up.pos = s.pos // {8 ** (k + 1)}
  GROUP BY s.{group}, s.pos""" for k in range(_LEVELS))
    return f"{start} AS ({levels})"


MANIFEST = f"""
WITH {_CRC_TABLE},
leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents, crc_table),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM leaves),
d0 AS (SELECT lang, pos, leaf AS node FROM ranked),
{_climb("d", "lang")},
subroots AS ({" UNION ALL ".join(f"SELECT lang, any_value(node) AS subroot FROM d{k} GROUP BY lang HAVING count(*) = 1" for k in range(_LEVELS + 1))}),
t0 AS (SELECT 1 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, subroot AS node, lang FROM subroots),
{_climb("t", "one")},
roots AS ({" UNION ALL ".join(f"SELECT any_value(node) AS root FROM t{k} HAVING count(*) = 1" for k in range(_LEVELS + 1))}),
{_siblings("d", "lang", "inner_side")},
{_siblings("t", "one", "outer_side")},
sides AS (
  SELECT r.doc_id, level, before, behind FROM ranked r JOIN inner_side s ON s.lang IS NOT DISTINCT FROM r.lang AND s.pos = r.pos
  UNION ALL
  SELECT r.doc_id, {_LEVELS} + level, before, behind
  FROM ranked r JOIN t0 ON t0.lang IS NOT DISTINCT FROM r.lang JOIN outer_side s ON s.pos = t0.pos),
proofs AS (SELECT doc_id, list([before, behind] ORDER BY level) AS proof FROM sides GROUP BY doc_id),
folds AS (
  SELECT r.doc_id, r.lang, leaf, coalesce(proof, []) AS proof,
    list_reduce(coalesce(proof, []), lambda node, p: ['', sha256(p[1] || node[2] || p[2])], ['', coalesce(changed, leaf)])[2] AS folded_root
  FROM ranked r LEFT JOIN proofs USING (doc_id))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(flatten(proof), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang, roots
"""

_TRIPLES = _SHINGLES.replace("len(w) >= 5", "len(w) >= 3").replace("len(w) - 3", "len(w) - 1").replace("k + 4", "k + 2")

NGRAM_JOIN = f"""
WITH RECURSIVE d AS ({_TRIPLES.format(id="doc_id", table="documents")}),
sizes AS (SELECT id, count(*)::BIGINT AS n FROM d GROUP BY id),
links AS (
  SELECT a.id AS a, b.id AS b FROM d a JOIN d b ON a.shingle = b.shingle AND a.id <> b.id
  JOIN sizes s ON s.id = a.id JOIN sizes t ON t.id = b.id
  GROUP BY a.id, b.id HAVING 100 * count(*) >= 90 * (max(s.n) + max(t.n) - count(*))),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reached WHERE a = doc_id), doc_id)) AS component_id
FROM documents LEFT JOIN sizes ON id = doc_id
"""

ORACLES = {
    "op2_decontamination": DECONTAMINATION, "op6_line_dedup": LINE_DEDUP, "op7_quality_rules": QUALITY,
    "op11_spelling": SPELLING, "op12_manifest": MANIFEST, "op13_ngram_join": NGRAM_JOIN,
}
