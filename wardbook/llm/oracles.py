"""DuckDB SQL that each query of this subpackage must equal, where SQL can say it."""

from __future__ import annotations

from wardbook.llm.common import LOWER, UPPER
from wardbook.llm.divergence_rules import COMMON_WORDS, Limits
from wardbook.llm.queries import SHARDS

SPACES = "E' \\t\\n\\x0b\\x0c\\r'"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _hash60(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


_SHARD_LIST = ", ".join(f"'{s}'" for s in SHARDS)

OP1 = f"""
WITH RECURSIVE shards AS (SELECT [{_SHARD_LIST}] AS shard),
prefer AS (
  SELECT list_transform(shard, lambda s: {_hash60("'offset/' || s")} % 4099) AS off,
         list_transform(shard, lambda s: 1 + {_hash60("'step/' || s")} % 4098) AS inv FROM shards),
turns AS (
  SELECT 0 AS turn, range(0, 4099) AS free, -1::BIGINT AS slot, off, inv FROM prefer
  UNION ALL
  SELECT turn + 1, list_filter(free, lambda x: x <> best), best, off, inv FROM (
    SELECT *, list_min(list_transform(free, lambda s:
      (s + 4099 - off[turn % {len(SHARDS)} + 1]) * inv[turn % {len(SHARDS)} + 1] % 4099 * 4099 + s)) % 4099 AS best
    FROM turns WHERE turn < 4099)),
slots AS (SELECT slot, ([{_SHARD_LIST}])[(turn - 1) % {len(SHARDS)} + 1] AS shard FROM turns WHERE turn > 0)
SELECT d.doc_id, s.slot, s.shard
FROM documents d JOIN slots s ON s.slot = {_hash60("coalesce(d.doc_id::VARCHAR, '')")} % 4099
"""

_LIMITS = Limits()
_OWN = "CASE lang " + " ".join(
    f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in listed)}]" for lang, listed in COMMON_WORDS.items()
) + " END"


def _count(pattern: str) -> str:
    return f"length(regexp_replace(coalesce(text, ''), '{pattern}', '', 'g'))"


def _js(a: str, b: str) -> str:
    term = "CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0 END"
    p, q = f"list_transform({a}, lambda v: v / list_sum({a}))", f"list_transform({b}, lambda v: v / list_sum({b}))"
    one = f"list_sum(list_transform(list_zip({p}, {q}), lambda z: {term.replace('x', 'z[1]').replace('y', 'z[2]')}))"
    two = f"list_sum(list_transform(list_zip({q}, {p}), lambda z: {term.replace('x', 'z[1]').replace('y', 'z[2]')}))"
    return f"sqrt(greatest(({one} + {two}) / 2, 0))"


OP5 = rf"""
WITH w AS (SELECT doc_id, lang, text, {WORDS} AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS s
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM wins) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(5, nxt - i)) AS n FROM (
    SELECT doc_id, i, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 5) AS nxt FROM twice) GROUP BY 1),
counts AS (
  SELECT w.doc_id, lang, len(w) AS n_words, length(coalesce(text, '')) - {_count(r'[^\x20\x09-\x0D]')} AS word_chars,
    {_count('[^#*$%&|<>]')} AS n_symbols,
    len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: length(trim(l, {SPACES})) > 0))
      - len(list_distinct(list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: length(trim(l, {SPACES})) > 0))) AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    [{_count('[^a-z]')}, {_count(r'[^\x20\x09-\x0D]')}, {_count('[^A-Z]')}, {_count('[^0-9]')},
     {_count(r'[a-zA-Z0-9\x20\x09-\x0D]|[^\x00-\x7F]')}, {_count(r'[\x00-\x7F]')}]::DOUBLE[] AS chars,
    list_transform({_OWN}, lambda k: len(list_filter(w, lambda x: x = k))) AS hits
  FROM w LEFT JOIN covered c USING (doc_id)),
hist AS (SELECT *, list_append(hits, n_words - list_sum(hits))::DOUBLE[] AS common FROM counts),
bins AS (
  SELECT lang, 'chars' AS kind, unnest(chars) AS n, generate_subscripts(chars, 1) AS pos FROM hist WHERE list_sum(chars) >= {_LIMITS.min_chars_compared}
  UNION ALL
  SELECT lang, 'common', unnest(common), generate_subscripts(common, 1) FROM hist WHERE n_words >= {_LIMITS.min_words_compared}),
refs AS (SELECT lang, kind, list(n ORDER BY pos) AS h FROM (SELECT lang, kind, pos, sum(n) AS n FROM bins GROUP BY ALL) GROUP BY ALL),
far AS (
  SELECT hist.*,
    n_words < {_LIMITS.min_words} OR 100 * n_repeat_words > {_LIMITS.max_repeat_percent} * n_words AS base_failed,
    coalesce(CASE WHEN list_sum(chars) >= {_LIMITS.min_chars_compared} THEN {_js('chars', 'c.h')} END, 0) AS dc,
    coalesce(CASE WHEN n_words >= {_LIMITS.min_words_compared} THEN {_js('common', 'm.h')} END, 0) AS dw
  FROM hist
  LEFT JOIN refs c ON c.lang IS NOT DISTINCT FROM hist.lang AND c.kind = 'chars'
  LEFT JOIN refs m ON m.lang IS NOT DISTINCT FROM hist.lang AND m.kind = 'common')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (dc > {_LIMITS.max_char_distance} OR dw > {_LIMITS.max_word_distance}
    OR (dc > {_LIMITS.both_char_distance} AND dw > {_LIMITS.both_word_distance})) AS kept
FROM far
"""

OP8 = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS key FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT k.*, coalesce(f.first < k.doc_id, false) AS dropped FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP6 = """
WITH RECURSIVE able AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM able a JOIN able b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT u, u AS v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS component FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
  vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN counts c ON c.u = vec_id LEFT JOIN least l ON l.u = vec_id
"""

OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (SELECT u, u AS v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS component FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.u = d.doc_id
"""

LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

OP11 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tokens AS (SELECT lang, source, doc, unnest(w) AS term FROM t),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS total
  FROM (SELECT DISTINCT lang, source FROM t) g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
rates AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + v))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + v))::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM rates WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""

OP12 = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents))
"""

_BIT = "CASE WHEN {x} & 1 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"


def _crc_entry() -> str:
    """Eight steps of the checksum's shift register, each on a list of all 256 states."""
    states = "range(0, 256)"
    for _ in range(8):
        states = f"list_transform({states}, lambda x: {_BIT.replace('{x}', 'x')})"
    return states


OP13 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
target AS (
  SELECT unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
tokens AS (SELECT doc_id, unnest(w) AS word FROM words),
crc AS (SELECT {_crc_entry()} AS steps),
spelled AS (
  SELECT word, list_transform(range(0, octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT) AS bytes
  FROM (SELECT DISTINCT word FROM (SELECT word FROM tokens UNION ALL SELECT word FROM target))),
buckets AS (
  SELECT word, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM spelled, crc),
source_n AS (SELECT bucket, count(*) AS s FROM tokens JOIN buckets USING (word) GROUP BY 1),
target_n AS (SELECT bucket, count(*) AS t FROM target JOIN buckets USING (word) GROUP BY 1),
gains AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM source_n) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM target_n) + 10000))))::BIGINT AS gain
  FROM (SELECT unnest(range(0, 10000)) AS bucket) b LEFT JOIN source_n s ON s.bucket = b.bucket LEFT JOIN target_n t ON t.bucket = b.bucket),
weights AS (SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM tokens JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY 1),
scored AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words d LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS wanted
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""

ORACLES: dict[str, str] = {"op1_sharding": OP1, "op5_quality_rules": OP5, "op8_line_dedup": OP8,
    "op6_embedding_near_dedup": OP6, "op10_ngram_jaccard": OP10, "op11_source_audit": OP11, "op12_exact_dedup": OP12,
    "op13_importance_resampling": OP13,
}
