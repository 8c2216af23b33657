"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from snapdiff.llm.chat import CONTROL, ESCAPES
from snapdiff.llm.licenses import PHRASES, TEMPLATES, all_words, template_words
from snapdiff.llm.text import LOWER, UPPER

ALNUM_WORDS = f"regexp_extract_all(translate(coalesce({{0}}, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SPACED_WORDS = f"regexp_extract_all(translate(coalesce({{0}}, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"


def _escaped(column: str) -> str:
    out = f"replace({column}, '&', '&amp;')"
    for mark in CONTROL:
        out = f"replace({out}, '{mark}', '{ESCAPES[mark[0]] + mark[1:]}')"
    return out


def _license_sql() -> str:
    places = " UNION ALL ".join(
        f"SELECT rid, i, '{label}' AS label FROM spot WHERE "
        + " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(" ")))
        for phrase, label in PHRASES.items())
    sets = ", ".join(f"('{label}', {template_words(t)!r}, {must!r})" for label, t, must in TEMPLATES)
    step = max(len(all_words(t)) for _, t, _ in TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, {ALNUM_WORDS.format('text')} AS ws FROM documents),
spot AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
place AS ({places}),
base AS (SELECT rid, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS z, list(DISTINCT label) AS labels FROM place GROUP BY rid),
line AS (SELECT rid, ln, {ALNUM_WORDS.format('line')} AS ws
         FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ln
               FROM d WHERE text IS NOT NULL)),
run AS (SELECT rid, ln, ws, sum(CASE WHEN len(ws) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY ln) AS block FROM line),
block AS (SELECT rid, block, flatten(list(ws ORDER BY ln)) AS ws FROM run WHERE len(ws) > 0 GROUP BY rid, block),
win AS (SELECT rid, block, k, list_distinct(list_slice(ws, k + 1, k + {2 * step})) AS have
        FROM (SELECT *, unnest(range(0, len(ws), {step})) AS k FROM block)),
t(label, words, must) AS (VALUES {sets}),
close AS (SELECT rid, block, k, label, must, len(list_intersect(words, have)) / len(words) AS share
          FROM win JOIN t ON list_has_all(have, must) AND 10 * len(list_intersect(words, have)) >= 8 * len(words)),
met AS (SELECT rid, label, max(share) AS share FROM close c
        WHERE NOT EXISTS (SELECT 1 FROM close o WHERE o.rid = c.rid AND o.block = c.block AND o.k = c.k
                          AND len(o.must) > len(c.must) AND list_has_all(o.must, c.must))
        GROUP BY rid, label),
best AS (SELECT rid, max(share) AS share, list(label) AS labels FROM met GROUP BY rid)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.a::BIGINT AS first_word, b.z::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(m.share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base b USING (rid) LEFT JOIN best m USING (rid)
"""


ORACLE = {
    "op2_wu_manber_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {ALNUM_WORDS.format('text')} AS ws FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS.format('text')} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(13, len(ws)) AS size FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS w
        FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM sized)),
spot AS (SELECT rid, size, i, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS w
         FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM win))),
occ AS (SELECT rid, i, size, item_id FROM spot JOIN win USING (size, w)),
hit AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(0, size)) AS k FROM occ) GROUP BY rid),
item AS (SELECT rid, list(DISTINCT item_id::VARCHAR) AS ids FROM occ GROUP BY rid)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(len(t.ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(list_sort(t.ids), ','), '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN hit h USING (rid) LEFT JOIN item t USING (rid)
""",
    "op6_hyperminhash_near_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACED_WORDS.format('text')} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + least(5, len(ws)) - 1), ' ') AS x
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * same >= 75 * (p.n + q.n - same)),
reach AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT l.b, r.c FROM reach r JOIN link l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id, min(r.c) = r.doc_id AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""",
    "op7_license_scan": _license_sql(),
    "op10_chat_formatting": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(replace({_escaped('role')}, chr(10), '&#10;')) + length({_escaped('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""",
    "op11_phrase_collocations": f"""
WITH piece AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM piece GROUP BY lang),
gram AS (SELECT lang, list_slice(ws, i, i + k - 1) AS g FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM piece, range(1, 6) t(k) WHERE len(ws) >= k)),
f AS (SELECT lang, g, count(*)::BIGINT AS c FROM gram GROUP BY lang, g HAVING count(*) >= 100),
cand AS (SELECT * FROM f WHERE len(g) > 1),
cut AS (SELECT lang, g, c, unnest(range(1, len(g))) AS k FROM cand),
scored AS (
  SELECT cut.lang, cut.g, cut.c AS a, k, x.c AS l, y.c AS r, n,
         ((1000::HUGEINT * cut.c::HUGEINT * n::HUGEINT) // (x.c::HUGEINT * y.c::HUGEINT))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.g = list_slice(cut.g, 1, k)
  JOIN f y ON y.lang = cut.lang AND y.g = list_slice(cut.g, k + 1, len(cut.g)) JOIN total ON total.lang = cut.lang),
one AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
part AS (SELECT lang, list_slice(g, i, i + k - 1) AS g, max(c) AS around FROM (
    SELECT lang, g, c, k, unnest(range(1, len(g) - k + 2)) AS i FROM cand, range(2, 5) t(k) WHERE len(g) > k) GROUP BY 1, 2),
kept AS (SELECT one.* FROM one LEFT JOIN part USING (lang, g) WHERE coalesce(100 * around < 100 * a, true)),
shown AS (SELECT *, array_to_string(g, ' ') AS phrase FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM shown) WHERE rank <= 2000
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS label, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own = label
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.own <> s.label AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 5
""",
    "op5_line_dedup": """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (
  SELECT rid, doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL),
pages AS (SELECT source, count(*) AS total FROM d GROUP BY source),
seen AS (
  SELECT source, trim(line) AS line, count(DISTINCT rid) AS n FROM l
  WHERE length(trim(line)) > 0 GROUP BY 1, 2),
bad AS (
  SELECT s.source, s.line FROM seen s JOIN pages p ON s.source IS NOT DISTINCT FROM p.source
  WHERE s.n >= 5 AND s.n > p.total * 0.05),
marked AS (
  SELECT l.*, b.line IS NOT NULL AS cut FROM l
  LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line) = b.line)
SELECT doc_id, source, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT cut), '') AS text,
       count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE cut)::BIGINT AS n_dropped
FROM marked GROUP BY rid, doc_id, source
UNION ALL SELECT doc_id, source, NULL, 0, 0 FROM d WHERE text IS NULL
""",
}
