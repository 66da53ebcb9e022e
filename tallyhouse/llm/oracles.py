"""SQL to compare the corpus queries with, where SQL can express them; it takes every pair, the slow and plain way."""

from tallyhouse.llm.licences import DRIFT, LEAST, LOWER, TEMPLATES, UPPER

SPACE = r"[\x20\x09-\x0D]+"

PREFERENCE = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM turns
), last_reply AS (
  SELECT conv_id, max(place) AS place FROM placed WHERE role = 'assistant' GROUP BY conv_id
), rejected AS (
  SELECT p.conv_id, p.place, p.role, p.text FROM placed p LEFT JOIN last_reply l USING (conv_id) WHERE l.place IS NULL OR p.place < l.place
  UNION ALL
  SELECT l.conv_id, l.place, 'assistant', o.text
  FROM last_reply l JOIN last_reply n ON n.conv_id = xor(l.conv_id, 1) JOIN placed o ON o.conv_id = n.conv_id AND o.place = n.place
), met AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.place, b.place) AS place,
         coalesce(a.role = b.role AND a.text = b.text, false) AS same
  FROM placed a FULL JOIN rejected b ON a.conv_id = b.conv_id AND a.place = b.place
), prefix AS (
  SELECT conv_id, coalesce(min(place) FILTER (NOT same) - 1, max(place)) AS n FROM met GROUP BY conv_id
), sides AS (
  SELECT 'chosen' AS side, conv_id, place, role, text FROM placed UNION ALL SELECT 'rejected', conv_id, place, role, text FROM rejected
), pieces AS (
  SELECT s.*, s.place > p.n AS after, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece FROM sides s JOIN prefix p USING (conv_id)
), ends AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY side, conv_id, after ORDER BY place) AS stop FROM pieces
), done AS (
  SELECT side, conv_id, after, string_agg(piece, '' ORDER BY place) AS body,
         string_agg(CAST(stop - length(text) - 8 AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY place) FILTER (role = 'assistant') AS mask
  FROM ends GROUP BY side, conv_id, after
)
SELECT p.conv_id, p.n AS n_prompt_turns, coalesce(q.body, '') AS prompt, coalesce(c.body, '') AS chosen, coalesce(r.body, '') AS rejected,
       coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
FROM prefix p
LEFT JOIN done q ON q.conv_id = p.conv_id AND q.side = 'chosen' AND NOT q.after
LEFT JOIN done c ON c.conv_id = p.conv_id AND c.side = 'chosen' AND c.after
LEFT JOIN done r ON r.conv_id = p.conv_id AND r.side = 'rejected' AND r.after
"""

DECONTAMINATION = rf"""
WITH split AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SPACE}'), lambda w: w <> '') AS w FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SPACE}'), lambda w: w <> '') FROM benchmark WHERE item_id IS NOT NULL
), widths AS (
  SELECT DISTINCT least(5, len(w)) AS k FROM split WHERE kind = 'i' AND len(w) > 0
), shingles AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM split, widths WHERE len(w) >= k AND (kind = 'd' OR k = least(5, len(w)))
), items AS (
  SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 'i'
)
SELECT d.id AS doc_id, i.id AS item_id, max(i.n) AS n_shingles, count(*) AS n_found, round(count(*) / max(i.n), 6) AS containment
FROM shingles d JOIN items i ON d.s = i.s WHERE d.kind = 'd' GROUP BY d.id, i.id HAVING 5 * count(*) >= 4 * max(i.n)
"""



def _words(of: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in of) + "]"


_TEMPLATES = ",\n".join(f"({t}, '{x.label}', {x.base}, {_words(x.words)}, {len(x.keys[0][1]) == len(x.words)})" for t, x in enumerate(TEMPLATES))
_KEYS = ",\n".join(f"({t}, {k}, {off}, {_words(phrase)}, {DRIFT if k else 0})" for t, x in enumerate(TEMPLATES) for k, (off, phrase) in enumerate(x.keys))
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

#: Every template is tried at every word that its first key phrase begins with.
LICENCES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), templates(t, label, base, words, whole) AS (VALUES {_TEMPLATES}
), keys(t, k, off, phrase, drift) AS (VALUES {_KEYS}
), known AS (
  SELECT t, unnest(words) AS word, unnest(range(len(words))) AS p FROM templates
), places AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), weights AS (
  SELECT v.word, ln(1 + ((SELECT count(*) FROM docs) + 1.0) / (count(DISTINCT p.r) + 1.0)) AS weight
  FROM (SELECT DISTINCT word FROM known) v LEFT JOIN places p ON p.word = v.word GROUP BY v.word
), starts AS (
  SELECT d.r, k.t, p.i - k.off AS start FROM keys k JOIN places p ON p.word = k.phrase[1] JOIN docs d ON d.r = p.r
  WHERE k.k = 0 AND d.w[p.i + 1 : p.i + len(k.phrase)] = k.phrase
), failing AS (
  SELECT DISTINCT s.r, s.t, s.start FROM starts s JOIN keys k ON k.t = s.t AND k.k > 0 JOIN docs d ON d.r = s.r
  WHERE len(list_filter(range(-k.drift, k.drift + 1), lambda x: s.start + k.off + x >= 0
        AND d.w[greatest(s.start + k.off + x, 0) + 1 : greatest(s.start + k.off + x, 0) + len(k.phrase)] = k.phrase)) = 0
), found AS (
  SELECT s.r, s.t, s.start, sum(CASE WHEN s.start + n.p + {DRIFT} >= 0
           AND list_contains(d.w[greatest(s.start + n.p - {DRIFT}, 0) + 1 : greatest(s.start + n.p + {DRIFT}, 0) + 1], n.word) THEN g.weight ELSE 0 END) / sum(g.weight) AS share
  FROM (SELECT * FROM starts EXCEPT SELECT * FROM failing) s JOIN docs d ON d.r = s.r JOIN known n ON n.t = s.t JOIN weights g ON g.word = n.word
  GROUP BY s.r, s.t, s.start
), matches AS (
  SELECT f.r, f.start, t.label, t.base, CASE WHEN t.whole THEN 1.0::DOUBLE ELSE round(f.share, 6) END AS score FROM found f JOIN templates t USING (t)
), by_doc AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM matches WHERE score >= {LEAST} GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(b.n_base, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
       coalesce(b.base_labels, '') AS base_labels, coalesce(b.labels, '') AS labels, coalesce(b.score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN by_doc b USING (r)
"""

#: Every phrase of every piece is counted.
COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM counts WHERE f >= 100
), candidates AS (
  SELECT * FROM frequent c WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM frequent q WHERE q.lang = c.lang AND q.k > c.k AND q.f >= c.f AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1 : j], ' ') AS l_part, array_to_string(string_split(phrase, ' ')[j + 1 :], ' ') AS r_part
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.a * t.n::HUGEINT) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.phrase = c.l_part JOIN frequent r ON r.lang = c.lang AND r.phrase = c.r_part JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

ORACLES = {"op11_license_scan": LICENCES, "op13_collocations": COLLOCATIONS, "op4_preference_format": PREFERENCE, "op9_decontamination": DECONTAMINATION}
