"""SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

_TEXT = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

_UNIT = "('0x' || substr(md5({}), 1, 13))::BIGINT / 4503599627370496.0"

_MIX = f"""
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(n) FROM counts)::DOUBLE * (1.0::DOUBLE / (SELECT count(*) FROM counts)::DOUBLE) / n AS rate FROM counts),
terms AS (
  SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS term
  FROM rates, LATERAL (SELECT unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 24)::INT)) AS k)),
sums AS (SELECT source, sum(term) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms),
drawn AS (SELECT *, {_UNIT.format("'copies-0:' || coalesce(doc_id::VARCHAR, '')")} AS draw FROM documents),
numbered AS (
  SELECT d.*, (SELECT count(*) FROM sums s WHERE s.source IS NOT DISTINCT FROM d.source AND s.upto <= d.draw)::INT AS copies FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, copies, c.copy::INT AS copy,
  md5('order-0:' || coalesce(doc_id::VARCHAR, '') || ':' || c.copy) AS shuffle_key
FROM numbered, LATERAL (SELECT unnest(generate_series(1, copies)) AS copy) c
"""

_COPIES = f"""
WITH t AS (SELECT doc_id, {_TEXT} AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
hard AS (SELECT conv_id, bool_or(contains(text, '</turn>') OR contains(text, '### ')) AS escape FROM rows GROUP BY conv_id),
written AS (
  SELECT r.*, CASE WHEN escape THEN replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') ELSE text END AS body
  FROM rows r JOIN hard h ON r.conv_id IS NOT DISTINCT FROM h.conv_id)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || url_encode(role) || ': ' || body || '</turn>'))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

_NEAR = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 4 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
reached AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
lowest AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN lowest ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_MIDDLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
cut AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS prefix, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(u[greatest(x, y) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""

ORACLE: dict[str, str] = {
    "op1_poisson_mix": _MIX,
    "op4_exact_dedup": _COPIES,
    "op8_chat_format": _CHAT,
    "op10_minhash_near_dedup": _NEAR,
    "op11_fill_middle": _MIDDLE,
}
