"""CodeBLEU in DuckDB's dialect: one row per token, brackets and scopes by windows and joins.

Written apart from ``functions.codeflow``, which works on arrays: trees are texts of shapes here,
scopes and definitions are found by comparing all occurrences of a name.
"""

from __future__ import annotations

from gapweave.functions import codeflow
from gapweave.functions.codebleu import keywords


def _listed(words) -> str:
    return ", ".join("'" + w.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for w in words)


def code_scores_sql(language: str) -> str:
    """CTEs from ``code_pairs(example_id, candidate, ref, pred)`` to ``code_scores(example_id, candidate, valid, codebleu)``."""
    pattern = codeflow.token_pattern(language).replace("'", "''")
    words = _listed(keywords(language))
    declarers = _listed([] if language in codeflow.HASH_COMMENTS else codeflow.DECLARERS) or "''"
    assigns = _listed(codeflow.ASSIGNS)
    name = lambda t: f"(regexp_matches({t}, '^[A-Za-z_]') AND {t} NOT IN ({words}, {declarers}))"
    starts = "(';', '{', '}', '(', chr(10))"
    return rf"""
code_texts AS (
  SELECT txt, row_number() OVER () AS tid FROM (
    SELECT coalesce(ref, '') AS txt FROM code_pairs UNION SELECT coalesce(pred, '') FROM code_pairs)),
raw_tokens AS (
  SELECT tid, unnest(regexp_extract_all(txt, '{pattern}')) AS tok, generate_subscripts(regexp_extract_all(txt, '{pattern}'), 1) AS k
  FROM code_texts),
code_toks AS (
  SELECT tid, tok, row_number() OVER (PARTITION BY tid ORDER BY k) AS pos, count(*) OVER (PARTITION BY tid) AS n,
         CASE WHEN tok IN ('(', '[', '{{') THEN 1 ELSE 0 END AS opens, CASE WHEN tok IN (')', ']', '}}') THEN 1 ELSE 0 END AS closes,
         CASE WHEN length(tok) > 1 AND (starts_with(tok, '"') OR starts_with(tok, '''')) THEN 's'
              WHEN tok IN ({words}) THEN tok WHEN regexp_matches(tok, '^[A-Za-z_]') THEN 'v'
              WHEN regexp_matches(tok, '^[0-9]') THEN '0' ELSE tok END AS shape
  FROM raw_tokens WHERE NOT (tok <> '//=' AND (starts_with(tok, '//') OR starts_with(tok, '/*')))),
leveled AS (
  SELECT *, sum(opens - closes) OVER (PARTITION BY tid ORDER BY pos) + closes AS level,
         lag(tok) OVER w AS prev1, lag(tok, 2) OVER w AS prev2, lag(tok, 3) OVER w AS prev3, lead(tok) OVER w AS next1
  FROM code_toks WINDOW w AS (PARTITION BY tid ORDER BY pos)),
tk AS MATERIALIZED (
  SELECT *, level - greatest(opens, closes) AS base,
         coalesce(min(CASE WHEN closes = 1 THEN pos END) OVER (PARTITION BY tid, level ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), n + 1) AS partner,
         max(CASE WHEN opens = 1 THEN pos END) OVER (PARTITION BY tid, level ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opener,
         min(CASE WHEN tok IN (';', '}}', chr(10)) THEN pos END) OVER (PARTITION BY tid, level - greatest(opens, closes) ORDER BY pos
             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stmt_stop
  FROM leveled),
closers AS (SELECT tid, level AS at_level, pos AS close_pos FROM tk WHERE closes = 1),
stmts AS (
  SELECT s.tid, s.pos AS a, least(coalesce(s.stmt_stop, s.n), s.n, coalesce(c.close_pos - 1, s.n)) AS b
  FROM (SELECT * FROM tk WHERE closes = 0 AND tok NOT IN (';', chr(10)) AND (prev1 IS NULL OR prev1 IN (';', '{{', '}}', chr(10)))) s
  ASOF LEFT JOIN closers c ON s.tid = c.tid AND s.base = c.at_level AND s.pos < c.close_pos),
shapes AS (SELECT tid, list(shape ORDER BY pos) AS shapes FROM code_toks GROUP BY tid),
trees AS (
  SELECT tid, array_to_string(shapes[a:b], ' ') AS item, count(*) AS k
  FROM (SELECT tid, pos AS a, partner AS b FROM tk WHERE opens = 1 AND partner <= n UNION ALL SELECT tid, a, b FROM stmts)
  JOIN shapes USING (tid) GROUP BY ALL),
named AS (
  SELECT t.*, coalesce(t.next1 = '[' AND x.partner <= t.n, false) AS indexed,
         CASE WHEN t.next1 = '[' AND x.partner <= t.n THEN x.partner + 1 ELSE t.pos + 1 END AS op
  FROM tk t LEFT JOIN tk x ON x.tid = t.tid AND x.pos = t.pos + 1
  WHERE {name('t.tok')} AND coalesce(t.next1, '') <> '(' AND coalesce(t.prev1, '') NOT IN ('.', '->', '::')),
with_context AS (
  SELECT v.*, coalesce(b.tok, '') AS behind, coalesce(o.tok, '') AS kind, o.partner AS closed, o.base AS obase,
         CASE WHEN o.partner <= v.n AND body.tok = '{{' THEN body.partner END AS body_end,
         coalesce({name('f.tok')}, false) AS after_name
  FROM named v LEFT JOIN tk b ON b.tid = v.tid AND b.pos = v.op
  LEFT JOIN tk o ON o.tid = v.tid AND o.pos = v.opener
  LEFT JOIN tk body ON body.tid = v.tid AND body.pos = o.partner + 1
  LEFT JOIN tk f ON f.tid = v.tid AND f.pos = v.opener - 1),
judged AS (
  SELECT *, behind IN ({assigns}) AS assign, coalesce(next1 IN ('++', '--'), false) OR coalesce(prev1 IN ('++', '--'), false) AS step,
         CASE WHEN prev1 IN ('*', '&') THEN prev2 ELSE prev1 END AS declarer, coalesce(prev1 IN ('*', '&'), false) AS far,
         CASE WHEN prev1 IN ('*', '&') THEN prev3 ELSE prev2 END AS guard
  FROM with_context),
declaring AS (
  SELECT *, (guard IS NULL OR guard IN {starts} OR (guard = ',' AND kind = '(')) AS first,
         coalesce(prev1 = 'for' AND behind IN ('in', 'of'), false) AS loop,
         kind = '(' AND body_end IS NOT NULL AND after_name AND behind IN (',', ')') AND NOT assign AS param
  FROM judged),
vars AS (
  SELECT d.*,
         coalesce(declarer IN ({declarers}) AND (first OR guard IN ({words})) AND (behind IN (';', ',', ')', ':', chr(10), 'in', 'of') OR assign), false)
         OR coalesce({name('declarer')} AND (NOT far OR first) AND behind IN ('=', ':='), false) OR loop OR param AS declares,
         CASE WHEN kind = '{{' THEN closed WHEN kind = '(' AND body_end IS NOT NULL THEN body_end
              WHEN kind = '' THEN n + 1 ELSE coalesce(c.close_pos, n + 1) END AS scope
  FROM declaring d ASOF LEFT JOIN closers c ON d.tid = c.tid AND d.obase = c.at_level AND d.closed < c.close_pos),
value_ends AS (SELECT tid, level AS at_level, pos AS end_pos FROM tk WHERE closes = 1 OR tok IN (';', ',', chr(10))),
effects AS MATERIALIZED (
  SELECT v.*, CASE WHEN assign THEN coalesce(e.end_pos, n + 1) ELSE pos END AS effect,
         (declares OR assign OR step) AS defines, (declares OR (behind IN ('=', ':=') AND NOT indexed)) AND NOT step AS pure
  FROM vars v ASOF LEFT JOIN value_ends e ON v.tid = e.tid AND v.level = e.at_level AND v.op < e.end_pos),
owners AS (
  SELECT u.tid, u.pos, coalesce(max(d.pos), 0) AS owner FROM effects u LEFT JOIN effects d
    ON d.tid = u.tid AND d.tok = u.tok AND d.declares AND NOT u.declares AND d.pos < u.pos AND u.pos <= d.scope GROUP BY u.tid, u.pos),
bound AS (
  SELECT e.*, CASE WHEN declares THEN pos ELSE owner END AS owner FROM effects e JOIN owners USING (tid, pos)),
numbered AS (
  SELECT *, min(pos) OVER (PARTITION BY tid, tok, owner) AS first_pos FROM bound),
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY tid ORDER BY first_pos) AS v FROM numbered),
ordered_defs AS MATERIALIZED (
  SELECT tid, pos, v, effect, op, assign, row_number() OVER (PARTITION BY tid, v ORDER BY effect, pos) AS ordinal FROM ranked WHERE defines),
uses AS (
  SELECT u.tid, u.pos, u.v, count(d.pos) AS reached FROM ranked u LEFT JOIN ordered_defs d
    ON d.tid = u.tid AND d.v = u.v AND d.effect < u.pos WHERE NOT u.pure GROUP BY u.tid, u.pos, u.v),
into_defs AS (
  SELECT u.tid, u.pos, u.v, u.reached, arg_max(d.v, d.op) AS target, arg_max(d.ordinal, d.op) AS ordinal
  FROM uses u JOIN ordered_defs d ON d.tid = u.tid AND d.assign AND d.op < u.pos AND u.pos < d.effect GROUP BY u.tid, u.pos, u.v, u.reached),
edges AS (
  SELECT tid, item, count(*) AS k FROM (
    SELECT tid, v || '#' || reached AS item FROM uses WHERE reached > 0
    UNION ALL SELECT tid, target || '#' || ordinal || '<' || v || '#' || reached FROM into_defs) GROUP BY ALL),
code_words AS (SELECT tid, list_filter(regexp_split_to_array(trim(txt, ' ' || chr(9) || chr(10) || chr(13)), '\s+'), lambda x: x <> '') AS w FROM code_texts),
word_grams AS (
  SELECT tid, g AS part, item, count(*) AS k FROM (
    SELECT tid, g, unnest(list_transform(range(1, len(w) - g + 2), lambda i: array_to_string(w[i:i + g - 1], chr(1)))) AS item
    FROM code_words, range(1, 5) s(g)) GROUP BY ALL),
word_keys AS (SELECT tid, item, k FROM word_grams WHERE part = 1 AND item IN ({words})),
items AS MATERIALIZED (
  SELECT tid, 'g' || part AS part, item, k FROM word_grams UNION ALL SELECT tid, 'keys', item, k FROM word_keys
  UNION ALL SELECT tid, 'trees', item, k FROM trees UNION ALL SELECT tid, 'edges', item, k FROM edges),
pair_ids AS (
  SELECT DISTINCT r.tid AS r, p.tid AS p FROM code_pairs c
  JOIN code_texts r ON r.txt = coalesce(c.ref, '') JOIN code_texts p ON p.txt = coalesce(c.pred, '')),
part_names AS (SELECT unnest(['g1', 'g2', 'g3', 'g4', 'keys', 'trees', 'edges']) AS part),
sizes AS (SELECT tid, part, sum(k) AS size FROM items GROUP BY ALL),
pair_items AS MATERIALIZED (SELECT q.r, q.p, a.part, a.item, a.k FROM pair_ids q JOIN items a ON a.tid = q.r),
shared AS (
  SELECT a.r, a.p, a.part, sum(least(a.k, b.k)) AS hits
  FROM pair_items a JOIN items b ON b.tid = a.p AND b.part = a.part AND b.item = a.item GROUP BY ALL),
wide AS (
  SELECT q.r, q.p, max(len(rw.w)) AS nr, max(len(pw.w)) AS np,
         map_from_entries(list((x.part, coalesce(h.hits, 0)::DOUBLE))) AS hit, map_from_entries(list((x.part, coalesce(s.size, 0)::DOUBLE))) AS size
  FROM pair_ids q CROSS JOIN part_names x JOIN code_words rw ON rw.tid = q.r JOIN code_words pw ON pw.tid = q.p
  LEFT JOIN shared h ON h.r = q.r AND h.p = q.p AND h.part = x.part LEFT JOIN sizes s ON s.tid = q.r AND s.part = x.part GROUP BY q.r, q.p),
bleu_parts AS (
  SELECT *, CASE WHEN np > nr THEN 1.0::DOUBLE WHEN np = 0 THEN 0.0::DOUBLE ELSE exp(1 - nr / np::DOUBLE) END AS brevity,
         list_transform([1, 2, 3, 4], lambda g: CASE WHEN hit['g' || g] = 0 THEN 0.1::DOUBLE ELSE hit['g' || g] END) AS smooth,
         0.2::DOUBLE * hit['g1'] + 0.8::DOUBLE * hit['keys'] AS key_hits, 0.2::DOUBLE * nr + 0.8::DOUBLE * size['keys'] AS key_total
  FROM wide),
pair_scores AS (
  SELECT r, p, size['trees'] > 0 AND size['edges'] > 0 AS valid,
         0.1::DOUBLE * CASE WHEN hit['g1'] = 0 THEN 0 ELSE brevity * exp(list_sum(list_transform([1, 2, 3, 4],
               lambda g: 0.25::DOUBLE * ln(smooth[g] / greatest(np - g + 1, 1))))) END
         + 0.1::DOUBLE * CASE WHEN key_hits = 0 THEN 0 ELSE brevity * exp(0.25::DOUBLE * ln(key_hits / key_total) + list_sum(list_transform([2, 3, 4],
               lambda g: 0.25::DOUBLE * ln(smooth[g] / greatest(nr - g + 1, 1))))) END
         + 0.4::DOUBLE * CASE WHEN size['trees'] = 0 THEN 0 ELSE hit['trees'] / size['trees'] END
         + 0.4::DOUBLE * CASE WHEN size['edges'] = 0 THEN 0 ELSE hit['edges'] / size['edges'] END AS score
  FROM bleu_parts),
code_scores AS (
  SELECT c.example_id, c.candidate, s.valid, CASE WHEN s.valid THEN s.score ELSE 0.0::DOUBLE END AS codebleu
  FROM code_pairs c JOIN code_texts r ON r.txt = coalesce(c.ref, '') JOIN code_texts p ON p.txt = coalesce(c.pred, '')
  JOIN pair_scores s ON s.r = r.tid AND s.p = p.tid)"""
