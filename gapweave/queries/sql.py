"""Shared pieces of the oracle SQL (DuckDB dialect)."""

from __future__ import annotations

SENTENCE = r"[^.!?]+[.!?]*\s*|[.!?]+\s*"
WORD = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"

FILES = """
files AS (SELECT doc_id AS file_id, source || '/' || doc_id::VARCHAR || '.' || lang AS path, lang, text FROM documents)
"""

ASSIGNED = """
ranked_files AS (
  SELECT *, row_number() OVER (ORDER BY md5('split:0:' || file_id::VARCHAR), file_id) AS r, count(*) OVER () AS n FROM files),
assigned AS (
  SELECT file_id, path, lang, text, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train'
              WHEN r <= floor(n * 0.9::DOUBLE) THEN 'eval' ELSE 'test' END AS split
  FROM ranked_files)
"""

LINES = """
file_lines AS (
  SELECT file_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM files),
paragraphs AS (
  SELECT * FROM (
    SELECT file_id, line_no, line, coalesce(sum(strlen(line) + 1) OVER (PARTITION BY file_id ORDER BY line_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_byte
    FROM file_lines)
  WHERE regexp_matches(line, '\\S')),
pieces AS (
  SELECT file_id, line_no, start_byte, unnest(regexp_extract_all(line, '{s}')) AS piece,
         generate_subscripts(regexp_extract_all(line, '{s}'), 1) AS piece_no
  FROM paragraphs),
sentences AS (
  SELECT file_id, line_no, start_byte + coalesce(sum(strlen(piece)) OVER (PARTITION BY file_id, line_no ORDER BY piece_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_byte,
         strlen(regexp_replace(piece, '\\s+$', '')) AS n_bytes
  FROM pieces),
node_rows AS (
  SELECT file_id, 1 AS depth, 'document' AS type, 0::BIGINT AS start_byte, strlen(text)::BIGINT AS end_byte FROM files
  UNION ALL SELECT file_id, 2, 'paragraph', start_byte, start_byte + strlen(line) FROM paragraphs
  UNION ALL SELECT file_id, 3, 'sentence', start_byte, start_byte + n_bytes FROM sentences),
nodes AS (
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY start_byte, depth) - 1 AS node_id,
         depth, type, start_byte, end_byte FROM node_rows)
""".replace("{s}", SENTENCE).replace("\\\\", "\\")

BLOCKS = """
blocks AS (
  SELECT n.file_id, n.node_id AS block_id, n.start_byte, n.end_byte, p.line AS code
  FROM nodes n JOIN paragraphs p ON p.file_id = n.file_id AND p.start_byte = n.start_byte
  WHERE n.type = 'paragraph' AND n.depth <= 2),
subs AS (
  SELECT b.file_id, b.block_id, b.code, n.node_id AS sub_id, n.type AS sub_type,
         n.start_byte - b.start_byte AS rel_start, n.end_byte - b.start_byte AS rel_end
  FROM blocks b JOIN nodes n ON n.file_id = b.file_id AND n.node_id >= b.block_id
       AND n.start_byte >= b.start_byte AND n.end_byte <= b.end_byte
  WHERE n.type = 'sentence')
"""


def fim(max_len: int, low: int, high: int, share: float, ratio: str = "1.0::DOUBLE") -> str:
    """Sub-block sample and the three parts; parts are cut on the hex form, two digits a byte."""
    return f"""
limited AS (SELECT * FROM subs WHERE rel_end <= floor({max_len} * {ratio})),
sampled AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY file_id, block_id
                ORDER BY md5('pick:0:' || file_id::VARCHAR || ':' || block_id::VARCHAR || ':' || sub_id::VARCHAR)) AS pick,
           count(*) OVER (PARTITION BY file_id, block_id) AS n_subs
    FROM limited)
  WHERE pick <= greatest(1, floor(n_subs * {share}::DOUBLE))),
in_range AS (
  SELECT *, hex(encode(code)) AS h FROM sampled WHERE (rel_end - rel_start) / {ratio} BETWEEN {low} AND {high}),
examples AS (
  SELECT file_id, block_id, sub_id,
         decode(unhex(substr(h, 1, 2 * rel_start))) AS prefix,
         decode(unhex(substr(h, 2 * rel_start + 1, 2 * (rel_end - rel_start)))) AS middle,
         decode(unhex(substr(h, 2 * rel_end + 1))) AS suffix
  FROM in_range)"""


def ids_of(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::INTEGER)"


def tokenized(max_len: int, low: int, high: int) -> str:
    return f"""
id_rows AS (
  SELECT file_id, block_id, sub_id, list_concat([256], {ids_of('prefix')}, [258], {ids_of('suffix')},
         [257], {ids_of('middle')}, [260]) AS ids FROM examples),
tokenized AS (
  SELECT t.file_id, a.split, block_id, sub_id, ids FROM id_rows t JOIN assigned a USING (file_id)
  WHERE len(ids) <= {max_len} AND len(ids) - list_position(ids, 257) - 1 BETWEEN {low} AND {high})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
