"""Sources, cleaning, splits and structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapweave.functions.metrics import CODEBLEU_LANGUAGES
from gapweave.functions.text import clean, collapse_blank_lines, leading_keyword, strip_comments, structures, trim_lines
from gapweave.operators import offside as O, structure as S
from gapweave.operators.splits import category_counts, split_exact, split_size_table, split_sizes
from gapweave.params import FimParams
from gapweave.plans.plugins import table_function
from gapweave.plans.preprocess import file_blocks, stratified_structures
from gapweave.queries import derive as D, sql as Q
from gapweave.queries.registry import query
from gapweave.sinks.writers import manifest
from gapweave.sources.files import decode_files, with_extension
from gapweave.sources.rules import built_in_rules
from gapweave.sources.tables import document_files, page_files

# ---------------------------------------------------------------- sources


@query("file_scan_ext", Q.with_(Q.FILES) + "SELECT file_id, path, '.' || lang AS ext FROM files WHERE lang IN ('de','fr')")
def file_scan_ext(spark, folder):
    return with_extension(document_files(spark, folder), [".de", ".fr"]).select("file_id", "path", "ext")


@query(
    "utf8_quarantine",
    """SELECT doc_id AS file_id, NOT starts_with(md5('damage:0:' || doc_id::VARCHAR), 'f') AS valid,
       CASE WHEN NOT starts_with(md5('damage:0:' || doc_id::VARCHAR), 'f') THEN md5(text) END AS text_md5 FROM documents""",
)
def utf8_quarantine(spark, folder):
    decoded = decode_files(D.damaged_files(spark, folder))
    return decoded.select("file_id", F.col("text").isNotNull().alias("valid"), F.md5("text").alias("text_md5"))


@query(
    "split_manifest",
    Q.with_(Q.FILES, Q.ASSIGNED)
    + """SELECT split, path, '{"split":"' || split || '","path":"' || path || '"}' AS line FROM assigned""",
)
def split_manifest(spark, folder):
    return manifest(split_exact(document_files(spark, folder), ["file_id"]))


@query(
    "language_rules",
    """SELECT DISTINCT lang AS language, 'block_types' AS role, 'paragraph' AS node_type FROM documents
       UNION ALL SELECT DISTINCT lang, 'subblock_types', 'sentence' FROM documents""",
)
def language_rules(spark, folder):
    """The prose rules for every language that occurs in the table."""
    languages = document_files(spark, folder).select(F.col("lang").alias("language")).distinct()
    prose = built_in_rules(spark).where(F.col("language") == "prose").drop("language")
    keyed = prose.withColumn("scanner", F.lit("prose"))
    by_scanner = languages.withColumn("scanner", F.lit("prose")).join(F.broadcast(keyed), "scanner")
    return by_scanner.select("language", "role", "node_type")


@query(
    "language_supported",
    """SELECT l AS language, count(*) AS n, l IN ('python','java','javascript','c','cpp','go','php','ruby','rust') AS supported
       FROM (SELECT ['python','java','swift','c','vhdl','go','mojo','ruby','iec61131_3_st','rust']
                    [(('0x' || substr(md5('language:0:' || doc_id::VARCHAR), 1, 8))::BIGINT % 10) + 1] AS l FROM documents)
       GROUP BY l""",
)
def language_supported(spark, folder):
    names = ["python", "java", "swift", "c", "vhdl", "go", "mojo", "ruby", "iec61131_3_st", "rust"]
    pick = D.draw_below(D.shuffle_key("language", 0, F.col("file_id")), F.lit(len(names))).cast("int")
    language = F.get(F.array(*[F.lit(n) for n in names]), pick).alias("language")
    counts = document_files(spark, folder).groupBy(language).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("supported", F.col("language").isin(list(CODEBLEU_LANGUAGES)))


# ---------------------------------------------------------------- cleaning


@query("clean_text", Q.with_(D.STRUCTURED_SQL, D.CLEAN_SQL) + "SELECT file_id, text AS cleaned FROM cleaned")
def clean_text(spark, folder):
    return D.structured_files(spark, folder).select("file_id", clean(F.col("text")).alias("cleaned"))


@query(
    "strip_comments",
    Q.with_(D.STRUCTURED_SQL)
    + r"""SELECT file_id, regexp_replace(regexp_replace(text, '(?s)\(\*.*?\*\)', '', 'g'), '//[^\n]*', '', 'g') AS stripped
          FROM structured""",
)
def strip_comments_query(spark, folder):
    return D.structured_files(spark, folder).select("file_id", strip_comments(F.col("text")).alias("stripped"))


@query(
    "collapse_blank_lines",
    Q.with_(
        D.STRUCTURED_SQL,
        r"""trimmed AS (
  SELECT file_id, line_no, regexp_replace(line, '\s+$', '') AS line FROM (
    SELECT file_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
    FROM structured)),
marked AS (
  SELECT *, lag(line) OVER (PARTITION BY file_id ORDER BY line_no) AS previous FROM trimmed),
kept AS (SELECT * FROM marked WHERE line <> '' OR coalesce(previous, '') <> '')""",
    )
    + r"""SELECT file_id, regexp_replace(string_agg(line, chr(10) ORDER BY line_no), '^\s+|\s+$', '', 'g') AS collapsed
          FROM kept GROUP BY file_id""",
)
def collapse_blank_lines_query(spark, folder):
    collapsed = collapse_blank_lines(trim_lines(F.col("text"))).alias("collapsed")
    return D.structured_files(spark, folder).select("file_id", collapsed)


STRUCTURE_RE = (
    r"(?is)\b(?:FUNCTION_BLOCK\b.*?\bEND_FUNCTION_BLOCK|FUNCTION\b.*?\bEND_FUNCTION|PROGRAM\b.*?\bEND_PROGRAM"
    r"|TYPE\b.*?\bEND_TYPE|CONFIGURATION\b.*?\bEND_CONFIGURATION|VAR_GLOBAL\b.*?\bEND_VAR|CLASS\b.*?\bEND_CLASS"
    r"|INTERFACE\b.*?\bEND_INTERFACE|NAMESPACE\b.*?\bEND_NAMESPACE|METHOD\b.*?\bEND_METHOD"
    r"|PROPERTY\b.*?\bEND_PROPERTY)"
)
STRUCTURES_SQL = f"""
structure_blocks AS (
  SELECT file_id, unnest(regexp_extract_all(text, '{STRUCTURE_RE}')) AS block,
         generate_subscripts(regexp_extract_all(text, '{STRUCTURE_RE}'), 1) - 1 AS block_no
  FROM cleaned),
categorized AS (
  SELECT *, upper(regexp_extract(block, '^\\s*(\\S+)', 1)) AS category FROM structure_blocks),
strata AS (
  SELECT *, row_number() OVER (PARTITION BY category
              ORDER BY md5('strata:0:' || file_id::VARCHAR || ':' || block_no::VARCHAR), file_id, block_no) AS ord,
         count(*) OVER (PARTITION BY category) AS n FROM categorized),
stratified AS (
  SELECT file_id, block_no::INTEGER AS block_no, block, category, ord,
         CASE WHEN ord <= floor(n * 0.8::DOUBLE) THEN 'train'
              WHEN ord <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'eval' ELSE 'test' END AS split
  FROM strata)""".replace("\\\\", "\\")
STRATIFIED = Q.with_(D.STRUCTURED_SQL, D.CLEAN_SQL, STRUCTURES_SQL)


@query("regex_blocks", STRATIFIED + "SELECT file_id, block_no::INTEGER AS block_no, block FROM structure_blocks")
def regex_blocks(spark, folder):
    found = structures(clean(F.col("text")))
    return D.structured_files(spark, folder).select("file_id", F.posexplode(found).alias("block_no", "block"))


@query(
    "block_category",
    STRATIFIED
    + "SELECT file_id, block_no::INTEGER AS block_no, category, strlen(block)::INTEGER AS n_bytes FROM categorized",
)
def block_category(spark, folder):
    blocks = regex_blocks(spark, folder)
    return blocks.select(
        "file_id", "block_no", leading_keyword(F.col("block")).alias("category"), F.octet_length("block").alias("n_bytes")
    )


# ---------------------------------------------------------------- splits


@query("split_exact", Q.with_(Q.FILES, Q.ASSIGNED) + "SELECT file_id, path, split FROM assigned")
def split_exact_query(spark, folder):
    return split_exact(document_files(spark, folder), ["file_id"]).select("file_id", "path", "split")


@query(
    "split_threshold",
    """SELECT doc_id AS file_id, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.9::DOUBLE THEN 'eval' ELSE 'test' END AS split
       FROM (SELECT doc_id, ('0x' || substr(md5('split:0:' || doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
             FROM documents)""",
)
def split_threshold(spark, folder):
    from gapweave.operators.splits import split_by_threshold

    return split_by_threshold(document_files(spark, folder), ["file_id"]).select("file_id", "split")


@query("split_stratified", STRATIFIED + "SELECT file_id, block_no, category, ord, split FROM stratified")
def split_stratified_query(spark, folder):
    return stratified_structures(D.structured_files(spark, folder)).select(
        "file_id", "block_no", "category", "ord", "split"
    )


@query(
    "split_category_counts",
    STRATIFIED
    + """SELECT category, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'eval') AS eval,
         count(*) FILTER (WHERE split = 'test') AS test, count(*) AS total FROM stratified GROUP BY category""",
)
def split_category_counts(spark, folder):
    return category_counts(stratified_structures(D.structured_files(spark, folder)), "category")


@query("split_block_text", STRATIFIED + "SELECT split, category, ord, block FROM stratified")
def split_block_text(spark, folder):
    """The rows the block writer puts into the split files, with their order."""
    return stratified_structures(D.structured_files(spark, folder)).select("split", "category", "ord", "block")


@query(
    "split_sizes",
    Q.with_(Q.FILES, Q.ASSIGNED)
    + "SELECT s.split, count(a.file_id) AS n FROM (VALUES ('train'),('eval'),('test')) s(split) "
    "LEFT JOIN assigned a ON a.split = s.split GROUP BY s.split",
)
def split_sizes_query(spark, folder):
    return split_sizes(split_exact(document_files(spark, folder), ["file_id"]))


@query(
    "split_sizes_by_language",
    Q.with_(Q.FILES, Q.ASSIGNED)
    + """, summed AS (
      SELECT lang, split, count(*) AS n, grouping(lang) AS a, grouping(split) AS b FROM assigned GROUP BY CUBE (lang, split))
    SELECT CASE WHEN a = 0 AND b = 0 THEN 'column, split' WHEN a = 0 THEN 'column' WHEN b = 0 THEN 'split' ELSE 'all' END AS level,
           lang, split, n, n / (CASE WHEN a = 0 AND b = 0 THEN (SELECT t.n FROM summed t WHERE t.a = 1 AND t.b = 0 AND t.split = s.split)
                                ELSE (SELECT t.n FROM summed t WHERE t.a = 1 AND t.b = 1) END)::DOUBLE AS share FROM summed s""",
)
def split_sizes_by_language(spark, folder):
    return split_size_table(split_exact(document_files(spark, folder), ["file_id"]), "lang")


# ---------------------------------------------------------------- structure

NODES = Q.with_(Q.FILES, Q.LINES)
PROSE_BLOCKS = Q.with_(Q.FILES, Q.LINES, Q.BLOCKS)


def prose_files(spark, folder):
    return S.with_nodes(document_files(spark, folder).select("file_id", "text", "content"), "prose")


@query("nodes_prose", NODES + "SELECT file_id, node_id, depth, type, start_byte, end_byte FROM nodes")
def nodes_prose(spark, folder):
    return S.explode_nodes(prose_files(spark, folder))


def _prose_parser():
    """The nodes of a text as a parser of one's own would give them; it travels by value."""
    sentence = S.SENTENCE

    def parse(text: str) -> list[tuple[int, str, int, int]]:
        import re

        out, at = [(1, "document", 0, len(text.encode()))], 0
        for line in text.split("\n"):
            size = len(line.encode())
            if line.strip():
                out.append((2, "paragraph", at, at + size))
                start = at
                for piece in re.findall(sentence, line):
                    out.append((3, "sentence", start, start + len(piece.rstrip().encode())))
                    start += len(piece.encode())
            at += size + 1
        return out

    return parse


@query("nodes_table_function", NODES + "SELECT file_id, node_id, depth, type, start_byte, end_byte FROM nodes")
def nodes_table_function(spark, folder):
    """A parser in Python, called from SQL on a table."""
    table_function(spark, "prose_parser_nodes", _prose_parser())
    document_files(spark, folder).select("file_id", "text").createOrReplaceTempView("prose_parser_files")
    return spark.sql(
        "SELECT file_id, node_id, depth, type, start_byte, end_byte FROM prose_parser_nodes(TABLE(prose_parser_files)) WHERE error IS NULL"
    )


BRACE_LEXEME = (
    r"""//[^\n]*|(?s:/\*.*?\*/)|"[^"\\\n]*(?:\\[^\n][^"\\\n]*)*"|''[^''\\\n]*(?:\\[^\n][^''\\\n]*)*''"""
    r"""|[{};()]|[^{};()/"'']+|[/"'']"""
)


def brace_sql(source: str) -> str:
    return (
        f"""
lexemes AS (
  SELECT file_id, unnest(regexp_extract_all(text, '{BRACE_LEXEME}')) AS token,
         generate_subscripts(regexp_extract_all(text, '{BRACE_LEXEME}'), 1) AS token_no FROM {source}),
placed AS (
  SELECT *, coalesce(sum(strlen(token)) OVER w, 0)::BIGINT AS pos,
         coalesce(sum(CASE token WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER w, 0) AS parens
  FROM lexemes WINDOW w AS (PARTITION BY file_id ORDER BY token_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
delims AS (
  SELECT file_id, token, pos,
         coalesce(sum(CASE token WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER w, 0) AS level,
         coalesce(lag(pos) OVER (PARTITION BY file_id ORDER BY pos) + 1, 0) AS since
  FROM placed WHERE token IN ('{{', '}}') OR (token = ';' AND parens <= 0)
  WINDOW w AS (PARTITION BY file_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
trimmed AS (
  SELECT d.*, d.pos - strlen(regexp_replace(decode(unhex(substr(hex(encode(f.text)), 2 * since + 1, 2 * (pos - since)))), '^(?:\\s+|//[^\\n]*|#[^\\n]*|(?s:/\\*.*?\\*/))*', '')) AS first
  FROM delims d JOIN {source} f USING (file_id)),
braces AS (
  SELECT *, level + CASE token WHEN '{{' THEN 1 ELSE 0 END AS pair_level FROM trimmed WHERE token <> ';'),
paired AS (
  SELECT *, lead(token) OVER w AS next_token, lead(pos) OVER w AS close_at
  FROM braces WINDOW w AS (PARTITION BY file_id, pair_level ORDER BY pos)),
bodies AS (
  SELECT file_id, pos, first, close_at + 1 AS end_byte, greatest(pair_level, 1) AS pair_level
  FROM paired WHERE token = '{{' AND next_token = '}}'),
brace_rows AS (
  SELECT file_id, 1 AS depth, 'file' AS type, 0::BIGINT AS start_byte, strlen(text)::BIGINT AS end_byte FROM {source}
  UNION ALL SELECT file_id, 2 * pair_level, 'definition', first, end_byte FROM bodies WHERE first < pos
  UNION ALL SELECT file_id, 2 * pair_level + 1, 'body', pos, end_byte FROM bodies
  UNION ALL SELECT file_id, 2 * greatest(level, 0) + 2, 'statement', first, pos + 1 FROM trimmed WHERE token = ';'),
brace_nodes AS (
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY start_byte, depth) - 1 AS node_id,
         depth::INTEGER AS depth, type, start_byte, end_byte FROM brace_rows)"""
    )


BRACE_COLUMNS = "SELECT file_id, node_id, depth, type, start_byte, end_byte FROM brace_nodes"


@query("nodes_brace", Q.with_(D.BRACED_SQL, brace_sql("braced")) + BRACE_COLUMNS)
def nodes_brace(spark, folder):
    return S.explode_nodes(S.with_nodes(D.braced_files(spark, folder), "brace"))


@query(
    "nodes_brace_pages",
    Q.with_("raw AS (SELECT page_id AS file_id, html AS text FROM pages)", brace_sql("raw")) + BRACE_COLUMNS,
)
def nodes_brace_pages(spark, folder):
    return S.explode_nodes(S.with_nodes(page_files(spark, folder), "brace"))


def indent_sql(source: str) -> str:
    lexeme = O.LEXEME.replace("'", "''")
    word, assignment = O.HEAD_WORD.replace("'", "''"), O.ASSIGNMENT.replace("'", "''")
    kinds = " ".join(f"WHEN '{w}' THEN '{kind}'" for w, kind in O.LINE_TYPES.items())
    return rf"""
indent_lexemes AS (
  SELECT file_id, unnest(regexp_extract_all(text, '{lexeme}')) AS token, generate_subscripts(regexp_extract_all(text, '{lexeme}'), 1) AS k
  FROM {source}),
indent_breaks AS (
  SELECT file_id, token, pos FROM (
    SELECT file_id, token, coalesce(sum(strlen(token)) OVER w, 0)::BIGINT AS pos,
           coalesce(sum(CASE WHEN token IN ('(', '[', '{{') THEN 1 WHEN token IN (')', ']', '}}') THEN -1 ELSE 0 END) OVER w, 0) AS open
    FROM indent_lexemes WINDOW w AS (PARTITION BY file_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE token = chr(10) AND open <= 0
  UNION ALL SELECT file_id, NULL, strlen(text) FROM {source}),
indent_pieces AS (
  SELECT b.file_id, b.start, decode(unhex(substr(hex(encode(f.text)), 2 * b.start + 1, 2 * (b.pos - b.start)))) AS piece
  FROM (SELECT file_id, pos, coalesce(lag(pos) OVER (PARTITION BY file_id ORDER BY pos, token NULLS LAST) + 1, 0) AS start FROM indent_breaks) b
  JOIN {source} f USING (file_id)),
indent_lines AS (
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY start) AS i, strlen(lead) + 7 * (strlen(lead) - strlen(replace(lead, chr(9), ''))) AS indent,
         start + strlen(lead) AS s, start + strlen(lead) + strlen(code) AS e, code
  FROM (SELECT file_id, start, regexp_extract(piece, '^[ 	]*') AS lead,
               regexp_replace(substr(piece, length(regexp_extract(piece, '^[ 	]*')) + 1), '\s+$', '') AS code FROM indent_pieces)
  WHERE code <> '' AND NOT starts_with(code, '#')),
indent_blocks AS (
  SELECT x.*, (SELECT coalesce(min(y.i), 1000000000) FROM indent_lines y WHERE y.file_id = x.file_id AND y.i > x.i AND y.indent <= x.indent) AS next_i
  FROM indent_lines x),
indent_placed AS (
  SELECT x.*, (SELECT count(*) FROM indent_blocks y WHERE y.file_id = x.file_id AND y.i < x.i AND y.next_i > x.i) AS level,
         (SELECT max(y.e) FROM indent_lines y WHERE y.file_id = x.file_id AND y.i >= x.i AND y.i < x.next_i) AS block_end,
         (SELECT min(y.s) FROM indent_lines y WHERE y.file_id = x.file_id AND y.i > x.i AND y.i < x.next_i) AS child
  FROM indent_blocks x),
indent_rows AS (
  SELECT file_id, 1 AS depth, 'file' AS type, 0::BIGINT AS start_byte, strlen(text)::BIGINT AS end_byte FROM {source}
  UNION ALL SELECT file_id, 2 * level + 2, CASE regexp_extract(code, '{word}', 1) {kinds} ELSE
       CASE WHEN regexp_matches(code, '{assignment}') THEN 'assignment' WHEN starts_with(code, '@') THEN 'decorator' ELSE 'expression_statement' END END, s, block_end
       FROM indent_placed
  UNION ALL SELECT file_id, 2 * level + 3, 'block', child, block_end FROM indent_placed WHERE child IS NOT NULL),
indent_nodes AS (
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY start_byte, depth) - 1 AS node_id,
         depth::INTEGER AS depth, type, start_byte::BIGINT AS start_byte, end_byte::BIGINT AS end_byte FROM indent_rows)"""


@query(
    "nodes_indent",
    Q.with_(D.INDENTED_SQL, indent_sql("indented")) + "SELECT file_id, node_id, depth, type, start_byte, end_byte FROM indent_nodes",
)
def nodes_indent(spark, folder):
    return S.explode_nodes(S.with_nodes(D.indented_files(spark, folder), "indent"))


@query(
    "blocks_indent",
    Q.with_(D.INDENTED_SQL, indent_sql("indented"))
    + """SELECT b.file_id, b.node_id AS block_id, b.depth, b.start_byte, b.end_byte, b.type,
         md5(decode(unhex(substr(hex(encode(f.text)), 2 * b.start_byte + 1, 2 * (b.end_byte - b.start_byte))))) AS code_md5,
         count(n.node_id) AS n_subblocks
         FROM indent_nodes b JOIN indented f USING (file_id) LEFT JOIN indent_nodes n ON n.file_id = b.file_id AND n.node_id >= b.node_id
           AND n.start_byte >= b.start_byte AND n.end_byte <= b.end_byte AND n.type IN ('block', 'assignment', 'expression_statement',
             'if_statement', 'while_statement', 'for_statement', 'match_statement', 'case_clause', 'return_statement', 'try_statement',
             'except_clause', 'finally_clause', 'with_statement', 'yield')
         WHERE b.type IN ('function_definition', 'class_definition') AND b.depth <= 4 GROUP BY ALL""",
)
def blocks_indent(spark, folder):
    """Classes and their functions: a function repeats part of its class's text."""
    blocks = file_blocks(D.indented_files(spark, folder), "indent", FimParams(max_code_blocks_ast_depth=4))
    return blocks.select(
        "file_id", "block_id", "depth", "start_byte", "end_byte", "type", F.md5("code").alias("code_md5"),
        F.size("subblocks").cast("bigint").alias("n_subblocks"),
    )


@query(
    "nodes_keyword",
    Q.with_(
        D.STRUCTURED_SQL,
        D.CLEAN_SQL,
        STRUCTURES_SQL,
        f"""gaps AS (
  SELECT file_id, unnest(string_split_regex(text, '{STRUCTURE_RE}')) AS gap,
         generate_subscripts(string_split_regex(text, '{STRUCTURE_RE}'), 1) - 1 AS block_no FROM cleaned),
tiles AS (
  SELECT file_id, block_no, block, category, strlen(gap) + coalesce(sum(strlen(gap) + strlen(block)) OVER (
           PARTITION BY file_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM gaps JOIN categorized USING (file_id, block_no)),
block_lines AS (
  SELECT file_id, block_no, pos, unnest(string_split(block, chr(10))) AS line,
         generate_subscripts(string_split(block, chr(10)), 1) AS line_no FROM tiles),
placed_lines AS (
  SELECT *, pos + coalesce(sum(strlen(line) + 1) OVER (PARTITION BY file_id, block_no ORDER BY line_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_at FROM block_lines),
keyword_rows AS (
  SELECT file_id, 1 AS depth, 'file' AS type, 0::BIGINT AS start_byte, strlen(text)::BIGINT AS end_byte FROM cleaned
  UNION ALL SELECT file_id, 2, lower(category) || '_declaration', pos, pos + strlen(block) FROM tiles
  UNION ALL SELECT file_id, 3, 'statement', line_at + strlen(line) - strlen(ltrim(line)), line_at + strlen(rtrim(line))
            FROM placed_lines WHERE ends_with(rtrim(line), ';'))""",
    )
    + """SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY start_byte, depth) - 1 AS node_id,
         depth, type, start_byte, end_byte FROM keyword_rows""",
)
def nodes_keyword(spark, folder):
    cleaned = D.structured_files(spark, folder).select("file_id", clean(F.col("text")).alias("text"))
    return S.explode_nodes(S.with_nodes(cleaned, "keyword"))


@query(
    "blocks_by_depth",
    PROSE_BLOCKS
    + """SELECT b.file_id, b.block_id, b.start_byte, b.end_byte, md5(b.code) AS code_md5, count(s.sub_id) AS n_subblocks
         FROM blocks b LEFT JOIN subs s USING (file_id, block_id) GROUP BY ALL""",
)
def blocks_by_depth(spark, folder):
    blocks = file_blocks(document_files(spark, folder), "prose", FimParams(max_code_blocks_ast_depth=2))
    return blocks.select(
        "file_id",
        "block_id",
        "start_byte",
        "end_byte",
        F.md5("code").alias("code_md5"),
        F.size("subblocks").cast("bigint").alias("n_subblocks"),
    )


def _brace_blocks_sql() -> str:
    return Q.with_(
        D.BRACED_SQL,
        brace_sql("braced"),
        """nested AS (SELECT * FROM brace_nodes WHERE type = 'definition' AND depth <= 4)""",
    )


@query(
    "blocks_nested",
    _brace_blocks_sql()
    + """SELECT b.file_id, b.node_id AS block_id, b.depth, b.start_byte, b.end_byte,
         md5(decode(unhex(substr(hex(encode(f.text)), 2 * b.start_byte + 1, 2 * (b.end_byte - b.start_byte))))) AS code_md5,
         (SELECT count(*) FROM brace_nodes n WHERE n.file_id = b.file_id AND n.node_id >= b.node_id
            AND n.start_byte >= b.start_byte AND n.end_byte <= b.end_byte AND n.type IN ('body','statement')) AS n_subblocks
         FROM nested b JOIN braced f USING (file_id)""",
)
def blocks_nested(spark, folder):
    """Definitions down to depth 4: a loop inside a function repeats part of the function's text."""
    blocks = file_blocks(D.braced_files(spark, folder), "brace", FimParams(max_code_blocks_ast_depth=4))
    return blocks.select(
        "file_id",
        "block_id",
        "depth",
        "start_byte",
        "end_byte",
        F.md5("code").alias("code_md5"),
        F.size("subblocks").cast("bigint").alias("n_subblocks"),
    )


@query(
    "subblocks",
    PROSE_BLOCKS + "SELECT file_id, block_id, sub_id, sub_type, rel_start, rel_end FROM subs",
)
def subblocks(spark, folder):
    """Containment join on a node table, with the rule table deciding the types."""
    rules = built_in_rules(spark)
    nodes = S.explode_nodes(prose_files(spark, folder))
    blocks = S.select_by_rules(nodes, rules, "block_types", "prose").where(F.col("depth") <= 2)
    return S.contained(blocks, S.select_by_rules(nodes, rules, "subblock_types", "prose"))


@query(
    "node_table_blocks",
    NODES
    + """SELECT n.file_id, n.node_id AS block_id, n.depth, md5(decode(unhex(substr(hex(encode(f.text)), 2 * n.start_byte + 1,
         2 * (n.end_byte - n.start_byte))))) AS code_md5 FROM nodes n JOIN files f USING (file_id) WHERE n.type = 'paragraph'""",
)
def node_table_blocks(spark, folder):
    """Block bytes for a node table that is joined back to its files."""
    nodes = S.explode_nodes(prose_files(spark, folder))
    blocks = S.select_by_rules(nodes, built_in_rules(spark), "block_types", "prose")
    cut = S.blocks_from_node_table(document_files(spark, folder), blocks)
    return cut.select("file_id", "block_id", "depth", F.md5("code").alias("code_md5"))


@query(
    "subblocks_end_limit",
    PROSE_BLOCKS
    + "SELECT file_id, block_id, sub_id, rel_end FROM subs WHERE rel_end <= floor(256 * 1.5::DOUBLE)",
)
def subblocks_end_limit(spark, folder):
    from gapweave.operators.fim import within_end_limit

    blocks = file_blocks(document_files(spark, folder), "prose", FimParams())
    kept = within_end_limit(F.col("subblocks"), 256, F.lit(1.5))
    return blocks.select("file_id", "block_id", F.explode(kept).alias("s")).select(
        "file_id", "block_id", F.col("s.sub_id").alias("sub_id"), F.col("s.rel_end").alias("rel_end")
    )


@query(
    "node_listing",
    NODES
    + """SELECT n.file_id, n.node_id, n.depth, n.type, n.start_byte, replace(substr(string_split(decode(unhex(substr(
         hex(encode(f.text)), 2 * n.start_byte + 1, 2 * (n.end_byte - n.start_byte)))), chr(10))[1], 1, 60), chr(9), ' ') AS snippet
         FROM nodes n JOIN files f USING (file_id)""",
)
def node_listing_query(spark, folder):
    return S.node_listing(prose_files(spark, folder), "content")
