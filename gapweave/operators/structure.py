"""Structural nodes, blocks and sub-blocks.

A scanner gives the SQL expression from a text column to ``array<struct<start_byte, depth, end_byte,
type>>`` in pre-order (root first, depth 1), with byte offsets.  Scanners, block selection
and sub-block selection all work inside the file's row: no shuffle, and a file of any
share of the corpus is just one row.  ``explode_nodes`` gives the same as a table, and
``contained`` is the join for node tables that come from outside.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions import braces
from gapweave.functions.arrays import sums_before, tile_offsets
from gapweave.functions.sqltext import (
    index_range,
    keep,
    let,
    lit,
    lstrip,
    regexp_extract_all,
    regexp_replace,
    rstrip,
    transform,
    zip_with,
)
from gapweave.functions.text import FIRST_WORD, STRUCTURE_PATTERN
from gapweave.operators.offside import indent_nodes

NODE_TYPE = "array<struct<start_byte:bigint,depth:int,end_byte:bigint,type:string>>"

NON_BLANK = r"(?U)[^\s\x1c-\x1f]"
SENTENCE = r"[^.!?]+[.!?]*\s*|[.!?]+\s*"
LEADING_FILLER = r"\A(?:\s++|//[^\n]*+|#[^\n]*+|(?s:/\*.*?\*/))*+"
LEXEME = (
    r"//[^\n]*"
    r"|(?s:/\*.*?\*/)"
    r'|"[^"\\\n]*+(?:\\[^\n][^"\\\n]*+)*+"'
    r"|'[^'\\\n]*+(?:\\[^\n][^'\\\n]*+)*+'"
    r"|[{};()]"
    r"""|[^{};()/"']+"""
    r"""|[/"']"""
)


def _node(start: str, end: str, depth: str | int, kind: str) -> str:
    return (
        f"named_struct('start_byte', cast({start} as bigint), 'depth', cast({depth} as int), "
        f"'end_byte', cast({end} as bigint), 'type', {kind})"
    )


def _root(text: str, kind: str) -> str:
    return f"array({_node('0', f'octet_length({text})', 1, lit(kind))})"


def _present(items: str) -> str:
    return keep(items, lambda n: f"{n} is not null")


NO_NODES = f"cast(array() as {NODE_TYPE})"


# ---------------------------------------------------------------- scanners


def prose_nodes(text: str) -> str:
    """document > paragraph (non-blank line) > sentence.

    The sentence pieces tile the line; each is a sentence with the white space after it.
    """

    def paragraph(line: str, at: str) -> str:
        sentences = let(
            regexp_extract_all(line, SENTENCE),
            lambda ps: zip_with(
                ps,
                tile_offsets(ps),
                lambda p, o: _node(f"{at} + {o}", f"{at} + {o} + octet_length({rstrip(p)})", 3, "'sentence'"),
            ),
        )
        return f"concat(array({_node(at, f'{at} + octet_length({line})', 2, lit('paragraph'))}), {sentences})"

    def all_lines(ls: str) -> str:
        found = zip_with(
            ls,
            tile_offsets(ls, gap=1),
            lambda line, at: f"if({line} rlike {lit(NON_BLANK)}, {paragraph(line, at)}, {NO_NODES})",
        )
        return f"flatten({found})"

    newline = lit("\n")
    return f"concat({_root(text, 'document')}, {let(f'split({text}, {newline})', all_lines)})"


def keyword_nodes(text: str) -> str:
    """file > keyword structure > statement line (one that ends with a semicolon)."""
    newline = lit("\n")

    def statements(block: str, at: str) -> str:
        def statement(line: str, o: str) -> str:
            lead = f"octet_length({line}) - octet_length({lstrip(line)})"
            end = f"{at} + {o} + octet_length({rstrip(line)})"
            return f"if(endswith({rstrip(line)}, ';'), {_node(f'{at} + {o} + {lead}', end, 3, lit('statement'))}, null)"

        return let(f"split({block}, {newline})", lambda ls: _present(zip_with(ls, tile_offsets(ls, gap=1), statement)))

    def kind(block: str) -> str:
        first = f"regexp_extract({block}, {lit(FIRST_WORD)}, 1)"
        return f"concat(lower({first}), '_declaration')"

    def body(found: str) -> str:
        gaps = f"slice(split({text}, {lit(STRUCTURE_PATTERN)}), 1, size({found}))"
        tiles = zip_with(
            gaps,
            found,
            lambda g, b: f"named_struct('gap', octet_length({g}), "
            f"'length', octet_length({g}) + octet_length({b}), 'block', {b})",
        )

        def placed(ts: str) -> str:
            def nodes(t: str, o: str) -> str:
                return let(
                    f"{o} + {t}.gap",
                    lambda at: f"concat(array({_node(at, f'{o} + {t}.length', 2, kind(f'{t}.block'))}), "
                    f"{statements(f'{t}.block', at)})",
                )

            return f"flatten({zip_with(ts, sums_before(f'{ts}.length'), nodes)})"

        return let(tiles, placed)

    return f"concat({_root(text, 'file')}, {let(regexp_extract_all(text, STRUCTURE_PATTERN), body)})"


def _brace_nodes(text: str, raw: str) -> str:

    def delta(d: str, plus: str, minus: str) -> str:
        return f"case {d}.token when '{plus}' then 1 when '{minus}' then -1 else 0 end"

    def first_text_byte(start: str, end: str) -> str:
        """Position of the first byte in the range after white space, comments and directives."""
        piece = f"cast(substring({raw}, cast({start} + 1 as int), cast({end} - {start} as int)) as string)"
        return f"{end} - octet_length({regexp_replace(piece, LEADING_FILLER)})"

    def delimiters(tokens: str) -> str:
        placed = zip_with(tokens, tile_offsets(tokens), lambda t, o: f"named_struct('token', {t}, 'at', {o})")
        return keep(placed, lambda d: f"{d}.token in ('{{', '}}', ';', '(', ')')")

    def outside_parens(ds: str) -> str:
        nested = sums_before(transform(ds, lambda d: delta(d, "(", ")")))
        counts = lambda d, level: f"{d}.token in ('{{', '}}') or ({d}.token = ';' and {level} <= 0)"
        return _present(zip_with(ds, nested, lambda d, level: f"if({counts(d, level)}, {d}, null)"))

    def with_context(ds: str) -> str:
        """Add the brace level ahead of each delimiter and the end of the delimiter before it."""
        levels = sums_before(transform(ds, lambda d: delta(d, "{", "}")))
        ends = f"slice(concat(array(0L), {transform(ds, lambda d: f'{d}.at + 1')}), 1, size({ds}))"
        return zip_with(
            zip_with(ds, levels, lambda d, n: f"named_struct('token', {d}.token, 'at', {d}.at, 'level', {n})"),
            ends,
            lambda d, e: f"named_struct('token', {d}.token, 'at', {d}.at, 'level', {d}.level, 'since', {e})",
        )

    def statement_nodes(ds: str) -> str:
        return transform(
            keep(ds, lambda d: f"{d}.token = ';'"),
            lambda d: _node(
                first_text_byte(f"{d}.since", f"{d}.at"), f"{d}.at + 1", f"greatest({d}.level, 0) * 2 + 2", "'statement'"
            ),
        )

    def pair_nodes(ds: str) -> str:
        # At one level opens and closes alternate, so after sorting by (level, position)
        # the partner of an open brace is its right neighbour.
        by_level = transform(
            keep(ds, lambda d: f"{d}.token <> ';'"),
            lambda d: f"named_struct('level', {d}.level + if({d}.token = '{{', 1, 0), 'at', {d}.at, "
            f"'opens', {d}.token = '{{', 'since', {d}.since)",
        )

        def nodes(x: str, y: str) -> str:
            level = f"greatest({x}.level, 1)"
            body = _node(f"{x}.at", f"{y}.at + 1", f"{level} * 2 + 1", "'body'")
            start = first_text_byte(f"{x}.since", f"{x}.at")
            both = let(
                start,
                lambda s: f"if({s} < {x}.at, array({_node(s, f'{y}.at + 1', f'{level} * 2', lit('definition'))}, {body}), "
                f"array({body}))",
            )
            return f"if({x}.opens and not {y}.opens and {x}.level = {y}.level, {both}, {NO_NODES})"

        def neighbours(s: str) -> str:
            pairs = zip_with(
                f"slice({s}, 1, greatest(size({s}) - 1, 0))", f"slice({s}, 2, greatest(size({s}) - 1, 0))", nodes
            )
            return f"flatten({pairs})"

        return let(f"sort_array({by_level})", neighbours)

    found = let(
        let(let(regexp_extract_all(text, LEXEME), delimiters), outside_parens),
        lambda kept: let(
            with_context(kept), lambda ds: f"sort_array(concat({statement_nodes(ds)}, {pair_nodes(ds)}))"
        ),
    )
    return f"concat({_root(text, 'file')}, {found})"


def brace_nodes(text: str) -> str:
    """file > definition (header and braces) > body > statement / definition > ...

    Braces in strings and comments do not count, semicolons only outside parentheses.
    An unclosed brace opens no node.  The text is encoded once for all nodes.
    """
    return let(f"encode({text}, 'UTF-8')", lambda raw: _brace_nodes(text, raw))


SCANNERS = {"prose": prose_nodes, "brace": brace_nodes, "keyword": keyword_nodes, "indent": indent_nodes}


# ---------------------------------------------------------------- nodes as rows


def with_nodes(files: DataFrame, scanner: str, text: str = "text") -> DataFrame:
    return files.withColumn("nodes", F.expr(SCANNERS[scanner](text)))


def with_brace_nodes(files: DataFrame, text: str = "text") -> DataFrame:
    """The nodes of the ``brace`` scanner found in Arrow batches, for plans that go on in Python anyway."""

    def scan(texts: pa.Array) -> pa.Array:
        return braces.nodes(texts)

    return files.withColumn("nodes", F.arrow_udf(scan, NODE_TYPE)(F.col(text).cast("string")))


def explode_nodes(files: DataFrame, file_id: str = "file_id") -> DataFrame:
    """The node table: ``node_id`` is the pre-order number in the file."""
    rows = transform(
        "nodes",
        lambda n, i: f"named_struct('node_id', cast({i} as bigint), 'depth', {n}.depth, 'type', {n}.type, "
        f"'start_byte', {n}.start_byte, 'end_byte', {n}.end_byte)",
    )
    return files.select(file_id, F.inline(F.expr(rows)))


def select_by_rules(nodes: DataFrame, rules: DataFrame, role: str, language: str) -> DataFrame:
    """Nodes whose type is listed under the role of the language."""
    wanted = rules.where((F.col("role") == role) & (F.col("language") == language)).select(
        F.col("node_type").alias("type")
    )
    return nodes.join(F.broadcast(wanted), "type", "left_semi")


#: A block covers so many bins of its own width at most, and one more.
SPREAD = 32


def binned_blocks(blocks: DataFrame, bin_bytes: int = 1 << 12) -> DataFrame:
    """Blocks in the bins they cover: ``_level, _bin``.

    Bins double from level to level, and a block lies on the first level where it covers ``SPREAD``
    bins or fewer (and a part of one more), so the copies of a block do not grow with its width.
    """
    width = F.greatest(F.col("end_byte") - F.col("start_byte"), F.lit(1))
    level = F.greatest(F.ceil(F.log2(width / F.lit(float(bin_bytes * SPREAD)))), F.lit(0)).cast("int")
    size = f"shiftleft({bin_bytes}L, _level)"
    covered = f"sequence(start_byte div {size}, greatest(start_byte div {size}, (end_byte - 1) div {size}))"
    return blocks.withColumn("_level", level).withColumn("_bin", F.explode(F.expr(covered)))


def contained(
    blocks: DataFrame, subs: DataFrame, file_id: str = "file_id", bin_bytes: int = 1 << 12
) -> DataFrame:
    """Pairs of a block and a node of its subtree, the block's own node included.

    A node joins in the bin of its first byte on every level that has blocks, a block in the bins of its
    own level (``binned_blocks``), so a pair meets once.  The key (file, level, bin) keeps one huge
    file, or one huge block, from landing in one task.
    """
    b = binned_blocks(blocks, bin_bytes).select(
        file_id, "_level", "_bin", F.col("node_id").alias("block_id"), F.col("start_byte").alias("block_start"), F.col("end_byte").alias("block_end")
    )
    # As many levels as doublings from a bin to the longest file, some thirty.
    levels = b.agg(F.collect_set("_level")).scalar()
    n = subs.select(
        file_id,
        F.col("node_id").alias("sub_id"),
        F.col("type").alias("sub_type"),
        F.col("start_byte").alias("_start"),
        F.col("end_byte").alias("_end"),
        F.explode(levels).alias("_level"),
    ).withColumn("_bin", F.expr(f"_start div shiftleft({bin_bytes}L, _level)"))
    inside = (
        (F.col("sub_id") >= F.col("block_id"))
        & (F.col("_start") >= F.col("block_start"))
        & (F.col("_end") <= F.col("block_end"))
        # An empty node belongs to a block that it begins, not to one that ends there.
        & ((F.col("_start") < F.col("block_end")) | (F.col("_start") == F.col("block_start")))
    )
    return (
        b.join(n, [file_id, "_level", "_bin"])
        .where(inside)
        .select(
            file_id,
            "block_id",
            "sub_id",
            "sub_type",
            (F.col("_start") - F.col("block_start")).alias("rel_start"),
            (F.col("_end") - F.col("block_start")).alias("rel_end"),
        )
    )


SNIPPET_BYTES = 240


def node_listing(files: DataFrame, content: str, file_id: str = "file_id") -> DataFrame:
    """Depth, type and the first 60 characters of the first line of every node."""

    def snippet(n: Column) -> Column:
        # 60 characters have 240 bytes at most.
        length = F.least(n["end_byte"] - n["start_byte"], F.lit(SNIPPET_BYTES))
        raw = F.substring(F.col(content), (n["start_byte"] + 1).cast("int"), length.cast("int"))
        first_line = F.get(F.split(F.make_valid_utf8(raw.cast("string")), "\n"), F.lit(0))
        return F.translate(F.substring(first_line, 1, 60), "\t", " ")

    listed = F.transform(
        F.col("nodes"),
        lambda n, i: F.struct(
            i.cast("bigint").alias("node_id"),
            n["depth"].alias("depth"),
            n["type"].alias("type"),
            n["start_byte"].alias("start_byte"),
            snippet(n).alias("snippet"),
        ),
    )
    return files.select(file_id, F.inline(listed))


# ---------------------------------------------------------------- blocks in one pass


def _subtree_ends(nodes: str) -> str:
    """For each node the pre-order number of its last descendant.

    That is the number of nodes that start before the node ends, less one; it is read off
    one sorted list of all starts and ends.
    """

    def marks(field: str, starts: int) -> str:
        return transform(nodes, lambda x, i: f"named_struct('at', {x}.{field}, 'starts', {starts}, 'i', {i})")

    def counted(ev: str) -> str:
        at_ends = zip_with(
            ev,
            sums_before(f"{ev}.starts"),
            lambda e, c: f"if({e}.starts = 0, named_struct('i', {e}.i, 'last', cast({c} - 1 as int)), null)",
        )
        return keep(at_ends, lambda e: f"{e} is not null")

    events = f"sort_array(concat({marks('end_byte', 0)}, {marks('start_byte', 1)}))"
    return transform(f"sort_array({let(events, counted)})", lambda e: f"greatest({e}.last, {e}.i)")


def block_array(nodes: str, content: str, block_types: list[str], sub_types: list[str], max_depth: int) -> str:
    """Blocks at depth ``<= max_depth`` with their bytes and the sub-block ranges inside.

    The search goes on below a matching block, so nested blocks repeat their text.  The content is taken
    out of its row once: each reading of a binary column there copies the whole of it.
    """

    def listed(types: list[str]) -> str:
        return ", ".join(lit(t) for t in types)

    def blocks(v: str) -> str:
        wanted = keep(
            index_range(f"size({v}.nodes)"),
            lambda i: f"{v}.nodes[{i}].type in ({listed(block_types)}) and {v}.nodes[{i}].depth <= {max_depth}",
        )
        chosen = transform(wanted, lambda i: f"named_struct('i', {i}, 'last', {v}.last[{i}], 'n', {v}.nodes[{i}])")

        def build(x: str) -> str:
            start, end = f"{x}.n.start_byte", f"{x}.n.end_byte"
            subtree = transform(
                f"slice({v}.nodes, {x}.i + 1, {x}.last - {x}.i + 1)",
                lambda s, k: f"named_struct('sub_id', cast({x}.i + {k} as bigint), 'type', {s}.type, "
                f"'rel_start', {s}.start_byte - {start}, 'rel_end', {s}.end_byte - {start})",
            )
            return (
                f"named_struct('block_id', cast({x}.i as bigint), 'type', {x}.n.type, 'depth', {x}.n.depth, "
                f"'start_byte', {start}, 'end_byte', {end}, "
                f"'code', substring({v}.raw, cast({start} + 1 as int), cast({end} - {start} as int)), "
                f"'subblocks', {keep(subtree, lambda s: f'{s}.type in ({listed(sub_types)})')})"
            )

        return transform(chosen, build)

    return let(nodes, lambda ns: let(f"named_struct('nodes', {ns}, 'last', {_subtree_ends(ns)}, 'raw', {content})", blocks))


def extract_blocks(
    files: DataFrame,
    block_types: list[str],
    sub_types: list[str],
    max_depth: int,
    content: str = "content",
    passing: tuple[str, ...] = ("file_id",),
) -> DataFrame:
    """One row per block, straight from files with a ``nodes`` array."""
    found = F.expr(block_array("nodes", content, block_types, sub_types, max_depth))
    return files.select(*passing, F.inline(found))


def blocks_from_node_table(files: DataFrame, block_nodes: DataFrame, content: str = "content") -> DataFrame:
    """Cut block bytes out of the files for a node table that comes from outside."""
    return block_nodes.join(files.select("file_id", content), "file_id").select(
        "file_id",
        F.col("node_id").alias("block_id"),
        "type",
        "depth",
        "start_byte",
        "end_byte",
        F.substring(
            F.col(content), (F.col("start_byte") + 1).cast("int"), (F.col("end_byte") - F.col("start_byte")).cast("int")
        ).alias("code"),
    )

