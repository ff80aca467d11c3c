"""Nodes of languages whose blocks are indented (offside rule), as one SQL expression.

file > line > block > line > ...  A logical line ends at a line break outside brackets and strings;
blank lines and comments make no node.  The lines behind a line that are indented deeper, up to the
next one that isn't, are its block, and the line's node covers them.  A tab counts eight columns.

The next line with no deeper indent is found indent by indent: among the lines indented no deeper than
some indent, it is the right neighbour of each line that has just that indent.  Widths are few, and a
text of many widths is long, so this stays near to linear.
"""

from __future__ import annotations

from gapweave.functions.arrays import sums_before, tile_offsets
from gapweave.functions.sqltext import keep, let, lit, regexp_extract_all, rstrip, transform, zip_with

# Everything is part of some lexeme, so that they tile the text.
LEXEME = (
    r'"""(?s:.*?)(?:"""|\z)'
    r"|'''(?s:.*?)(?:'''|\z)"
    r'|"[^"\\\n]*(?:\\[^\n][^"\\\n]*)*"'
    r"|'[^'\\\n]*(?:\\[^\n][^'\\\n]*)*'"
    r"|#[^\n]*|\\\n|\n|[()\[\]{}]"
    r"""|[^"'#\\\n()\[\]{}]+|["'\\]"""
)
# Node types by the word that begins a line; all other lines are assignments or expressions.
LINE_TYPES = {
    "def": "function_definition",
    "class": "class_definition",
    "if": "if_statement",
    "elif": "elif_clause",
    "else": "else_clause",
    "for": "for_statement",
    "while": "while_statement",
    "try": "try_statement",
    "except": "except_clause",
    "finally": "finally_clause",
    "with": "with_statement",
    "match": "match_statement",
    "case": "case_clause",
    "return": "return_statement",
    "yield": "yield",
    "import": "import_statement",
    "from": "import_from_statement",
}
HEAD_WORD = r"^(?:async[ \t]+)?([A-Za-z_]+)\b"
ASSIGNMENT = r"^[A-Za-z_*][A-Za-z0-9_.,* \t\[\]]*(?::[^=\n]*)?(?:[-+*/%&|^@]|//|\*\*|<<|>>)?=(?:[^=]|$)"


def _kind(code: str) -> str:
    word = f"regexp_extract({code}, {lit(HEAD_WORD)}, 1)"
    listed = " ".join(f"when {lit(w)} then {lit(kind)}" for w, kind in LINE_TYPES.items())
    other = f"case when {code} rlike {lit(ASSIGNMENT)} then 'assignment' when startswith({code}, '@') then 'decorator' else 'expression_statement' end"
    return f"case {word} {listed} else {other} end"


def _lines(text: str, raw: str) -> str:
    """``indent, s, e, kind`` of every logical line that has code."""

    def breaks(tokens: str) -> str:
        placed = zip_with(tokens, tile_offsets(tokens), lambda t, o: f"named_struct('token', {t}, 'at', {o})")
        marks = keep(placed, lambda d: f"{d}.token in ('\\n', '(', ')', '[', ']', '{{', '}}')")

        def outside(ds: str) -> str:
            delta = lambda d: f"case when {d}.token in ('(', '[', '{{') then 1 when {d}.token in (')', ']', '}}') then -1 else 0 end"
            open_ = sums_before(transform(ds, delta))
            ends = zip_with(ds, open_, lambda d, n: f"if({d}.token = '\\n' and {n} <= 0, {d}.at, null)")
            return f"concat({keep(ends, lambda e: f'{e} is not null')}, array(cast(octet_length({text}) as bigint)))"

        return let(marks, outside)

    def line(start: str, end: str) -> str:
        piece = f"cast(substring({raw}, cast({start} + 1 as int), cast({end} - {start} as int)) as string)"

        def described(p: str) -> str:
            def by_lead(lead: str) -> str:
                def by_code(code: str) -> str:
                    return (
                        f"if({code} = '' or startswith({code}, '#'), null, named_struct("
                        f"'indent', octet_length({lead}) + 7 * (octet_length({lead}) - octet_length(replace({lead}, '\\t', ''))), "
                        f"'s', {start} + octet_length({lead}), 'e', {start} + octet_length({lead}) + octet_length({code}), 'kind', {_kind(code)}))"
                    )

                return let(rstrip(f"substring({p}, length({lead}) + 1)"), by_code)

            return let(f"regexp_extract({p}, '^[ \\\\t\\\\f]*', 0)", by_lead)

        return let(piece, described)

    def between(bs: str) -> str:
        starts = f"concat(array(0L), transform(slice({bs}, 1, size({bs}) - 1), b -> b + 1))"
        return keep(zip_with(starts, bs, line), lambda x: f"{x} is not null")

    return let(let(regexp_extract_all(text, LEXEME), breaks), between)


def _next_no_deeper(ls: str) -> str:
    """For every line the number of the next line that isn't indented deeper, or the number of lines."""

    def of_indent(v: str) -> str:
        numbered = transform(ls, lambda x, i: f"named_struct('i', {i}, 'indent', {x}.indent)")
        some = keep(numbered, lambda x: f"{x}.indent <= {v}")

        def neighbours(xs: str) -> str:
            following = f"concat(slice({xs}, 2, greatest(size({xs}) - 1, 0)), array(named_struct('i', size({ls}), 'indent', 0)))"
            pairs = zip_with(xs, following, lambda x, y: f"if({x}.indent = {v}, named_struct('i', {x}.i, 'next', {y}.i), null)")
            return keep(pairs, lambda x: f"{x} is not null")

        return let(some, neighbours)

    indents = f"array_distinct(transform({ls}, x -> x.indent))"
    return transform(f"sort_array(flatten({transform(indents, of_indent)}))", lambda x: f"{x}.next")


def _levels(nexts: str) -> str:
    """How many lines hold each line in their block: those before it whose block isn't over."""
    ended = transform(nexts, lambda x: f"named_struct('at', {x}, 'asks', 0)")
    asking = transform(nexts, lambda x, i: f"named_struct('at', {i}, 'asks', 1)")

    def counted(ev: str) -> str:
        over = zip_with(ev, sums_before(transform(ev, lambda e: f"1 - {e}.asks")), lambda e, n: f"if({e}.asks = 1, {e}.at - {n}, null)")
        return keep(over, lambda x: f"{x} is not null")

    return let(f"sort_array(concat({ended}, {asking}))", counted)


def indent_nodes(text: str) -> str:
    node_type = "array<struct<start_byte:bigint,depth:int,end_byte:bigint,type:string>>"

    def node(start: str, end: str, depth: str, kind: str) -> str:
        return (
            f"named_struct('start_byte', cast({start} as bigint), 'depth', cast({depth} as int), "
            f"'end_byte', cast({end} as bigint), 'type', {kind})"
        )

    def all_nodes(v: str) -> str:
        numbered = transform(
            f"{v}.lines", lambda x, i: f"named_struct('x', {x}, 'i', {i}, 'next', {v}.nexts[{i}], 'level', {v}.levels[{i}])"
        )

        def one(y: str) -> str:
            end = f"{v}.lines[{y}.next - 1].e"
            head = node(f"{y}.x.s", end, f"2 * {y}.level + 2", f"{y}.x.kind")
            block = node(f"{v}.lines[{y}.i + 1].s", end, f"2 * {y}.level + 3", "'block'")
            return f"if({y}.next > {y}.i + 1, array({head}, {block}), array({head}))"

        return f"flatten({transform(numbered, one)})"

    def of_lines(ls: str) -> str:
        with_nexts = let(
            _next_no_deeper(ls), lambda n: let(f"named_struct('lines', {ls}, 'nexts', {n}, 'levels', {_levels(n)})", all_nodes)
        )
        return f"if(size({ls}) = 0, cast(array() as {node_type}), {with_nexts})"

    root = f"array({node('0', f'octet_length({text})', '1', lit('file'))})"
    return f"concat({root}, {let(f'encode({text}, {lit("UTF-8")})', lambda raw: let(_lines(text, raw), of_lines))})"
