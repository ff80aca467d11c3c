"""Structure and data flow of program texts, for all texts of an Arrow batch at once.

All tokens of a batch lie in one array; levels of brackets, partners, enclosing brackets, scopes
and orders of definitions come from running sums and sorts over it, so the work is close to linear
in the number of tokens.  The functions travel to the workers by value.

What is found in a text:

* Trees: every bracket group, and every statement (from a token at the start, after ``;``, a line
  end where lines end statements, or a curly bracket, up to the next end on its level, or the curly
  group that closes there).  A tree's hash is that of its tokens' shapes in order, brackets
  included, which names the tree with all its parts: names are ``v``, numbers ``0``, strings ``s``.
* Definitions of variables (names that aren't called nor members): assignments, ``++`` and ``--``,
  declarations with a type or declaring word at a statement's start, parameters of a function with
  a body, loop variables.  A declaration opens a scope up to the end of its curly bracket, or of the
  body behind its round one; a name belongs to the innermost scope of that name.
* Flow: a use of a variable comes from its last definition before it, where an assignment takes
  effect at the end of its statement; the target of an assignment is computed from the uses on its
  right side.  Variables are numbered by first appearance, definitions by their order, so an edge
  says from which definition a value comes.
"""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The operators that assign.
ASSIGNS = "= += -= *= /= %= &= |= ^= <<= >>= := **= //=".split()
# Words that declare the name behind them, where a language has such.
DECLARERS = "int long short float double char bool boolean void unsigned signed auto let var const mut size_t".split()
HASH_COMMENTS = ("python", "ruby", "php")
LINE_ENDS = ("python", "ruby")

_OPERATORS = r"<<=|>>=|\*\*=|//=|[-+*/%&|^:!=<>]=|\+\+|--|->|=>|&&|\|\||<<|>>|::"


def token_pattern(language: str) -> str:
    """Comments, strings, names, numbers, line ends where they count, operators, single characters."""
    comment = r"#[^\n]*" if language in HASH_COMMENTS else ""
    if language not in LINE_ENDS:
        comment = "|".join(filter(None, [r"//[^\n]*|/\*(?:[^*]|\*+[^*/])*(?:\*+/|\**$)", comment]))
    string = r'"(?:[^"\\\n]|\\[^\n])*"' + r"|'(?:[^'\\\n]|\\[^\n])*'"
    ends = r"\n|" if language in LINE_ENDS else ""
    return rf"{comment}|{string}|[A-Za-z_][A-Za-z0-9_]*|[0-9][A-Za-z0-9_.]*|{ends}{_OPERATORS}|[^ \t\r\n\f\x0b]"


def token_reader(language: str):
    """A function to the tokens of a text, the matches of ``token_pattern`` and empty ones at the end, read faster:
    blanks go with the token behind them, names come first, and no choice is left for each character of a string or comment.
    """
    pattern = token_pattern(language)
    for slow, quick in (
        (r'"(?:[^"\\\n]|\\[^\n])*"', r'"[^"\\\n]*+(?:\\[^\n][^"\\\n]*+)*+"'),
        (r"'(?:[^'\\\n]|\\[^\n])*'", r"'[^'\\\n]*+(?:\\[^\n][^'\\\n]*+)*+'"),
        (r"/\*(?:[^*]|\*+[^*/])*(", r"/\*[^*]*(?:\*+[^*/][^*]*)*("),
    ):
        pattern = pattern.replace(slow, quick)
    blanks = " \t\r\f\x0b" if language in LINE_ENDS else " \t\r\n\f\x0b"
    # With the text's end as a match, blanks there are read once only.
    return re.compile(rf"[{blanks}]*+([A-Za-z_][A-Za-z0-9_]*|{pattern}|\Z)").findall


def _is_comment(token: str, language: str) -> bool:
    if language in HASH_COMMENTS and token[0] == "#":
        return True
    return language not in LINE_ENDS and token[:2] in ("//", "/*") and token != "//="


def shape(token: str, keywords) -> str:
    if token[0] in "\"'" and len(token) > 1:
        return "s"
    if re.match("[A-Za-z_]", token):
        return token if token in keywords else "v"
    return "0" if "0" <= token[0] <= "9" else token


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _combined(*columns):
    out = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.int64).view(np.uint64) + np.uint64(1))
    return out


def _order(*columns):
    """The stable order by columns of integers, the last one first, as ``np.lexsort`` has it."""
    packed, bits = None, 0
    for column in columns:
        low = int(column.min()) if len(column) else 0
        width = (int(column.max()) - low if len(column) else 0).bit_length()
        if bits + width > 62:
            return np.lexsort(columns)
        part = (column - low) << bits
        packed, bits = part if packed is None else packed | part, bits + width
    n = len(packed)
    if bits + n.bit_length() > 62:
        return np.argsort(packed, kind="stable")
    # With its place behind it every key is one of its own, and plain sorting is the fastest.
    return np.sort((packed << n.bit_length()) | np.arange(n)) & ((1 << n.bit_length()) - 1)


def copies_apart(text, value):
    """The values, the first, second, ... copy of a value in a text made different from each other.

    The clipped overlap of two multisets is then the size of the intersection of two sets.
    """
    if len(text) and text.max() < 1 << 16:
        # Equal values of a text may come in any order; few small numbers are sorted by counting.
        order = np.argsort(value)
        order = order[np.argsort(text[order].astype(np.uint16), kind="stable")]
    else:
        order = np.lexsort((value, text))
    t, v = text[order], value[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
    starts = np.flatnonzero(new)
    copy = np.arange(len(t)) - np.repeat(starts, np.diff(np.append(starts, len(t))))
    return t, np.where(copy == 0, v, _combined(v.view(np.int64), copy))


def _lists(text, value, rows: int):
    """One list per text; ``text`` is rising."""
    offsets = np.searchsorted(text, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.view(np.int64)))


class _Grouped:
    """Places (rising) with a group each, to find the next or last one of a group."""

    def __init__(self, places, group, size: int):
        self.bits = size.bit_length()
        self.keys = np.sort((group << self.bits) | places)
        self.group, self.places = self.keys >> self.bits, self.keys & ((1 << self.bits) - 1)

    def after(self, at, group, missing):
        """The first place behind ``at`` in the group, or ``missing``."""
        k = np.searchsorted(self.keys, (group << self.bits) | at, side="right")
        return self._of(k, group, missing)

    def before(self, at, group, missing):
        k = np.searchsorted(self.keys, (group << self.bits) | at, side="left") - 1
        return self._of(k, group, missing)

    def _of(self, k, group, missing):
        if not len(self.places):
            return np.broadcast_to(missing, k.shape).copy()
        inside = (k >= 0) & (k < len(self.places))
        k = np.where(inside, k, 0)
        return np.where(inside & (self.group[k] == group), self.places[k], missing)


def innermost(group, low, high, at_group, at):
    """For every place ``at`` the number of the innermost interval with ``low < at < high`` of its group, or -1.

    The intervals of a group lie in or apart from each other.  In order, an interval opens a level
    and closes it again; at a place on level n the interval is the last that opened level n.
    """
    n, m = len(low), len(at)
    if not n or not m:
        return np.full(m, -1, dtype=np.int64)
    place = np.concatenate([low, high, at])
    # Ends come before places and these before beginnings at the same place, longer intervals first.
    kind = np.repeat([2, 0, 1], [n, n, m])
    length = np.concatenate([-high, np.zeros(n + m, dtype=np.int64)])
    groups = np.concatenate([group, group, at_group])
    number = np.concatenate([np.arange(n), np.full(n, -1), np.arange(m)])
    order = _order(length, kind, place, groups)
    groups, kind, number = groups[order], kind[order], number[order]
    level = np.cumsum(np.where(kind == 2, 1, np.where(kind == 0, -1, 0)))
    queued = _order(level, groups)
    kind, number, level = kind[queued], number[queued], level[queued]
    opened = np.maximum.accumulate(np.where(kind == 2, np.arange(len(kind)), -1))
    asked = (kind == 1) & (level > 0)
    out = np.full(m, -1, dtype=np.int64)
    out[number[asked]] = number[opened[asked]]
    return out


def _flow(text, token, tokens, has, key, base, starts, stops, closing, partner, opener):
    """Text and hash of every edge of the data flow."""
    n = len(token)
    at = np.arange(n)
    no_token = len(tokens)
    ext = np.append(token, no_token)

    def neighbour(places, step):
        """The token so many places on, in the same text."""
        there = places + step
        owner = np.minimum(places, n - 1)
        return ext[np.where((there >= starts[owner]) & (there < stops[owner]), there, n)]

    nxt, prv, prv2 = neighbour(at, 1), neighbour(at, -1), neighbour(at, -2)
    var = at[has("name")[token] & ~has("(")[nxt] & ~has("member")[prv]]
    nxt, prv, prv2, prv3 = nxt[var], prv[var], prv2[var], neighbour(var, -3)
    t, stop = text[var], stops[var]
    indexed = has("[")[nxt] & (partner[np.minimum(var + 1, n - 1)] < stop)
    op = np.where(indexed, partner[np.minimum(var + 1, n - 1)] + 1, var + 1)
    behind = ext[np.where(op < stop, op, n)]
    o = opener[var]
    some = np.where(o >= 0, o, 0)
    curly, paren = (o >= 0) & has("{")[token[some]], (o >= 0) & has("(")[token[some]]
    closed = np.where(o >= 0, partner[some], stop)
    body = np.where(closed + 1 < stop, closed + 1, n)
    with_body = paren & has("{")[ext[body]]
    function = with_body & has("name")[neighbour(some, -1)]
    assign = has("assign")[behind]
    step = has("step")[nxt] | has("step")[prv]
    loop = has("for")[prv] & has("in")[behind]
    param = function & has("listed")[behind] & ~assign
    far = has("star")[prv]
    declarer, guard = np.where(far, prv2, prv), np.where(far, prv3, prv2)
    first = has("opens_statement")[guard] | (has(",")[guard] & paren)
    typed = has("declarer")[declarer] & (first | has("keyword")[guard]) & (has("ends_name")[behind] | assign)
    named = has("name")[declarer] & (~far | first) & has("plain")[behind]
    declare = typed | named | param | loop
    define = declare | assign | step
    pure = (declare | (has("plain")[behind] & ~indexed)) & ~step

    # Scopes: to the end of the curly bracket, or of the body behind another one, or else of what that one stands in.
    outside = np.where(o >= 0, closing.after(np.minimum(closed, n), base[some], stop), stop)
    end = np.where(curly, closed, np.where(with_body, partner[np.where(with_body, body, 0)], outside))
    name = t * (len(tokens) + 1) + token[var]
    declared = np.flatnonzero(declare)
    scope = innermost(name[declared], var[declared], end[declared], name, var)
    scope = np.where(declare, np.arange(len(var)), np.where(scope >= 0, declared[scope] if len(declared) else 0, -1))
    _, first_use, variable = np.unique(name * (len(var) + 1) + scope + 1, return_index=True, return_inverse=True)
    order = np.argsort(first_use)
    of_text = t[first_use[order]]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order)) - np.searchsorted(of_text, of_text)
    number = number[variable]

    # An assignment takes effect where its statement ends, all else at its place.
    ends = at[(has("ends_value") | has("close"))[token]]
    over = _Grouped(ends, key[ends], n + 1).after(op, key[var], stop)
    effect = np.where(assign, over, var)
    defs = np.flatnonzero(define)
    defs = defs[_order(var[defs], effect[defs], variable[defs])]
    ordinal = np.zeros(len(var), dtype=np.int64)
    ordinal[defs] = np.arange(len(defs)) - np.searchsorted(variable[defs], variable[defs]) + 1
    keys = variable[defs] * (n + 2) + effect[defs]
    reached = np.searchsorted(keys, variable * (n + 2) + var) - np.searchsorted(keys, variable * (n + 2))

    uses = np.flatnonzero(~pure)
    come = uses[reached[uses] > 0]
    targets = np.flatnonzero(assign)
    into = innermost(t[targets], op[targets], over[targets], t[uses], var[uses])
    source, target = uses[into >= 0], targets[into[into >= 0]] if len(targets) else uses[:0]
    comes = _combined(np.full(len(come), 1), number[come], reached[come])
    computed = _combined(np.full(len(source), 2), number[target], ordinal[target], number[source], reached[source])
    return np.concatenate([t[come], t[source]]), np.concatenate([comes, computed])


_BASE = 0x9E3779B97F4A7C15
#: Powers that a process has computed.
_POWERS: dict = {}


def _powers(base: int, n: int):
    if len(_POWERS.get(base, ())) < n:
        out = np.full(n, base % 2**64, dtype=np.uint64)
        out[:1] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


class _Numbers(dict):
    """Numbers of tokens; all strings are one token, and a comment or the text's end is none (-1)."""

    def __init__(self, language: str):
        super().__init__({"": -1})
        self.tokens, self.language = [], language

    def __missing__(self, token: str) -> int:
        if _is_comment(token, self.language):
            return -1
        if token[0] in "\"'" and len(token) > 1:
            token = '""'
            if token in self:
                return self[token]
        self[token] = len(self.tokens)
        self.tokens.append(token)
        return self[token]


def structure(texts: list[str], language: str, keywords) -> tuple[pa.Array, pa.Array]:
    """For every text the hashes of its trees and of the edges of its data flow, copies apart."""
    return tuple(_lists(*copies_apart(*found), len(texts)) for found in _trees_and_edges(texts, language, keywords))


def _trees_and_edges(texts: list[str], language: str, keywords):
    """Text and hash of every tree and of every edge of the data flow."""
    read, numbers, flat, sizes = token_reader(language), _Numbers(language), [], []
    number = numbers.__getitem__
    for one in texts:
        found = read(one)
        flat += map(number, found)
        sizes.append(len(found))
    rows, tokens, flat = len(texts), numbers.tokens, np.array(flat, dtype=np.int64)
    told = flat >= 0
    token, text = flat[told], np.repeat(np.arange(rows), sizes)[told]
    n = len(token)
    if not n:
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        return none, none
    sizes = np.bincount(text, minlength=rows)
    stop_of = np.cumsum(sizes)
    stops, starts = stop_of[text], (stop_of - sizes)[text]
    declarers = () if language in HASH_COMMENTS else DECLARERS
    classes = {
        "open": set("([{"), "close": set(")]}"), "[": {"["}, "(": {"("}, "{": {"{"}, "}": {"}"}, ",": {","},
        "assign": set(ASSIGNS), "plain": {"=", ":="}, "step": {"++", "--"}, "member": {".", "->", "::"}, "star": {"*", "&"},
        "for": {"for"}, "in": {"in", "of"}, "declarer": set(declarers), "listed": {",", ")"}, "keyword": set(keywords),
        "end": {";", "\n"}, "ends_value": {";", "\n", ","}, "ends_name": {";", ",", ")", ":", "\n", "in", "of"},
    }
    flags = {k: np.array([x in some for x in tokens] + [False]) for k, some in classes.items()}
    flags["name"] = np.array([bool(re.match("[A-Za-z_]", x)) and x not in classes["keyword"] and x not in classes["declarer"] for x in tokens] + [False])
    # The place before the first token opens a statement as well.
    flags["opens_statement"] = np.array([x in ";{}(\n" for x in tokens] + [True])
    has = flags.__getitem__

    opens, closes = has("open")[token], has("close")[token]
    depth = np.cumsum(opens.astype(np.int64) - closes)
    depth -= np.where(starts > 0, depth[starts - 1], 0)
    level = depth + closes
    low = int(level.min()) - 1
    wide = int(level.max()) - low + 1
    key = text * wide + (level - low)
    at = np.arange(n)
    closing = _Grouped(at[closes], key[closes], n + 1)
    partner = closing.after(at, key, stops)
    opener = _Grouped(at[opens], key[opens], n + 1).before(at, key, np.int64(-1))

    # Trees: bracket groups and statements.
    groups = at[opens & (partner < stops)]
    before = np.where(at > starts, token[at - 1], len(tokens))
    start = at[~closes & ~has("end")[token] & (has("end") | has("{") | has("}") | (np.arange(len(tokens) + 1) == len(tokens)))[before]]
    base = key - (opens | closes)
    ends = at[(has("end") | has("}"))[token]]
    stop = _Grouped(ends, base[ends], n + 1).after(start, base[start], stops[start])
    around = closing.after(start, base[start], stops[start])
    last = np.minimum(np.minimum(stop, stops[start] - 1), around - 1)
    first, last = np.concatenate([groups, start]), np.concatenate([partner[groups], last])
    shapes = np.array([_hash(shape(x, classes["keyword"])) for x in tokens], dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(shapes[token] * _powers(_BASE, n), out=sums[1:])
    trees = _mixed((sums[last + 1] - sums[first]) * _powers(pow(_BASE, -1, 2**64), n)[first])
    trees = text[first], _combined(trees.view(np.int64), last - first)
    return trees, _flow(text, token, tokens, has, key, base, starts, stops, closing, partner, opener)


#: White space as ``str.split`` knows it: one byte, and the three bytes of UTF-8 (two with a zero before them).
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE_BLANKS = np.array(
    [int.from_bytes(chr(c).encode(), "big") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)


_LONG_WORD = 64  # bytes
_TAILS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _hashed_words(raw):
    """Places in the bytes where words begin, and 64-bit hashes of the words, in one pass."""
    n = len(raw)
    blank = _BLANK[raw]
    wide = np.flatnonzero(raw >= 0xC2)
    if len(wide):
        one, two, three = (np.append(raw, [0, 0])[wide + k].astype(np.int64) for k in range(3))
        for bytes_, code in ((2, one << 8 | two), (3, one << 16 | two << 8 | three)):
            at = wide[np.isin(code, _WIDE_BLANKS)]
            for k in range(bytes_):
                blank[at + k] = True
    padded = np.ones(n + 2, dtype=bool)
    padded[1:-1] = blank
    turns = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = turns[::2], turns[1::2]
    sizes = ends - starts
    # Eight bytes at a time, zeros behind the last ones; long words at once, by sums over powers.
    eights = np.lib.stride_tricks.as_strided(np.append(raw, np.zeros(8, dtype=np.uint8)).view(), (n + 1, 8), (1, 1))
    hashed, some = sizes.astype(np.uint64), np.flatnonzero(sizes <= _LONG_WORD)
    for done in range(0, _LONG_WORD, 8):
        some = some[sizes[some] > done] if done else some
        if not len(some):
            break
        own = eights[starts[some] + done].view("<u8").ravel() & _TAILS[np.minimum(sizes[some] - done, 8)]
        hashed[some] = _mixed(hashed[some] * np.uint64(_BASE) + own)
    some = np.flatnonzero(sizes > _LONG_WORD)
    if len(some):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
        hashed[some] = _mixed((sums[ends[some]] - sums[starts[some]]) * _powers(pow(_BASE, -1, 2**64), n)[starts[some]])
    return starts, hashed


def word_hashes(text: str):
    """64-bit hashes of the words of a text."""
    return _hashed_words(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8))[1]


def _runs(text, hashed, longest: int):
    """For 1 to ``longest`` words the first words of all runs within a text, and the hashes of the runs by first word."""
    n, run = len(hashed), np.zeros(len(hashed), dtype=np.uint64)
    for k in range(longest):
        run = _mixed(run[: max(n - k, 0)] * np.uint64(_BASE) + hashed[k:] + np.uint64(1))
        whole = np.flatnonzero(text[: len(run)] == text[k:])
        yield whole, run


def _listed(hashed, keywords):
    """Places of the words that are key words."""
    wanted = word_hashes(" ".join(sorted(keywords)))
    some = np.zeros(1 << 16, dtype=bool)
    some[wanted & np.uint64(0xFFFF)] = True
    near = np.flatnonzero(some[hashed & np.uint64(0xFFFF)])
    return near[np.isin(hashed[near], wanted)]


def grams(words: list[list[str]], keywords, longest: int = 4) -> list[pa.Array]:
    """For the words of every text the hashes of its runs of 1 to ``longest`` words, and of its key words, copies apart."""
    rows, sizes = len(words), [len(own) for own in words]
    hashed = word_hashes(" ".join(" ".join(own) for own in words if own))
    text = np.repeat(np.arange(rows), sizes)
    out = [_lists(*copies_apart(text[whole], run[whole]), rows) for whole, run in _runs(text, hashed, longest)]
    listed = _listed(hashed, keywords)
    return [*out, _lists(*copies_apart(text[listed], hashed[listed]), rows)]


def _overlaps(text, value, rows: int, sides: int):
    """For every side but the first, by row, how many values it shares with the first side, copies counted.

    Text ``s * rows + r`` is side s of row r.  Row, value and side are sorted as one number, of
    which the value has 53 bits or more in slices of ``SLICE_ROWS`` rows with three sides.
    """
    high, low = rows.bit_length(), (sides - 1).bit_length()
    side, row = np.repeat(np.arange(sides, dtype=np.uint64), rows), np.tile(np.arange(rows, dtype=np.uint64), sides)
    keys = value >> np.uint64(high + low)
    keys <<= np.uint64(low)
    keys |= (row << np.uint64(64 - high) | side)[text]
    keys.sort()
    side, item = keys & np.uint64((1 << low) - 1), keys >> np.uint64(low)
    if not len(keys):
        return np.zeros((sides - 1, rows), dtype=np.int32)
    new = np.ones(len(item), dtype=bool)
    np.not_equal(item[1:], item[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    row = (item[starts] >> np.uint64(64 - high - low)).astype(np.int64)
    ends = np.append(starts[1:], len(keys))
    counts = [np.cumsum(side == s, dtype=np.int32)[ends - 1] for s in range(1, sides)]
    counts = [np.diff(x, prepend=np.int32(0)) for x in counts]
    first = ends - starts - sum(counts)
    return np.array([np.bincount(row, np.minimum(first, c), rows) for c in counts]).astype(np.int32)


def _shared_runs(text, hashed, n_words, longest: int):
    """For 1 to ``longest`` words, by side and row, how many runs a side shares with the first one, copies counted.

    Equal runs at the same place of both texts are counted at once; only the rest of both is sorted, as
    min(a + b, a + c) = a + min(b, c).
    """
    sides, rows = n_words.shape
    sizes = n_words.ravel()
    first, ref = np.cumsum(sizes) - sizes, np.tile(np.arange(rows), sides)
    mate = np.arange(len(text)) - (first - first[ref])[text]
    room = (first + sizes)[ref][text] - mate
    bounds = np.append(first[::rows], len(text))
    for k, (whole, run) in enumerate(_runs(text, hashed, longest)):
        cuts, shared = np.searchsorted(whole, bounds), []
        of_ref = whole[: cuts[1]]
        for side in range(1, sides):
            own = whole[cuts[side] : cuts[side + 1]]
            there = np.minimum(mate[own], max(len(run) - 1, 0))
            same = (room[own] > k) & (run[there] == run[own])
            left = np.ones(bounds[1], dtype=bool)
            left[there[same]] = False
            refs, rest = of_ref[left[of_ref]], own[~same]
            texts = np.concatenate([text[refs], text[rest] - (side - 1) * rows])
            shared.append(np.bincount(text[own[same]] - side * rows, minlength=rows) + _overlaps(texts, run[np.append(refs, rest)], rows, 2)[0])
        yield np.array(shared).astype(np.int32)


#: Rows and bytes of the texts that are compared at once: few enough to stay in a processor's cache.
SLICE_ROWS, SLICE_BYTES = 255, 1 << 19


def _compared(sides: list[list[str]], language: str, keywords) -> pa.StructArray:
    rows, texts = len(sides[0]), [one for side in sides for one in side]
    raw = "\n".join(texts).encode("utf-8", "surrogatepass")
    sizes = [len(one) if one.isascii() else len(one.encode("utf-8", "surrogatepass")) for one in texts]
    starts, hashed = _hashed_words(np.frombuffer(raw, dtype=np.uint8))
    upto = np.searchsorted(starts, np.cumsum(np.array(sizes, dtype=np.int64) + 1))
    text = np.repeat(np.arange(len(texts)), np.diff(upto, prepend=0))
    listed = _listed(hashed, keywords)
    items = [(text[listed], hashed[listed]), *_trees_and_edges(texts, language, keywords)]
    n = [np.bincount(x, minlength=len(texts)).astype(np.int32).reshape(len(sides), rows) for x in (text, *[some[0] for some in items])]
    shared = [*_shared_runs(text, hashed, n[0], 4), *[_overlaps(*some, rows, len(sides)) for some in items]]

    def struct(columns, names):
        return pa.StructArray.from_arrays([pa.array(x) for x in columns], names)

    ref = struct([x[0] for x in n], ["n_words", "keywords", "trees", "edges"])
    names = ["n_words", "g1", "g2", "g3", "g4", "keywords", "trees", "edges"]
    others = [struct([n[0][c + 1], *[x[c] for x in shared]], names) for c in range(len(sides) - 1)]
    return pa.StructArray.from_arrays([ref, *others], ["ref", *[f"c{c}" for c in range(len(others))]])


def compared(ref, candidates, language: str, keywords) -> pa.Array:
    """``ref`` and ``c0``, ``c1``, ... for every row of arrays of texts; null counts as empty.

    Of the reference the numbers of words, key words, trees and edges; of a candidate the number of its
    words, and how many runs of 1 to 4 words, key words, trees and edges it shares with the reference.
    """
    columns = [side.to_pylist() for side in (ref, *candidates)]
    columns = [[one or "" for one in column] for column in columns]
    parts, start, held, rows = [], 0, 0, len(ref)
    for end in range(1, rows + 1):
        held += sum(len(column[end - 1]) for column in columns)
        if held >= SLICE_BYTES or end - start == SLICE_ROWS or end == rows:
            parts.append(_compared([column[start:end] for column in columns], language, keywords))
            start, held = end, 0
    return pa.concat_arrays(parts) if parts else _compared([[""] for _ in columns], language, keywords).slice(0, 0)
