"""Array helpers (as SQL text) that stay inside one row, so they never shuffle.

Folding an array into a growing array copies the accumulator at every step.  The
prefix sum therefore works in pieces, whose length grows with the cube root of the array's: that
balances the copies inside the pieces with those over the pieces.
"""

from __future__ import annotations

from gapweave.functions.sqltext import fold, index_range, keep, let, lit, transform, zip_with

PIECE = 16


def _running(values: str) -> str:
    """0, the first element, the sum of the first two, ..., the sum of all."""
    return fold(
        values,
        "array(0L)",
        lambda s, x: f"concat({s}, array(element_at({s}, -1) + cast({x} as bigint)))",
        lambda s: s,
    )


def sums_before(values: str) -> str:
    """For each element the sum of all elements ahead of it."""

    def over_pieces(v: str) -> str:
        length = f"cast(greatest({PIECE}, cbrt(2 * size({v}))) as int)"
        n_pieces = f"ceil(size({v}) / {length})"
        pieces = transform(index_range(n_pieces), lambda k: _running(f"slice({v}, {k} * {length} + 1, {length})"))

        def joined(ps: str) -> str:
            totals = transform(ps, lambda p: f"element_at({p}, -1)")
            shifted = zip_with(
                ps,
                f"slice({_running(totals)}, 1, size({ps}))",
                lambda inner, base: transform(f"slice({inner}, 1, size({inner}) - 1)", lambda x: f"{x} + {base}"),
            )
            return f"flatten({shifted})"

        whole = f"if(size({v}) <= {PIECE}, slice({_running(v)}, 1, size({v})), {let(pieces, joined)})"
        return whole

    return let(values, over_pieces)


def tile_offsets(pieces: str, gap: int = 0) -> str:
    """Byte offset of every string piece when the pieces are laid out ``gap`` bytes apart."""
    return sums_before(transform(pieces, lambda p: f"octet_length({p}) + {gap}"))


def gram_lists(tokens: str, longest: int) -> str:
    """Array of the n-gram lists for n = 1 .. longest; each is built from the one before it."""

    def extend(lists: list[str], n: int) -> str:
        if n > longest:
            return f"array({', '.join(lists)})"
        shorter, first = lists[-1], lists[0]
        count = f"greatest(size({first}) - {n - 1}, 0)"
        longer = zip_with(
            f"slice({shorter}, 1, {count})",
            f"slice({first}, {n}, {count})",
            lambda head, last: f"concat({head}, {lit(chr(1))}, {last})",
        )
        return let(longer, lambda grams: extend([*lists, grams], n + 1))

    return let(tokens, lambda ts: extend([ts], 2))


def multiset_overlap(left: str, right: str, levels: int = 3) -> str:
    """Sum over distinct strings of ``min(count left, count right)``.

    The first copies count through a set intersection, the second copies likewise, and so on
    for a few levels; what is left after that (the further copies of the most frequent
    strings) is tagged, sorted and folded with a state of constant size.
    """

    def tag(items: str, side: int) -> str:
        return transform(items, lambda g: f"named_struct('item', {g}, 'side', {side})")

    def gain(s: str) -> str:
        return f"{s}.total + least({s}.n_left, {s}.n_right)"

    def step(s: str, x: str) -> str:
        return (
            f"if({s}.item <=> {x}.item,"
            f" named_struct('item', {s}.item, 'n_left', {s}.n_left + 1 - {x}.side,"
            f" 'n_right', {s}.n_right + {x}.side, 'total', {s}.total),"
            f" named_struct('item', {x}.item, 'n_left', 1 - {x}.side, 'n_right', {x}.side, 'total', {gain(s)}))"
        )

    def folded(v: str) -> str:
        return fold(
            f"sort_array(concat({tag(f'{v}.l', 0)}, {tag(f'{v}.r', 1)}))",
            "named_struct('item', cast(null as string), 'n_left', 0, 'n_right', 0, 'total', 0)",
            step,
            gain,
        )

    def further_copies(items: str) -> str:
        return keep(items, lambda x, i: f"{i} > 0 and {items}[{i} - 1] = {x}")

    def count(v: str, level: int) -> str:
        rest = f"named_struct('l', {further_copies(f'{v}.l')}, 'r', {further_copies(f'{v}.r')})"
        deeper = let(rest, lambda w: count(w, level + 1)) if level < levels else folded(v)
        if level == levels:
            return f"if(size({v}.l) = 0 or size({v}.r) = 0, 0, {deeper})"
        return f"if(size({v}.l) = 0 or size({v}.r) = 0, 0, size(array_intersect({v}.l, {v}.r)) + {deeper})"

    both = f"named_struct('l', sort_array({left}), 'r', sort_array({right}))"
    return f"cast({let(both, lambda v: count(v, 0))} as double)"
