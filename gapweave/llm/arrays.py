"""Arrow code that runs inside tasks: whole batches as columns, no row at a time.

The functions travel to the workers by value, so that these need not have the package.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def byte_slices(batch, column: int, most: int):
    """Parts of a record batch with about ``most`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def lists_of(chosen, parents, rows: int):
    """The chosen lines as one list per text; ``parents`` are the chosen lines' texts, rising."""
    counted = pa.table({"parent": parents}).group_by("parent").aggregate([("parent", "count")])
    sizes = pc.fill_null(
        pc.take(counted["parent_count"], pc.index_in(pa.array(range(rows), pa.int64()), counted["parent"].combine_chunks())), 0
    )
    ends = pc.cumulative_sum(pc.cast(sizes, pa.int64()))
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), *(ends.chunks if isinstance(ends, pa.ChunkedArray) else [ends])])
    return pa.LargeListArray.from_arrays(offsets, chosen)


def line_lists(texts):
    """``lines, parents, ordinals, counts``: all lines with their ends, whose they are, their places, lines per text."""
    kind = pa.large_string()
    pieces = pc.split_pattern(texts, "\n")
    flat, parents = pc.list_flatten(pieces), pc.cast(pc.list_parent_indices(pieces), pa.int64())
    starts = pc.take(pc.cast(pieces.offsets, pa.int64()), parents)
    ordinals = pc.subtract(pa.array(range(len(flat)), pa.int64()), pc.subtract(starts, pieces.offsets[0].as_py()))
    last = pc.equal(ordinals, pc.subtract(pc.take(pc.cast(pc.list_value_length(pieces), pa.int64()), parents), 1))
    ends = pc.if_else(last, pa.scalar("", kind), pa.scalar("\n", kind))
    lines = pc.binary_join_element_wise(flat, ends, pa.scalar("", kind))
    # What follows the last line break is a line only if it has characters.
    real = pc.invert(pc.and_(last, pc.equal(pc.binary_length(flat), 0)))
    open_end = pc.ends_with(texts, "\n")
    nothing = pc.equal(pc.binary_length(texts), 0)
    counts = pc.subtract(pc.cast(pc.list_value_length(pieces), pa.int64()), pc.cast(pc.or_(open_end, nothing), pa.int64()))
    return lines.filter(real), parents.filter(real), ordinals.filter(real), counts


def infilled(texts, draws, rate: int, spm_rate: int, markers: tuple[str, str, str]):
    """Lines, form, prefix, middle, suffix and output for an array of texts and four arrays of draws."""
    kind, rows = pa.large_string(), len(texts)
    texts = pc.fill_null(pc.cast(texts, kind), "")
    lines, parents, ordinals, counts = line_lists(texts)
    choices = pc.add(counts, 1)

    def remainder(value, divisor):
        return pc.subtract(value, pc.multiply(pc.divide(value, divisor), divisor))

    one, other = remainder(draws[0], choices), remainder(draws[1], choices)
    first, second = pc.min_element_wise(one, other), pc.max_element_wise(one, other)
    before = pc.less(ordinals, pc.take(first, parents))
    after = pc.greater_equal(ordinals, pc.take(second, parents))
    roles = (before, pc.invert(pc.or_(before, after)), after)
    empty = pa.scalar("", kind)
    prefix, middle, suffix = (
        pc.binary_join(lists_of(lines.filter(role), parents.filter(role), rows), empty) for role in roles
    )
    marked = pc.equal(pc.binary_length(texts), 0)
    for marker in markers:
        marked = pc.or_(marked, pc.match_substring(texts, marker))
    plain = pc.or_(marked, pc.greater_equal(remainder(draws[2], pa.scalar(100, pa.int64())), rate))
    spm = pc.less(remainder(draws[3], pa.scalar(100, pa.int64())), spm_rate)
    p, s, m = (pa.scalar(marker, kind) for marker in markers)
    join = pc.binary_join_element_wise
    moved = pc.if_else(spm, join(s, suffix, p, prefix, m, middle, empty), join(p, prefix, s, suffix, m, middle, empty))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, kind)
    parts = [pc.if_else(plain, none, part) for part in (prefix, middle, suffix)]
    return [counts, form, *parts, pc.if_else(plain, texts, moved)]


# --- alignment of two tokenizers ---------------------------------------------------------------


def id_lists(lists: list[list[int]]):
    """Python lists of ids as one list array."""
    return pa.array(lists, pa.list_(pa.int32()))


def same_bytes(ids, token_bytes, wanted):
    """Which lists of ids spell exactly the bytes wanted."""
    spelled = pa.ListArray.from_arrays(ids.offsets, pc.take(token_bytes, pc.list_flatten(ids)))
    return pc.equal(pc.binary_join(spelled, b""), wanted)


def token_ends(ids, token_sizes):
    """``parents, ends, flat``: whose each token is, where it ends in its text's bytes, and its id.

    The ends are sums of sizes over the whole batch, less the sum before the text.
    """
    flat, parents = pc.list_flatten(ids), pc.list_parent_indices(ids)
    upto = pc.cumulative_sum(pc.take(token_sizes, flat))
    before = pa.concat_arrays([pa.array([0], upto.type), upto])
    starts = pc.take(before, ids.offsets.slice(0, len(ids)))
    return parents, pc.subtract(upto, pc.take(starts, parents)), flat


def linked_tokens(a, b):
    """``text, a, b, shared`` for every two tokens whose bytes overlap, in order, and the tokens' own rows.

    ``a`` and ``b`` are results of ``token_ends`` for texts of the same bytes.  Every place where a
    token ends closes one overlap, of the tokens of either side that end there or next: so the
    overlaps are the full outer join of the ends, what is missing filled from behind.  ``shared``
    says that both sides end.  A text's last end is shared, so nothing is filled across texts.
    Returns also the masks of rows where a token of a, or of b, ends.
    """

    def keyed(parents, ends, flat, name):
        key = pc.bit_wise_or(pc.shift_left(pc.cast(parents, pa.int64()), 32), pc.cast(ends, pa.int64()))
        return pa.table({"key": key, name: flat})

    joined = keyed(*a, "a").join(keyed(*b, "b"), "key", join_type="full outer", use_threads=False)
    joined = joined.sort_by("key").combine_chunks()
    left, right = joined["a"].combine_chunks(), joined["b"].combine_chunks()
    of_a, of_b = pc.is_valid(left), pc.is_valid(right)
    text = pc.cast(pc.shift_right(joined["key"].combine_chunks(), 32), pa.int32())
    return text, pc.fill_null_backward(left), pc.fill_null_backward(right), pc.and_(of_a, of_b), of_a, of_b


def _offsets_after(ends):
    """Offsets of lists that each close with a true value; the last one is true."""
    at = pc.add(pc.indices_nonzero(ends), pa.scalar(1, pa.uint64()))
    return pc.cast(pa.concat_arrays([pa.array([0], pa.uint64()), at]), pa.int32())


def _last_of_text(text):
    """Where the text of the next row is another one."""
    return pa.concat_arrays([pc.not_equal(text.slice(0, len(text) - 1), text.slice(1)), pa.array([True])])


def lists_of_runs(text):
    """Runs of equal values as lists."""
    return pa.ListArray.from_arrays(_offsets_after(_last_of_text(text)), text)


def group_texts(text, a, b, shared, of_a, of_b, numerals_a, numerals_b):
    """For every text in order ``a1,a2|b1;a3|b2,b3`` over its groups; and its number of groups.

    ``numerals`` are the ids in decimal, place by place.
    """

    def side(ids, own, numerals):
        closing = shared.filter(own)
        words = pc.take(numerals, ids.filter(own))
        return pc.binary_join(pa.ListArray.from_arrays(_offsets_after(closing), words), ",")

    groups = pc.binary_join_element_wise(side(a, of_a, numerals_a), side(b, of_b, numerals_b), "|")
    offsets = _offsets_after(_last_of_text(text.filter(shared)))
    lists = pa.ListArray.from_arrays(offsets, groups)
    return pc.binary_join(lists, ";"), pc.list_value_length(lists)


def pairs_of_texts(text, a, b):
    """``text, pair, times``: the different pairs of ids linked in each text, ``pair`` being a * 2^32 + b."""
    pair = pc.bit_wise_or(pc.shift_left(pc.cast(a, pa.int64()), 32), pc.cast(b, pa.int64()))
    counted = pa.table({"text": text, "pair": pair, "one": pair}).group_by(["text", "pair"], use_threads=False)
    counted = counted.aggregate([("one", "count")])
    return pa.table({"text": counted["text"], "pair": counted["pair"], "times": counted["one_count"]})


def pair_dictionary(pairs):
    """The different pairs of many texts, most frequent first, with the number of texts of each;
    and for each text its pairs as places in that list, with their times (``text, place, times``)."""
    counts = pairs.select(["pair"]).group_by("pair", use_threads=False).aggregate([([], "count_all")])
    counts = counts.sort_by([("count_all", "descending"), ("pair", "ascending")]).combine_chunks()
    place = pc.index_in(pairs["pair"], value_set=counts["pair"].combine_chunks())
    placed = pa.table({"text": pairs["text"], "place": place, "times": pairs["times"]}).sort_by([("text", "ascending"), ("place", "ascending")])
    return counts, placed


def lists_by_text(placed, rows: int):
    """``place`` and ``times`` as one list per text."""
    placed = placed.combine_chunks()
    if not placed.num_rows:
        empty = pa.array([[]] * rows, pa.list_(pa.int32()))
        return empty, empty
    sizes = placed.group_by("text", use_threads=False).aggregate([([], "count_all")])
    found = pc.index_in(pa.array(range(rows), pa.int64()), value_set=pc.cast(sizes["text"], pa.int64()).combine_chunks())
    per_text = pc.fill_null(pc.take(sizes["count_all"], found), 0)
    ends = pc.cast(pc.cumulative_sum(per_text), pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), *(ends.chunks if isinstance(ends, pa.ChunkedArray) else [ends])])
    return tuple(
        pa.ListArray.from_arrays(offsets, pc.cast(placed[c], pa.int32()).combine_chunks()) for c in ("place", "times")
    )


def summed_over_pairs(places, times, documents, best):
    """Per text: links whose pair is ``best``, and the sum of ``documents`` over its links."""
    flat, parents = pc.list_flatten(places), pc.list_parent_indices(places)
    n = pc.cast(pc.list_flatten(times), pa.int64())
    table = pa.table(
        {
            "text": parents,
            "best": pc.multiply(n, pc.cast(pc.take(best, flat), pa.int64())),
            "sum": pc.multiply(n, pc.take(documents, flat)),
        }
    )
    sums = table.group_by("text", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
    found = pc.index_in(pa.array(range(len(places)), pa.int64()), value_set=pc.cast(sums["text"], pa.int64()).combine_chunks())
    zero = lambda c: pc.fill_null(pc.take(sums[c].combine_chunks(), found), 0)
    return zero("best_sum"), zero("sum_sum")


def aligned_texts(texts: list[str | None], a, b, with_groups: bool):
    """``n_a, n_b, n_groups, n_links, groups, groups_sha256`` as columns for the texts, and the table
    ``text, pair, times`` of the pairs that they link; ``a`` and ``b`` are ``kernels.byte_tokens`` and ``piece_tokens``."""
    import hashlib

    rows = len(texts)
    some = [k for k, t in enumerate(texts) if t]
    wanted = pa.array([(" " + texts[k]).encode("utf-8", "surrogatepass") for k in some], pa.binary())
    ids = [id_lists(t.encode([texts[k] for k in some])) for t in (a, b)]
    spelled = pc.and_(same_bytes(ids[0], a.bytes, wanted), same_bytes(ids[1], b.bytes, wanted))
    some = pa.array(some, pa.int32()).filter(spelled)
    if not len(some):
        zero = pa.array([0] * rows, pa.int64())
        empty = pa.array([""] * rows)
        none = pa.table({"text": pa.array([], pa.int32()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})
        return [zero, zero, zero, zero, empty if with_groups else pa.nulls(rows, pa.string()), empty], none
    ids = [i.filter(spelled) for i in ids]
    ends = [token_ends(i, t.sizes) for i, t in zip(ids, (a, b))]
    text, left, right, shared, of_a, of_b = linked_tokens(*ends)
    groups, n_groups = group_texts(text, left, right, shared, of_a, of_b, a.numerals, b.numerals)
    n_links = pc.list_value_length(lists_of_runs(text))
    digests = pa.array([hashlib.sha256(g.encode()).hexdigest() for g in groups.to_pylist()])
    place = pc.index_in(pa.array(range(rows), pa.int32()), value_set=some)

    def spread(column, missing):
        return pc.fill_null(pc.take(column, place), missing)

    counts = [spread(pc.cast(c, pa.int64()), 0) for c in (*map(pc.list_value_length, ids), n_groups, n_links)]
    pairs = pairs_of_texts(text, left, right)
    pairs = pairs.set_column(0, "text", pc.take(some, pairs["text"]))
    return [*counts, spread(groups, "") if with_groups else pa.nulls(rows, pa.string()), spread(digests, "")], pairs
