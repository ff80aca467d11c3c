"""Lossless byte-level tokenizer and operations on id arrays.

Reading UTF-8 bytes as Latin-1 gives a string with one character per byte whose code
point is the byte value.  Marker texts are replaced by the single character whose code
point is the marker id, so one pass over the characters yields all ids.  Ids come in Arrow
batches, four bytes an id; ``count_ids`` counts them without building any.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from gapweave.functions import idarrays
from gapweave.params import Markers

LATIN1 = "ISO-8859-1"
IDS = ArrayType(IntegerType(), containsNull=False)


def empty(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")


def byte_ids(content: Column) -> Column:
    """Ids of raw bytes, without marker handling."""
    return F.arrow_udf(idarrays.of_bytes, IDS)(content.cast("binary"))


def _marked(text: Column, markers: Markers) -> Column:
    """One character per id, whose code point is the id."""
    chars = F.decode(F.encode(text, "UTF-8"), LATIN1)
    for marker, marker_id in markers.id_by_text().items():
        chars = F.replace(chars, F.lit(marker), F.lit(chr(marker_id)))
    return chars


def encode_text(text: Column, markers: Markers = Markers()) -> Column:
    replaced = [(marker, chr(marker_id)) for marker, marker_id in markers.id_by_text().items()]
    return F.arrow_udf(idarrays.text_encoder(replaced), IDS)(text)


def count_ids(text: Column, markers: Markers = Markers()) -> Column:
    """The number of ids of ``encode_text``."""
    return F.length(_marked(text, markers))


def count_middle_ids(text: Column, markers: Markers = Markers()) -> Column:
    """``tail_middle_length`` of the ids of ``encode_text``."""
    chars = _marked(text, markers)
    at = F.instr(chars, F.lit(chr(markers.middle_id)))
    return F.when(at > 0, F.length(chars) - at - 1)


def decode_ids(ids: Column, markers: Markers | None = None) -> Column:
    """Text of the ids.  Markers are skipped, or kept when ``markers`` is given."""

    def as_char(i: Column) -> Column:
        out = F.when(i < 256, F.chr(i))
        if markers is not None:
            for marker, marker_id in markers.id_by_text().items():
                out = out.when(i == marker_id, F.lit(marker))
        return out.otherwise(F.lit(""))

    raw = F.encode(F.array_join(F.transform(ids, as_char), ""), LATIN1)
    return F.make_valid_utf8(raw.cast("string"))


def psm_ids(prefix: Column, suffix: Column, middle: Column, markers: Markers = Markers()) -> Column:
    """Marker-separated ids in the order prefix, suffix, middle."""
    return F.concat(
        F.array(F.lit(markers.prefix_id)),
        prefix,
        F.array(F.lit(markers.suffix_id)),
        suffix,
        F.array(F.lit(markers.middle_id)),
        middle,
        F.array(F.lit(markers.eos_id)),
    )


def psm_text(prefix: Column, suffix: Column, middle: Column, markers: Markers = Markers()) -> Column:
    return F.concat(
        F.lit(markers.prefix), prefix, F.lit(markers.suffix), suffix, F.lit(markers.middle), middle, F.lit(markers.eos)
    )


def first_index(ids: Column, token_id: int) -> Column:
    """0-based first position of an id; -1 where it is absent."""
    return F.array_position(ids, F.lit(token_id)).cast("int") - 1


def tail_middle_length(ids: Column, markers: Markers = Markers()) -> Column:
    """Ids after the middle marker, less the closing one; null without a middle marker."""
    at = first_index(ids, markers.middle_id)
    return F.when(at >= 0, F.size(ids) - at - 2)


def closed_middle_length(ids: Column, markers: Markers = Markers()) -> Column:
    """Ids between the middle marker and the next end marker; null if either is missing."""
    at = first_index(ids, markers.middle_id)
    after = F.slice(ids, at + 2, F.greatest(F.size(ids) - at - 1, F.lit(0)))
    end = F.array_position(after, F.lit(markers.eos_id)).cast("int")
    return F.when((at >= 0) & (end > 0), end - 1)


def well_formed(ids: Column, markers: Markers = Markers()) -> Column:
    """All four markers present, first occurrences in the order prefix, suffix, middle, end."""
    p, s, m, e = (
        first_index(ids, i) for i in (markers.prefix_id, markers.suffix_id, markers.middle_id, markers.eos_id)
    )
    return F.coalesce((p >= 0) & (p < s) & (s < m) & (m < e), F.lit(False))


def part(ids: Column, after_id: int, before_id: int) -> Column:
    """Ids strictly between the first occurrences of two markers."""
    a, b = first_index(ids, after_id), first_index(ids, before_id)
    return F.slice(ids, a + 2, b - a - 1)


def prompt_ids(prefix: Column, suffix: Column, markers: Markers = Markers()) -> Column:
    return F.concat(
        F.array(F.lit(markers.prefix_id)),
        prefix,
        F.array(F.lit(markers.suffix_id)),
        suffix,
        F.array(F.lit(markers.middle_id)),
    )


def mask_leading(ids: Column, n: Column, pad_label: int) -> Column:
    """Labels equal to the ids, with the first ``n`` replaced by the pad label."""
    return F.concat(
        F.array_repeat(F.lit(pad_label).cast("int"), F.least(n, F.size(ids)).cast("int")),
        F.slice(ids, n + 1, F.greatest(F.size(ids) - n, F.lit(0))),
    )


def drop_leading(ids: Column, n: Column) -> Column:
    return F.slice(ids, n + 1, F.greatest(F.size(ids) - n, F.lit(0)))


def pad_right(ids: Column, length: Column, value: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(value).cast("int"), (length - F.size(ids)).cast("int")))


def pad_left(ids: Column, length: Column, value: int) -> Column:
    return F.concat(F.array_repeat(F.lit(value).cast("int"), (length - F.size(ids)).cast("int")), ids)


def ones(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def clean_generation(text: Column, markers: Markers = Markers()) -> Column:
    from gapweave.functions.text import strip

    return strip(F.replace(text, F.lit(markers.pad), F.lit("")))
