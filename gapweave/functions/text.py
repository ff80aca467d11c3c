"""Text predicates and clean-up steps as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# White space and line boundaries as Python strings define them.
WHITESPACE = r"(?U)[\s\x1c-\x1f]"
TO_LAST_NON_BLANK = r"(?sU)\A.*[^\s\x1c-\x1f]"
LINE_BREAK = r"\R|[\x1c-\x1e]"

# Keyword pairs of the whole top-level structures, in match order.
STRUCTURE_PAIRS = [
    ("FUNCTION_BLOCK", "END_FUNCTION_BLOCK"),
    ("FUNCTION", "END_FUNCTION"),
    ("PROGRAM", "END_PROGRAM"),
    ("TYPE", "END_TYPE"),
    ("CONFIGURATION", "END_CONFIGURATION"),
    ("VAR_GLOBAL", "END_VAR"),
    ("CLASS", "END_CLASS"),
    ("INTERFACE", "END_INTERFACE"),
    ("NAMESPACE", "END_NAMESPACE"),
    ("METHOD", "END_METHOD"),
    ("PROPERTY", "END_PROPERTY"),
]
STRUCTURE_PATTERN = r"(?is)\b(?:" + "|".join(rf"{a}\b.*?\b{b}" for a, b in STRUCTURE_PAIRS) + ")"

FIRST_WORD = r"(?U)^[\s\x1c-\x1f]*([^\s\x1c-\x1f]+)"
WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def utf8_text(content: Column) -> Column:
    """Decoded text, or null where the bytes are not valid UTF-8."""
    return F.try_validate_utf8(content.cast("string"))


def unix_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def path_suffix(path: Column) -> Column:
    """Lower-cased last suffix of the file name; a leading dot alone is no suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WHITESPACE}+|{WHITESPACE}+\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"{WHITESPACE}+\z", "")


def squeeze(text: Column) -> Column:
    """Stripped text with every run of white space turned into one space."""
    return F.regexp_replace(strip(text), f"{WHITESPACE}+", " ")


def lines(text: Column) -> Column:
    """Lines without their ends; a final line end opens no further line."""
    pieces = F.split(text, LINE_BREAK)
    return F.when(F.element_at(pieces, -1) == "", F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)


def strip_comments(text: Column) -> Column:
    """Remove ``(* ... *)`` and ``// ...`` comments."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)\(\*.*?\*\)", ""), r"//[^\n]*", "")


def trim_lines(text: Column) -> Column:
    return F.array_join(F.transform(lines(text), rstrip), "\n")


def collapse_blank_lines(text: Column) -> Column:
    """One empty line at most between lines, none at either end."""
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def clean(text: Column) -> Column:
    return collapse_blank_lines(trim_lines(strip_comments(text)))


def structures(text: Column) -> Column:
    """All whole top-level structures, in order of appearance."""
    return F.regexp_extract_all(text, F.lit(STRUCTURE_PATTERN), F.lit(0))


def leading_keyword(block: Column) -> Column:
    return F.upper(F.regexp_extract(block, FIRST_WORD, 1))


def words(text: Column) -> Column:
    """Words and single punctuation marks; the fixed tokenization of the BLEU scores."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
