"""Spark SQL text for expressions with many nested lambdas.

A scanner or a BLEU score is one expression of some hundred nodes.  Built node by node
through the Python Column API each node is a round trip to the JVM, and planning a query
takes seconds before it starts; as SQL text it is parsed in one call.  All helpers take and
return SQL text; ``F.expr`` turns the finished text into a Column.
"""

from __future__ import annotations

import inspect
import itertools
from collections.abc import Callable

from gapweave.functions.text import TO_LAST_NON_BLANK, WHITESPACE, WORD_PATTERN

_numbers = itertools.count()


def lit(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\x01", "\\u0001") + "'"


def _lambda(fn: Callable[..., str]) -> str:
    # Numbered names keep a lambda variable from shadowing one of an enclosing lambda.
    names = [f"{p}_{next(_numbers)}" for p in inspect.signature(fn).parameters]
    head = names[0] if len(names) == 1 else f"({', '.join(names)})"
    return f"{head} -> {fn(*names)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return f"get(transform(array({value}), {_lambda(body)}), 0)"


def transform(items: str, fn: Callable[..., str]) -> str:
    return f"transform({items}, {_lambda(fn)})"


def keep(items: str, fn: Callable[..., str]) -> str:
    return f"filter({items}, {_lambda(fn)})"


def zip_with(left: str, right: str, fn: Callable[..., str]) -> str:
    return f"zip_with({left}, {right}, {_lambda(fn)})"


def fold(items: str, start: str, step: Callable[..., str], finish: Callable[[str], str]) -> str:
    return f"aggregate({items}, {start}, {_lambda(step)}, {_lambda(finish)})"


def regexp_replace(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(by)})"


def regexp_extract_all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {lit(pattern)}, 0)"


def lstrip(text: str) -> str:
    return regexp_replace(text, rf"\A{WHITESPACE}+")


def rstrip(text: str) -> str:
    # Up to the last character that isn't white space, found from the end.
    return f"regexp_extract({text}, {lit(TO_LAST_NON_BLANK)}, 0)"


def squeeze(text: str) -> str:
    return regexp_replace(lstrip(rstrip(text)), f"{WHITESPACE}+", " ")


def words(text: str) -> str:
    """Words and single punctuation marks; the fixed tokenization of the BLEU scores."""
    return regexp_extract_all(text, WORD_PATTERN)


def index_range(n: str) -> str:
    """``[0, 1, ..., n-1]``; empty for n <= 0 (a bare ``sequence`` would count down)."""
    return f"if({n} > 0, sequence(0, cast({n} as int) - 1), cast(array() as array<int>))"
