"""Per-row scores of a prediction against a reference; no shuffle in any of them.

Arguments are column names or SQL expressions, results are Columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from gapweave.functions import text as X
from gapweave.functions.arrays import gram_lists, multiset_overlap
from gapweave.functions.sqltext import keep, let, lit, words

# Fixed value: the smoothing epsilon of the published BLEU "method 1".
BLEU_EPSILON = 0.1
# Fixed value: weight of a token that is not a keyword in the weighted n-gram match.
PLAIN_TOKEN_WEIGHT = 0.2

# Languages for which a CodeBLEU score is defined.
CODEBLEU_LANGUAGES = ("python", "java", "javascript", "c", "cpp", "go", "php", "ruby", "rust")

EVEN = (0.25, 0.25, 0.25, 0.25)


def exact_match(ref: str, pred: str) -> Column:
    return F.coalesce((X.squeeze(F.expr(ref)) == X.squeeze(F.expr(pred))).cast("double"), F.lit(0.0))


def line_match(ref: str, pred: str, n: int) -> Column:
    def head(text: str) -> Column:
        return F.transform(F.slice(X.lines(F.expr(text)), 1, n), X.rstrip)

    score = F.transform(
        F.array(F.struct(head(ref).alias("r"), head(pred).alias("p"))),
        lambda v: ((F.size(v["r"]) > 0) & (F.slice(v["p"], F.lit(1), F.size(v["r"])) == v["r"])).cast("double"),
    )
    return F.coalesce(F.get(score, F.lit(0)), F.lit(0.0))


def _similarity_udf():
    """Arrow function for ``1 - distance / longer length``.

    The helpers are local so that they travel to the workers by value and the package need
    not be installed there.
    """

    def same_start(a, b):
        # How many characters agree from the start on, by bisection.
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if a[low:middle] == b[low:middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def edit_distance(a, b):
        # Levenshtein distance by the bit-vector recurrence of Myers and Hyyroe: a column of
        # the distance table is two integers with one bit per character.  What both texts begin
        # and end with costs nothing; steps go over the shorter text, bits over the longer one.
        start = same_start(a, b)
        a, b = a[start:], b[start:]
        end = same_start(a[::-1], b[::-1])
        a, b = a[: len(a) - end], b[: len(b) - end]
        if len(a) > len(b):
            a, b = b, a
        if not a:
            return len(b)
        positions = dict.fromkeys(a, 0)
        at = {}
        for i, char in enumerate(b):
            if char in positions:
                at.setdefault(char, []).append(i)
        for char, places in at.items():
            marks = bytearray(len(b) // 8 + 1)
            for i in places:
                marks[i >> 3] |= 1 << (i & 7)
            positions[char] = int.from_bytes(marks, "little")
        full = (1 << len(b)) - 1
        rises, falls = full, 0
        for match in map(positions.__getitem__, a):
            match |= falls
            diagonal = ((((match & rises) + rises) ^ rises) | match) & full
            row_up, row_down = falls | ((diagonal | rises) ^ full), rises & diagonal
            row_up = (row_up << 1) | 1
            rises, falls = ((row_down << 1) | ((row_up | diagonal) ^ full)) & full, row_up & diagonal
        # The last column starts at the length of what was stepped over.
        return len(a) + rises.bit_count() - falls.bit_count()

    def similarity(ref: pd.Series, pred: pd.Series) -> pd.Series:
        return pd.Series(
            [1.0 - edit_distance(p, r) / max(len(p), len(r)) if p and r else 0.0 for r, p in zip(ref, pred)],
            dtype="float64",
        )

    return F.pandas_udf(similarity, "double")


def edit_similarity(ref: str, pred: str) -> Column:
    """``1 - distance / longer length`` in characters; null counts as empty.

    The built-in ``levenshtein`` walks the table cell by cell, which takes some ten
    milliseconds for texts of 500 characters; the Arrow helper takes well under one.
    """
    r, p = F.coalesce(F.expr(ref), F.lit("")), F.coalesce(F.expr(pred), F.lit(""))
    return (
        F.when(r == p, 1.0).when((r == "") | (p == ""), 0.0).otherwise(_similarity_udf()(r, p))
    )


def _geometric(hits: list[str], totals: list[str], weights, n_pred: str, n_ref: str) -> str:
    """Brevity penalty times the weighted geometric mean of smoothed ratios; 0 without a unigram hit."""
    logs = " + ".join(
        f"{float(w)}D * ln(if({hit} = 0, {BLEU_EPSILON}D, {hit}) / {total})"
        for w, hit, total in zip(weights, hits, totals)
    )
    brevity = f"case when {n_pred} > {n_ref} then 1D when {n_pred} = 0 then 0D else exp(1 - {n_ref} / {n_pred}) end"
    return f"if({hits[0]} = 0, 0D, ({brevity}) * exp({logs}))"


def gram_hits(ref_grams: str, pred_grams: str, orders: int = 4) -> str:
    """Clipped matches for n = 1 .. orders, as an array."""
    return f"array({', '.join(multiset_overlap(f'{pred_grams}[{k}]', f'{ref_grams}[{k}]') for k in range(orders))})"


def bleu_text(ref_grams: str, pred_grams: str, hits: str, weights=EVEN) -> str:
    """BLEU from the n-gram lists of both sides (see ``gram_lists``) and their ``gram_hits``."""
    return bleu_of_counts(f"size({ref_grams}[0])", f"size({pred_grams}[0])", hits, weights)


def bleu_of_counts(n_ref: str, n_pred: str, hits: str, weights=EVEN) -> str:
    orders = range(len(weights))
    totals = [f"greatest({n_pred} - {k}, 1)" for k in orders]
    return _geometric([f"{hits}[{k}]" for k in orders], totals, weights, n_pred, n_ref)


def keyword_bleu_text(
    ref_grams: str, pred_grams: str, hits: str, keyword_hits: str, n_ref_keywords: str, weights=EVEN
) -> str:
    """Keyword BLEU from the n-gram lists of both sides, see ``keyword_bleu_of_counts``."""
    n_ref, n_pred = f"size({ref_grams}[0])", f"size({pred_grams}[0])"
    return keyword_bleu_of_counts(n_ref, n_pred, hits, keyword_hits, n_ref_keywords, weights)


def keyword_bleu_of_counts(n_ref: str, n_pred: str, hits: str, keyword_hits: str, n_ref_keywords: str, weights=EVEN) -> str:
    """Recall form of BLEU in which unigrams count 1 for keywords and less for other tokens.

    With two weights only, the weighted sums follow from the plain sums and the sums over
    keywords alone.
    """

    def weighted(all_tokens: str, keyword_tokens: str) -> str:
        return f"({PLAIN_TOKEN_WEIGHT}D * {all_tokens} + {1 - PLAIN_TOKEN_WEIGHT}D * {keyword_tokens})"

    orders = range(1, len(weights))
    hit_list = [weighted(f"{hits}[0]", keyword_hits)] + [f"{hits}[{k}]" for k in orders]
    totals = [f"if({n_ref} = 0, 1D, {weighted(n_ref, n_ref_keywords)})"]
    totals += [f"greatest({n_ref} - {k}, 1)" for k in orders]
    return _geometric(hit_list, totals, weights, n_pred, n_ref)


def keyword_tokens(tokens: str, keywords: list[str]) -> str:
    listed = ", ".join(lit(k) for k in keywords)
    return keep(tokens, lambda t: f"{t} in ({listed})") if keywords else "cast(array() as array<string>)"


def _with_grams(ref: str, pred: str, orders: int, score) -> Column:
    grams = f"named_struct('r', {gram_lists(words(ref), orders)}, 'p', {gram_lists(words(pred), orders)})"
    scored = let(grams, lambda v: let(gram_hits(f"{v}.r", f"{v}.p", orders), lambda h: score(f"{v}.r", f"{v}.p", h)))
    return F.expr(f"coalesce({scored}, 0D)")


def _sentence_bleu_udf(weights):
    """Arrow function for BLEU of two columns of words; whole batches as numpy columns.

    Runs of words are numbered exactly, level by level: a run is its first words' number and
    one more word.  Numbers are those of a row, so counts of both sides stand side by side.
    """

    def counted(runs, side, row, rows):
        n = int(runs.max()) + 1 if len(runs) else 0
        both = np.minimum(np.bincount(runs[side], minlength=n), np.bincount(runs[~side], minlength=n))
        of = np.zeros(n, dtype=np.int64)
        of[runs] = row
        return np.bincount(of, weights=both, minlength=rows)

    def lengths(lists):
        return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def scored(ref, pred):
        rows, n_ref, n_pred = len(ref), lengths(ref), lengths(pred)
        words = pa.concat_arrays([ref.flatten(), pred.flatten()]).dictionary_encode()
        word, kinds = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(words.dictionary), 1)
        sizes = np.concatenate([n_ref, n_pred])
        row = np.repeat(np.concatenate([np.arange(rows), np.arange(rows)]), sizes)
        stop, side = np.repeat(np.cumsum(sizes), sizes), np.arange(len(word)) < n_ref.sum()
        start, run, logs, first = np.arange(len(word)), row, np.zeros(rows), None
        for k, weight in enumerate(weights):
            whole = start + k < stop[start]
            start, run = start[whole], run[whole]
            run = np.unique(run * kinds + word[start + k], return_inverse=True)[1]
            hits = counted(run, side[start], row[start], rows)
            first = hits if k == 0 else first
            logs += weight * np.log(np.where(hits == 0, BLEU_EPSILON, hits) / np.maximum(n_pred - k, 1))
        brevity = np.where(n_pred > n_ref, 1.0, np.exp(1 - n_ref / np.maximum(n_pred, 1)))
        return np.where(first == 0, 0.0, brevity * np.exp(logs))

    def score(ref: pa.Array, pred: pa.Array) -> pa.Array:
        # Some rows at a time, about a million words.
        pieces = np.cumsum(lengths(ref) + lengths(pred)) >> 20
        bounds = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), len(ref)]
        some = [scored(ref[low:high], pred[low:high]) for low, high in zip(bounds, bounds[1:])]
        return pa.array(np.concatenate(some), pa.float64())

    return F.arrow_udf(score, "double")


def sentence_bleu(ref: str, pred: str, weights=EVEN) -> Column:
    """Sentence BLEU, one reference, clipped precision, zero counts replaced by epsilon."""
    return _sentence_bleu_udf(tuple(weights))(F.expr(words(ref)), F.expr(words(pred)))


def keyword_bleu(ref: str, pred: str, keywords: list[str], weights=EVEN) -> Column:
    def score(r: str, p: str, h: str) -> str:
        of_keywords = f"named_struct('r', {keyword_tokens(f'{r}[0]', keywords)}, 'p', {keyword_tokens(f'{p}[0]', keywords)})"
        return let(
            of_keywords,
            lambda k: keyword_bleu_text(r, p, h, multiset_overlap(f"{k}.p", f"{k}.r"), f"size({k}.r)", weights),
        )

    return _with_grams(ref, pred, len(weights), score)


def overlap_recall(ref_items: str, pred_items: str) -> str:
    """Share of the reference items also found in the prediction; 0 for an empty reference (SQL text)."""
    return f"if(size({ref_items}) = 0, 0D, {multiset_overlap(pred_items, ref_items)} / size({ref_items}))"


def perplexity(mean_nll: Column) -> Column:
    return F.coalesce(F.exp(mean_nll), F.lit(float("inf")))
