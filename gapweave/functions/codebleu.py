"""CodeBLEU: n-grams, keyword-weighted n-grams, trees, data flow.

The syntax part compares the trees of brackets and statements, the data-flow part the edges from
definitions to uses, see ``codeflow``.  Both read tokens, not a grammar.  A reference and its candidates
are read and compared together, in Arrow batches; only counts come back.

Arguments are column names or SQL expressions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions import codeflow
from gapweave.functions.metrics import CODEBLEU_LANGUAGES, bleu_of_counts, keyword_bleu_of_counts

# Reserved words shared by most of the supported languages, then additions.
SHARED_KEYWORDS = (
    "break case catch class const continue default do else enum finally for goto if import in interface new "
    "return static struct switch this throw try void while int long short float double char bool boolean true false null"
).split()
EXTRA_KEYWORDS = {
    "c": "auto extern inline register signed sizeof typedef union unsigned volatile restrict".split(),
    "cpp": "auto extern inline namespace operator private protected public sizeof template typedef typename union using virtual".split(),
    "python": "and as assert async await def del elif except from global is lambda None nonlocal not or pass raise self True False with yield".split(),
    "java": "abstract extends final implements instanceof package private protected public super synchronized throws".split(),
    "javascript": "async await delete export extends function let of super typeof undefined var yield".split(),
    "go": "chan defer fallthrough func go map nil package range select type var string".split(),
    "rust": "as crate fn impl let loop match mod move mut pub ref self trait type unsafe use where".split(),
    "ruby": "and begin def elsif end ensure module nil not or rescue self then unless until when yield".split(),
    "php": "abstract array as echo elseif extends foreach function global implements namespace private protected public use var".split(),
}

# The types of what is kept of the reference and of a candidate.
REFERENCE = "struct<n_words:int,keywords:int,trees:int,edges:int>"
CANDIDATE = "struct<n_words:int,g1:int,g2:int,g3:int,g4:int,keywords:int,trees:int,edges:int>"


def keywords(language: str) -> list[str]:
    return SHARED_KEYWORDS + EXTRA_KEYWORDS.get(language, [])


def compared(ref: str, candidates: list[str], language: str) -> Column:
    """All that the scores need of a reference and its candidates: sizes, and what is shared of runs of words,
    key words, trees and data flow.  Every text is read once.
    """
    listed = frozenset(keywords(language))

    def run(*texts: pa.Array) -> pa.Array:
        return codeflow.compared(texts[0], texts[1:], language, listed)

    fields = [f"ref {REFERENCE}", *[f"c{k} {CANDIDATE}" for k in range(len(candidates))]]
    return F.arrow_udf(run, ", ".join(fields))(*[F.expr(text).cast("string") for text in (ref, *candidates)])


def scorable(found: str, language: str) -> Column:
    """Supported language, and a reference with at least one tree and one data-flow edge."""
    if language not in CODEBLEU_LANGUAGES:
        return F.lit(False)
    return F.expr(f"coalesce({found}.ref.trees > 0 and {found}.ref.edges > 0, false)")


def codebleu(found: str, candidate: int, weights=(0.1, 0.1, 0.4, 0.4)) -> Column:
    """Weighted sum of the four parts; apply ``scorable`` to the reference first."""
    r, p = f"{found}.ref", f"{found}.c{candidate}"

    def shared(items: str) -> str:
        return f"cast({p}.{items} as double)"

    def recall(items: str) -> str:
        return f"if({r}.{items} = 0, 0D, {shared(items)} / {r}.{items})"

    def n_gram_parts(h: str) -> str:
        plain = bleu_of_counts(f"{r}.n_words", f"{p}.n_words", h)
        weighted = keyword_bleu_of_counts(f"{r}.n_words", f"{p}.n_words", h, shared("keywords"), f"{r}.keywords")
        return f"{float(weights[0])}D * {plain} + {float(weights[1])}D * {weighted}"

    hits = f"array({', '.join(shared(f'g{k}') for k in range(1, 5))})"
    total = f"{n_gram_parts(hits)} + {float(weights[2])}D * {recall('trees')} + {float(weights[3])}D * {recall('edges')}"
    return F.expr(f"coalesce({total}, 0D)")


def with_codebleu(
    df: DataFrame, ref: str, candidates: dict[str, str], language: str, weights=(0.1, 0.1, 0.4, 0.4)
) -> DataFrame:
    """Add ``codebleu_valid`` and one score column per candidate (``{column: text}``).

    An unsupported language or a reference without structure gives 0.
    """
    if language not in CODEBLEU_LANGUAGES:
        return df.select("*", F.lit(False).alias("codebleu_valid"), *[F.lit(0.0).alias(c) for c in candidates])
    found = df.select("*", compared(ref, list(candidates.values()), language).alias("_code"))
    valid = scorable("_code", language)
    scores = [F.when(valid, codebleu("_code", k, weights)).otherwise(0.0).alias(c) for k, c in enumerate(candidates)]
    return found.select(*df.columns, valid.alias("codebleu_valid"), *scores)
