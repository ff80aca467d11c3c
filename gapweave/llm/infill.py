"""Fill-in-the-middle transformation as a pipeline of ``pyarrow.compute`` kernels.

A text is cut into lines.  Two cuts between lines, drawn from a hash of the document's id, give a
prefix, a middle and a suffix, which are put out with markers in the order psm (prefix, suffix,
middle) or spm (suffix, prefix, middle).  A batch of texts becomes list arrays of lines, these are
flattened with their parents' numbers, every line gets its ordinal in its text and by that its
role, the lines of a role are filtered and put into lists again, and the lists are joined.

Nulls and empty texts have no line and stay plain; a null id draws its cuts like an id without
digits; repeated rows are transformed alike; a text without line breaks is one line.  Texts of any
length are processed whole: a slice of a batch ends after ``SLICE_BYTES`` of text or with one text.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.llm import arrays

SEED = 7
MARKERS = ("<P>", "<S>", "<M>")
#: Of 100 texts, how many are transformed, and how many of these in the order spm.
RATE, SPM_RATE = 100, 50
SLICE_BYTES = 8 << 20

COLUMNS = "n bigint, form string, prefix string, middle string, suffix string, output string"


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit integers from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def infill(
    docs: DataFrame,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    seed: int = SEED,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """``doc_id, n, form, prefix, middle, suffix, output`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  ``n`` is the number of
    lines; ``form`` is ``plain`` (output is the text, parts are null: empty texts, texts that
    contain a marker, and those left out by ``rate``), ``psm`` or ``spm``.
    """

    def run(batches):
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 5]
        names = ["doc_id", "n", "form", "prefix", "middle", "suffix", "output"]
        for batch in batches:
            for some in arrays.byte_slices(batch, 1, SLICE_BYTES):
                out = arrays.infilled(some.column(1), [some.column(k) for k in range(2, 6)], rate, spm_rate, markers)
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(a, kind) for a, kind in zip([some.column(0), *out], kinds)], names
                )

    draws = [draw.alias(f"h{k}") for k, draw in enumerate(_draws(F.col("doc_id"), seed))]
    picked = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *draws)
    return picked.mapInArrow(run, f"doc_id bigint, {COLUMNS}")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text again, from the output and its form alone.

    The first marker starts the output; the other two stand once each, as no transformed text
    contains a marker and no marker can begin or end inside a text beside it.
    """
    p, s, m = markers

    def between(after: str, until: str | None):
        rest = F.substring_index(output, after, -1)
        return rest if until is None else F.substring_index(rest, until, 1)

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


INFILL_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
c AS (
  SELECT *, len(lines) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(lines) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(lines) + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS c4
  FROM d),
p AS (
  SELECT *,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 100 THEN 'plain'
              WHEN c4 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(lines[1:least(a, b)], '') AS prefix,
         array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(lines[greatest(a, b) + 1:], '') AS suffix
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
