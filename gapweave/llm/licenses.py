"""Licence scan by canonical digest lookup.

A text is reduced to a canonical form (ASCII case, punctuation, copyright lines, equivalent
spellings, white space), and the digest of the whole is joined to the digests of known licences.
The lines of a document are looked up in the same way, which finds one-line notices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Licence texts as published, without their copyright lines.
_PERMISSIVE_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
) + _PERMISSIVE_END
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. "
) + _ISC_END
_ZERO_BSD = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
) + _ISC_END
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
    "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
    "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
    "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
    "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
    "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
_APACHE_NOTICE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
    "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License."
)
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("0BSD", _ZERO_BSD),
    ("Zlib", _ZLIB),
    ("BSD-2-Clause", f"{_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_START} {_BSD_THIRD} {_BSD_END}"),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
)

# Spellings that count as the same word.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("sub license", "sublicense"),
    ("favour", "favor"),
    ("https", "http"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COPYRIGHT_LINE = r"(?m)^[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*$"
_RESERVED_LINE = r"(?m)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"
_NOT_WORDS = r"[ \t\x0B\x0C\r!-/:-@\[-`{-~“”„‘’–—]+"


def _canonical(text: str, replace_all) -> str:
    """SQL text of the canonical form, lines kept; ``replace_all(text, pattern, by)`` is the dialect's."""
    out = f"translate({text}, '{_UPPER}', '{_LOWER}')"
    out = replace_all(out, _COPYRIGHT_LINE, "")
    out = replace_all(out, _RESERVED_LINE, "")
    out = replace_all(out, _NOT_WORDS, " ")
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    return out


def _in_spark(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, r'{pattern}', '{by}')"


def _in_duckdb(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def canonical(docs: DataFrame) -> DataFrame:
    """Add ``_lines``, the canonical form with its lines, to a table with ``text`` (null: empty)."""
    return docs.withColumn("_lines", F.expr(_canonical("coalesce(text, '')", _in_spark)))


_WHOLE = "trim(BOTH ' ' FROM regexp_replace({0}, r'[ \\n]+', ' '))"


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``license, known_digest, known_size`` of the given licence texts, one row per digest."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in known])
    texts = spark.range(1).select(F.inline(rows))
    whole = F.expr(_WHOLE.format("_lines"))
    return (
        canonical(texts)
        .select("license", F.md5(whole).alias("known_digest"), F.length(whole).alias("known_size"))
        .groupBy("known_digest", "known_size")
        .agg(F.min("license").alias("license"))
    )


def scan(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``doc_id, canonical_size, digest, license, notices`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  ``license`` is the licence
    whose text the whole document is, else null; ``notices`` are the licences that a line of the
    document names, each once, sorted and comma-joined.  A null text counts as empty; an empty
    canonical form matches nothing.  Every row is answered by itself, so repeats agree.
    """
    table = known_digests(docs.sparkSession, known).where("known_size > 0")
    # As many rows as KNOWN has texts: a constant of the program, not of the data.
    by_digest = {r["known_digest"]: (r["license"], r["known_size"]) for r in table.collect()}
    sizes = F.array(*[F.lit(n) for n in sorted({n for _, n in by_digest.values()})])
    names = F.create_map(*[F.lit(x) for digest, (name, _) in by_digest.items() for x in (digest, name)])
    whole = F.expr(_WHOLE.format("_lines"))
    lines = F.transform(F.split("_lines", "\n"), lambda line: F.trim(line))
    candidates = F.filter(lines, lambda line: F.array_contains(sizes, F.length(line)))
    found = F.filter(F.transform(candidates, lambda line: F.element_at(names, F.md5(line))), lambda name: name.isNotNull())
    digests = (
        canonical(docs.select("doc_id", F.col("text").cast("string").alias("text")))
        .select("doc_id", whole.alias("_whole"), F.array_join(F.sort_array(F.array_distinct(found)), ",").alias("notices"))
        .select("doc_id", F.length("_whole").alias("canonical_size"), F.md5("_whole").alias("digest"), "notices")
    )
    return digests.join(
        F.broadcast(table.select("known_digest", "license")), F.col("digest") == F.col("known_digest"), "left"
    ).select("doc_id", "canonical_size", "digest", "license", "notices")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DUCK_WHOLE = "trim(regexp_replace(_lines, '[ \\n]+', ' ', 'g'), ' ')"
SCAN_SQL = f"""
WITH known_texts(license, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}),
k AS (
  SELECT min(license) AS license, md5({_DUCK_WHOLE}) AS known_digest
  FROM (SELECT license, {_canonical("text", _in_duckdb)} AS _lines FROM known_texts) GROUP BY 2),
d AS (
  SELECT row_number() OVER () AS n, doc_id, {_canonical("coalesce(text, '')", _in_duckdb)} AS _lines FROM documents),
l AS (
  SELECT n, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
  FROM (SELECT n, unnest(string_split(_lines, chr(10))) AS line FROM d) JOIN k ON md5(trim(line, ' ')) = k.known_digest
  WHERE trim(line, ' ') <> '' GROUP BY n)
SELECT d.doc_id, CAST(length({_DUCK_WHOLE}) AS INTEGER) AS canonical_size, md5({_DUCK_WHOLE}) AS digest, k.license,
       coalesce(l.notices, '') AS notices
FROM d LEFT JOIN l USING (n) LEFT JOIN k ON md5({_DUCK_WHOLE}) = k.known_digest AND {_DUCK_WHOLE} <> ''
"""
