"""Language identification by hierarchical discrimination.

A text's family is predicted first, by one linear support vector machine per family; within the
family a machine for every pair of languages votes.  Families are learnt too: languages are
merged by the likeness of their average trigram profiles.

The machines are trained on the driver from a bounded sample (``PER_LANGUAGE`` documents of each
language, drawn by a hash of the id); prediction is map-only over whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.llm import kernels

#: Expected number of documents of a language that the machines are trained on.
PER_LANGUAGE = 500
WIDTH = 8192
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids, by checksum, is kept from training; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, width: int = WIDTH) -> kernels.LanguageModel | None:
    """Fit on documents with a language and a text that are not held out; None if there are none.

    What comes to the driver is a count per language and the sample's trigram profiles.
    """
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    part = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    chance = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("train"), F.col("doc_id").cast("string"))), 1, 12), 16, 10)
    sample = labelled.where(chance.cast("double") / float(1 << 48) < F.element_at(part, F.col("lang")))

    def profiles(batches):
        for batch in batches:
            found = [kernels.trigram_features(text, width) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p for p, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float32())),
                ],
                ["lang", "places", "values"],
            )

    rows = sample.select("lang", "text").mapInArrow(profiles, "lang string, places array<int>, values array<float>")
    found = rows.toArrow()
    arrays = [
        [np.asarray(item.values) for item in found.column(name).combine_chunks()] for name in ("places", "values")
    ]
    examples = list(zip(found.column("lang").to_pylist(), *arrays))
    # In a fixed order, so that reruns train the same machines.
    examples.sort(key=lambda e: (e[0], e[1].tobytes(), e[2].tobytes()))
    return kernels.fit_languages(examples, width)


def identify(docs: DataFrame, model: kernels.LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from the text alone.

    A null text or one without a letter is ``und`` with score 0, as is every text where nothing
    could be learnt.  Columns other than ``doc_id`` and ``text`` are not read.
    """

    def run(batches):
        letter = regex.compile(r"\p{L}")
        for batch in kernels.slices(batches):
            found = []
            for text in batch.column(1).to_pylist():
                if model is None or not text or not letter.search(text):
                    found.append((UNDETERMINED, 0.0))
                else:
                    found.append(model.predict(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: kernels.LanguageModel | None, least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is determined with more than ``least_score``; columns unchanged."""
    names = docs.columns

    def run(batches):
        letter = regex.compile(r"\p{L}")
        for batch in kernels.slices(batches):
            kept = []
            for text in batch.column(names.index("text")).to_pylist():
                known = model is not None and bool(text) and letter.search(text) is not None
                kept.append(known and model.predict(text)[1] > least_score)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
