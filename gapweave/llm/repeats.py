"""Exact removal of long repeated substrings by suffix sorting.

Any two equal strings of ``LENGTH`` bytes have the same least ``GRAM``-byte gram, so all starts of
a text are cut into runs that share that gram (its hash is the run's key) and only runs with one
key can hold equal strings.  Keys met once are done.  Where all runs of a key have the same
content, each of their strings is repeated.  The other runs, one of each content, meet key by key:
their Burrows-Wheeler transform is expanded interval by interval up to ``LENGTH`` (kernels.
long_common_prefixes), which tells the strings that occur again.  A key with more than
``LARGEST`` contents doesn't fit one suffix sort: its runs are divided into parts that share more
bytes, which are compared in the same way; only where such a part is still met more often are its
strings counted by digest.

Counts run over all rows of the table.  Texts move through the cluster twice: to cut the runs that
must be compared, and to cut out what is repeated; otherwise rows are (key, place) pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm import kernels
from gapweave.operators.settle import settle

LENGTH = 200
GRAM = 32
MOST_STARTS = 4096  # per run: long periodic texts are cut
LARGEST = 1024  # contents of a key in one suffix sort
STEP = 16  # starts in a part of a run whose key has more contents
_SORT_BYTES = 2 << 20  # of runs sorted together
_ROWS = 1 << 16  # per output batch

_RUN_FORM = (
    "row bigint, doc_id bigint, digest binary, n_bytes bigint, whole_sha256 string, "
    "key bigint, content bigint, start int, count int, inner boolean"
)


def _digest():
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for every document (``key`` null) and one for each of its runs (``doc_id`` and so on null)."""

    def build(heads, runs):
        n, m = len(heads), len(runs)
        head, run = list(zip(*heads)) if n else [()] * 5, list(zip(*runs)) if m else [()] * 6
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string()]
        columns = [pa.array([*head[0], *run[0]], pa.int64())]
        columns += [pa.array([*head[k + 1], *([None] * m)], kind) for k, kind in enumerate(kinds)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        columns += [pa.array([*([None] * n), *run[k + 1]], kind) for k, kind in enumerate(kinds)]
        names = ["row", "doc_id", "digest", "n_bytes", "whole_sha256", "key", "content", "start", "count", "inner"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        heads, found = [], []
        for batch in kernels.slices(batches):
            for row, doc_id, digest, text in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                heads.append((row, doc_id, digest, len(raw), hashlib.sha256(raw).hexdigest()))
                found += [(row, *r) for r in kernels.anchored_runs(raw, length, gram, MOST_STARTS)]
                if len(found) > _ROWS:
                    yield build(heads, found)
                    heads, found = [], []
        if heads or found:
            yield build(heads, found)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _digest().alias("digest"), F.col("text").cast("string")
    )
    return numbered.mapInArrow(run, _RUN_FORM)


def _cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs: ``key, content, piece``.

    ``wanted`` has ``of, of_digest`` and an array of runs for each text.
    """

    def run(batches):
        for batch in kernels.slices(batches):
            keys, contents, pieces = [], [], []
            for text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for r in runs:
                    keys.append(r["key"])
                    contents.append(r["content"])
                    pieces.append(raw[r["start"] : r["start"] + r["count"] - 1 + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(contents, pa.int64()), pa.array(pieces, pa.binary())],
                ["key", "content", "piece"],
            )

    keyed = docs.select("doc_id", _digest().alias("digest"), F.col("text").cast("string"))
    return (
        keyed.join(wanted, (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of")))
        .select("text", "runs")
        .mapInArrow(run, "key bigint, content bigint, piece binary")
    )


def _sorted_together(pieces: DataFrame, length: int) -> DataFrame:
    """``key, content, first, last``: the runs' starts whose strings occur again in their group.

    ``pieces`` has ``group, key, content, base, piece``, ``base`` being the piece's place in its run.
    """

    def solve(names, texts):
        rows = []
        for (key, content, base), flags in zip(names, kernels.repeated_starts(texts, length)):
            rows += [(key, content, base + a, base + b) for a, b in kernels.true_runs(flags)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * 4, kinds)]
        return pa.RecordBatch.from_arrays(columns, ["key", "content", "first", "last"])

    def run(batches):
        names, texts, size, group = [], [], 0, None
        for batch in batches:
            for now, key, content, base, piece in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                if names and group == now and (key, content, base) == names[-1]:
                    continue  # a repeated row of the table
                if size > _SORT_BYTES and now != group:
                    yield solve(names, texts)
                    names, texts, size = [], [], 0
                group = now
                names.append((key, content, base))
                texts.append(piece)
                size += len(piece)
        if names:
            yield solve(names, texts)

    return (
        pieces.select("group", "key", "content", "base", "piece")
        .repartition("group")
        .sortWithinPartitions("group", "key", "content", "base")
        .mapInArrow(run, "key bigint, content bigint, first int, last int")
    )


def _counted(pieces: DataFrame, length: int) -> DataFrame:
    """The same for very large groups: every string's digest is counted."""
    starts = F.sequence(F.lit(0), F.octet_length("piece") - length)
    strings = (
        pieces.select("key", "content", "base", "piece", F.explode(starts).alias("at"))
        .select(
            "key",
            "content",
            (F.col("base") + F.col("at")).alias("first"),
            F.unhex(F.md5(F.substring("piece", F.col("at") + 1, F.lit(length)))).alias("string"),
        )
        .distinct()
    )
    again = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    return strings.join(again, "string").select("key", "content", "first", F.col("first").alias("last"))


def _divided(pieces: DataFrame, length: int, gram: int, largest: int) -> DataFrame:
    """The same for keys of very many contents: their runs are divided into parts (kernels.aligned_parts).

    Equal strings lie in parts of one name, so parts met once are done and the others are
    compared name by name.
    """
    step = min(STEP, length - gram + 1)

    def parts(batches):
        for batch in batches:
            rows = [
                (key, content, *part)
                for key, content, piece in zip(*[batch.column(k).to_pylist() for k in range(3)])
                for part in kernels.aligned_parts(piece, key, length, gram, step)
            ]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "content", "first", "count", "part"])

    form = "key bigint, content bigint, first int, count int, part bigint"
    divided = settle(pieces.select("key", "content", "piece").mapInArrow(parts, form).distinct())
    met = divided.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = (
        divided.join(met, "part")
        .groupBy("key", "content")
        .agg(F.collect_list(F.struct("part", "first", "count", "n")).alias("parts"))
    )
    cut = settle(
        pieces.join(wanted, ["key", "content"])
        .select("key", "content", "piece", F.explode("parts").alias("p"))
        .select(
            F.col("p.part").alias("group"),
            "key",
            "content",
            F.col("p.first").alias("base"),
            F.substring("piece", F.col("p.first") + 1, F.col("p.count") + (length - 1)).alias("piece"),
            F.col("p.n").alias("n"),
        )
    )
    small, large = F.col("n") <= largest, F.col("n") > largest
    return _sorted_together(cut.where(small), length).union(_counted(cut.where(large), length))


def repeated_spans(
    runs: DataFrame, heads: DataFrame, docs: DataFrame, length: int, gram: int, largest: int
) -> DataFrame:
    """``row, spans``: byte intervals ``[start, stop)`` of each row covered by repeated strings (unmerged)."""
    keys = (
        runs.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("content").alias("low"),
            F.max("content").alias("high"),
            F.max("inner").alias("inner"),
        )
        .where("n > 1 or inner")
        .select("key", (F.col("inner") | (F.col("low") != F.col("high"))).alias("mixed"))
    )
    alive = settle(runs.select("row", "key", "content", "start", "count").join(keys, "key"))
    plain = alive.where(~F.col("mixed")).select("row", "start", (F.col("start") + F.col("count") + length - 1).alias("stop"))
    mixed = alive.where("mixed")
    contents = settle(
        mixed.groupBy("key", "content").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start", "count")).alias("at")
        )
    )
    large = contents.groupBy("key").agg(F.count(F.lit(1)).alias("contents")).where(F.col("contents") > largest).select("key")
    wanted = (
        contents.select("key", "content", "at.*")
        .join(heads.select("row", "doc_id", "digest"), "row")
        .groupBy(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"))
        .agg(F.collect_list(F.struct("key", "content", "start", "count")).alias("runs"))
    )
    pieces = settle(_cut(docs, wanted, length))
    grouped = pieces.select(F.col("key").alias("group"), "key", "content", F.lit(0).alias("base"), "piece")
    found = _sorted_together(grouped.join(large, "key", "left_anti"), length).union(
        _divided(pieces.join(large, "key", "left_semi"), length, gram, largest)
    )
    # Contents met twice are repeated from end to end, whatever the comparison says.
    whole = contents.where("n > 1").select("key", "content", F.lit(0).alias("first"), (F.col("at.count") - 1).alias("last"))
    inside = (
        mixed.join(found.union(whole), ["key", "content"])
        .select("row", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + length).alias("stop"))
    )
    return plain.union(inside).groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, largest: int = LARGEST) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, removed`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Texts are UTF-8 bytes, a
    null one is empty.  Every byte covered by a string of ``length`` bytes that also starts
    anywhere else, in this or another row, is removed; a repeated row repeats all its strings.
    ``kept`` are the remaining bytes and ``removed`` the intervals; both are null where nothing is
    removed.  Texts shorter than ``length`` lose nothing.
    """
    cut = settle(_runs(docs, length, min(gram, length)))
    heads = cut.where("key is null").select("row", "doc_id", "digest", "n_bytes", "whole_sha256")
    runs = cut.where("key is not null").select("row", "key", "content", "start", "count", "inner")
    found = settle(
        heads.join(repeated_spans(runs, heads, docs, length, min(gram, length), largest), "row", "left")
    )
    clean = found.where("spans is null").select(
        "doc_id",
        "n_bytes",
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.col("whole_sha256").alias("kept_sha256"),
        F.lit(None).cast("binary").alias("kept"),
        F.lit(None).cast("array<struct<start:int,stop:int>>").alias("removed"),
    )
    # Repeated rows have the same spans.
    marked = (
        found.where("spans is not null")
        .groupBy(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"))
        .agg(F.first("spans").alias("spans"))
    )
    keyed = docs.select("doc_id", _digest().alias("digest"), F.col("text").cast("string"))
    joined = keyed.join(
        marked, (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of"))
    ).select("doc_id", "text", "spans")
    names = clean.columns

    def run(batches):
        for batch in kernels.slices(batches):
            rows = []
            for doc_id, text, spans in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                raw = text.encode("utf-8", "surrogatepass")
                change = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(change, [s["start"] for s in spans], 1)
                np.add.at(change, [s["stop"] for s in spans], -1)
                covered = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(raw, dtype=np.uint8)[~covered].tobytes()
                merged = kernels.true_runs(covered)
                rows.append(
                    (
                        doc_id,
                        len(raw),
                        int(covered.sum()),
                        len(merged),
                        hashlib.sha256(kept).hexdigest(),
                        kept,
                        [{"start": a, "stop": b + 1} for a, b in merged],
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * 7, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    form = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, removed array<struct<start:int,stop:int>>"
    return clean.unionByName(joined.mapInArrow(run, form))
