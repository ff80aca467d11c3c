"""Exact duplicates by Grace hashing: spill files by hash, divided until a table of whole contents fits.

Texts are equal when they are identical after every run of white space has become one blank.  The
tasks of the scan merge the copies they meet in an open-addressing table of bounded size and write
what is left, one record for each different text of a filling, to the first spill files.  The hash
of a record names its bucket.  A bucket up to ``FIT`` bytes is read by one task into a table that
compares complete contents.  The records of larger buckets go to new spill files under another hash,
and the copies of one text, which no hash can divide, are dealt by a salt and merged on the way, so
that few of them are left.  This repeats until every bucket fits.

Records carry ids, not lists of documents: a group of any size is one counter and one least id.
Every level keeps which record became part of which; the answers go back the same way.

Null texts count as empty, which is a text like any other.  A null id comes after all others; where
all ids of a group are null so is its ``keep_id``.  Of rows that repeat text and id one stays.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.llm import kernels
from gapweave.llm.common import as_row, row_columns
from gapweave.operators.settle import settle

#: Bytes of different contents that a task holds in its table.
FIT = 32 << 20
#: Into how many parts the records of one text in a large bucket are dealt before they are merged.
SALTS = 16
_ROWS = 1 << 18

_RECORD = "part bigint, fingerprint bigint, low_id bigint, low_part bigint, n bigint, sha binary, size bigint, content binary"
_RECORD_KINDS = [pa.int64()] * 5 + [pa.binary(), pa.int64(), pa.binary()]


def one_blank(text: Column) -> Column:
    """The text with every run of white space replaced by one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _scanned(docs: DataFrame, fit: int) -> DataFrame:
    """Rows of documents (``doc_id, part, lead``) and the records of the first level, in one table.

    ``lead`` marks the first row with the least id of its record.
    """
    kinds = [pa.int64(), pa.bool_(), *_RECORD_KINDS]

    def run(batches):
        table, task, serial = kernels.ContentTable(), TaskContext.get().partitionId() << 33, 0
        ids, places, sums = [], [], []

        def flush():
            merged = kernels.merged_records(places, [(i is None, i, 0) for i in ids], [1] * len(ids), len(table.contents))
            rows, led = [], set()
            for doc_id, k in zip(ids, places):
                lead = k not in led and doc_id == merged[k][0][1]
                if lead:
                    led.add(k)
                rows.append((doc_id, lead, serial + task + k, None, None, None, None, None, None, None))
            yield from kernels.record_batches(rows, kinds)
            rows = [
                (None, None, serial + task + k, table.prints[k], low[1], serial + task + k, n, sums[k], len(table.contents[k]), table.contents[k])
                for k, (low, n) in enumerate(merged)
            ]
            yield from kernels.record_batches(rows, kinds, 8)

        for batch in kernels.slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = kernels.one_blank(text or "").encode("utf-8", "surrogatepass")
                k = table.place(kernels.fingerprint(content), content)
                if k == len(sums):
                    sums.append(kernels.sha256(content))
                ids.append(doc_id)
                places.append(k)
                if table.full(fit) or len(ids) >= _ROWS:
                    yield from flush()
                    serial += len(table.contents)
                    table, ids, places, sums = kernels.ContentTable(), [], [], []
        if ids:
            yield from flush()

    picked = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return picked.mapInArrow(run, f"doc_id bigint, lead boolean, {_RECORD}")


def _respilled(records: DataFrame, fit: int) -> DataFrame:
    """The records of large buckets, dealt by bucket and salt, copies merged: new records, and for
    every record that went in the one it became part of (``old``, ``part``), in one table."""
    kinds = [pa.int64(), *_RECORD_KINDS]

    def run(batches):
        table, rows, places = kernels.ContentTable(), [], []

        def flush():
            lows = [(r[2] is None, r[2], r[3]) for r in rows]
            merged = kernels.merged_records(places, lows, [r[4] for r in rows], len(table.contents))
            first = {}
            for r, k in zip(rows, places):
                first.setdefault(k, r)
            yield from kernels.record_batches([(r[0], first[k][0], *[None] * 7) for r, k in zip(rows, places)], kinds)
            out = [
                (None, first[k][0], first[k][1], low[1], low[2], n, first[k][5], first[k][6], table.contents[k])
                for k, (low, n) in enumerate(merged)
            ]
            yield from kernels.record_batches(out, kinds, 7)

        for batch in kernels.slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                places.append(table.place(row[1], row[7]))
                rows.append(row[:7])
                if table.full(fit) or len(rows) >= _ROWS:
                    yield from flush()
                    table, rows, places = kernels.ContentTable(), [], []
        if rows:
            yield from flush()

    dealt = records.repartition("path", F.pmod(F.xxhash64("part"), F.lit(SALTS)))
    names = [c.split()[0] for c in _RECORD.split(", ")]
    return dealt.select(*names).mapInArrow(run, f"old bigint, {_RECORD}")


def _answers(records: DataFrame) -> DataFrame:
    """``part, keep_id, keep_part, group_size, sha`` for the records of buckets that fit: a table for each bucket."""
    kinds = [pa.int64()] * 4 + [pa.binary()]

    def run(batches):
        path, table, rows, places = None, kernels.ContentTable(), [], []

        def flush():
            lows = [(r[2] is None, r[2], r[3]) for r in rows]
            merged = kernels.merged_records(places, lows, [r[4] for r in rows], len(table.contents))
            out = [(r[0], merged[k][0][1], merged[k][0][2], merged[k][1], r[5]) for r, k in zip(rows, places)]
            yield from kernels.record_batches(out, kinds)

        for batch in kernels.slices(batches):
            for at, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if at != path:
                    if rows:
                        yield from flush()
                    path, table, rows, places = at, kernels.ContentTable(), [], []
                places.append(table.place(row[1], row[7]))
                rows.append(row[:7])
        if rows:
            yield from flush()

    names = [c.split()[0] for c in _RECORD.split(", ")]
    by_bucket = records.repartition("path").sortWithinPartitions("path").select("path", *names)
    return by_bucket.mapInArrow(run, "part bigint, keep_id bigint, keep_part bigint, group_size bigint, sha binary")


def _groups_of_records(records: DataFrame, fit: int, level: int = 0) -> DataFrame:
    """``_answers`` for all records, level by level."""
    total = records.agg(F.sum("size")).first()[0] or 0
    buckets = 1 + 4 * total // fit
    # Another hash at every level: the level is hashed with the fingerprint.
    records = records.withColumn("path", F.pmod(F.xxhash64("fingerprint", F.lit(level)), F.lit(buckets)))
    sizes = records.groupBy("path").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"), F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")
    )
    # What is one text, in as few records as there are salts, can't be divided any more.
    divisible = (F.col("low") != F.col("high")) | (F.col("records") > SALTS)
    large = sizes.where((F.col("bytes") > fit) & divisible).select("path")
    if large.isEmpty():
        return _answers(records)
    # A large bucket has more than `fit` bytes, so there are total / fit of them at most: 8 bytes for every 32 MB.
    large = F.broadcast(large)
    fitting = _answers(records.join(large, "path", "left_anti"))
    spilled = settle(_respilled(records.join(large, "path"), fit))
    deeper = _groups_of_records(spilled.where("old is null").drop("old"), fit, level + 1)
    became = spilled.where("old is not null").select(F.col("old"), F.col("part").alias("_part"))
    passed_on = became.join(deeper, F.col("_part") == F.col("part")).select(
        F.col("old").alias("part"), "keep_id", "keep_part", "group_size", "sha"
    )
    return fitting.union(passed_on)


def duplicates(docs: DataFrame, fit: int = FIT) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.
    """
    scanned = settle(_scanned(docs, fit))
    records = scanned.where("fingerprint is not null").drop("doc_id", "lead")
    answers = _groups_of_records(records, fit)
    rows = scanned.where("fingerprint is null").select("doc_id", "lead", F.col("part").alias("_part"))
    return rows.join(answers, F.col("_part") == F.col("part")).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("lead") & (F.col("_part") == F.col("keep_part"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, fit: int = FIT) -> DataFrame:
    """``docs`` with one row of each text; columns unchanged."""
    kept = duplicates(docs, fit).where("kept").select(F.col("doc_id").alias("of"), F.col("text_sha256").alias("of_digest"))
    keyed = as_row(docs, F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(one_blank(F.col("text")), 256).alias("digest"))
    joined = keyed.join(kept, (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of")))
    return joined.dropDuplicates(["digest", "doc_id"]).select(*row_columns(docs.columns))


EXACT_SQL = """
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
g AS (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS place
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""
