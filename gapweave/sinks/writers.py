"""Sinks.  A table that replaces an earlier one is written beside it and takes its place only when
the job has succeeded: a failed job leaves the earlier table as it was and nothing else."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gapweave.operators.settle import setting
from gapweave.operators.splits import SPLITS


def _replace(df: DataFrame, path: str, write: Callable[[str], None]) -> None:
    """Run ``write`` on a fresh folder beside ``path``, then let it take the place of ``path``."""
    jvm = df.sparkSession.sparkContext._jvm  # the only way to the file system that Spark writes to
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex
    fresh, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{kind}-{mark}") for kind in ("new", "old"))
    try:
        write(fresh.toString())
    except BaseException:
        fs.delete(fresh, True)
        raise
    if fs.exists(target) and not fs.rename(target, old):
        fs.delete(fresh, True)
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(fresh, target):
        fs.rename(old, target)
        raise OSError(f"{path} can't be put in place")
    fs.delete(old, True)


def replace_table(df: DataFrame, path: str) -> None:
    """The rows as a Parquet table in place of an earlier one."""
    _replace(df, path, df.write.parquet)


#: As many files a task has open at once; rows with their arrays then needn't be sorted by split.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Parquet lists of two levels, where no element is null: a third one costs more than the ids in it.
TWO_LEVELS = "spark.sql.parquet.writeLegacyFormat"


def write_examples(df: DataFrame, path: str, mode: str = "append", fmt: str = "json") -> None:
    """Tokenized rows, one directory per split."""
    columns = [c for c in ("input_ids", "attention_mask", "labels") if c in df.columns]
    with setting(df.sparkSession, OPEN_FILES, str(len(SPLITS))), setting(df.sparkSession, TWO_LEVELS, "true"):
        df.select("split", *columns).write.partitionBy("split").mode(mode).format(fmt).save(path)


def replace_examples(df: DataFrame, path: str, fmt: str = "json", then: Callable[[], DataFrame] | None = None) -> None:
    """Start afresh: all earlier outputs go away, also of splits that now have no rows.

    ``then`` is called when the rows of ``df`` are written and gives further ones.
    """

    def write(fresh: str) -> None:
        write_examples(df, fresh, fmt=fmt)
        if then is not None:
            write_examples(then(), fresh, fmt=fmt)

    _replace(df, path, write)


def manifest(files: DataFrame) -> DataFrame:
    """One JSON line per file with its split; as lines it has no size limit."""
    return files.select("split", "path", F.to_json(F.struct("split", "path")).alias("line"))


def write_manifest(files: DataFrame, path: str) -> None:
    """Paths per split: directory ``split=<name>`` with one path per line."""
    _replace(files, path, lambda fresh: files.select("split", "path").write.partitionBy("split").text(fresh))


def write_benchmark(parts: DataFrame, path: str, reuse: bool = False) -> None:
    if reuse:
        parts.write.mode("ignore").json(path)
    else:
        _replace(parts, path, parts.write.json)


def write_scores(scores: DataFrame, path: str, fmt: str = "json") -> None:
    """Scores go to their own directory; the generations they were read from stay as they are."""
    _replace(scores, path, scores.write.format(fmt).save)


def write_report(report: DataFrame, path: str) -> None:
    _replace(report, path, report.select("report").coalesce(1).write.text)


def write_blocks(blocks: DataFrame, path: str, order: list[str], text: str = "block") -> None:
    """Blocks of each split as text, separated by an empty line, in the given order.

    Rows are range-partitioned by the order columns, so file names and rows inside files
    follow the order and no task holds a whole split.
    """
    ordered = (
        blocks.select("split", *order, text)
        .repartitionByRange("split", *order)
        .sortWithinPartitions("split", *order)
        .select("split", F.col(text).alias("value"))
    )
    _replace(blocks, path, ordered.write.partitionBy("split").option("lineSep", "\n\n").text)


def write_train_log(log: DataFrame, path: str) -> None:
    """Log entries as JSON Lines per run and kind, in step order inside each file."""
    ordered = log.repartitionByRange("run_id", "kind", "step").sortWithinPartitions("run_id", "kind", "step")
    _replace(log, path, ordered.write.partitionBy("run_id", "kind").json)
