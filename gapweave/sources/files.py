"""File sources: recursive scans, pre-split trees, UTF-8 quarantine, archives."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gapweave.functions.text import path_suffix, unix_newlines, utf8_text
from gapweave.operators.splits import SPLITS
from gapweave.sources.listing import empty_files

FILE_SCHEMA = "path string, ext string, n_bytes bigint, content binary"


def scan(spark: SparkSession, root: str, extensions: list[str], empty: bool = True) -> DataFrame:
    """All files below ``root`` whose lower-cased suffix is in the list.

    A plan that does not use ``content`` reads no file bytes.  Spark's file source skips files of
    zero length; they come from a listing of the tree (``empty=False`` leaves them out, for stores
    that only Spark reads).
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = raw.select("path", F.col("length").alias("n_bytes"), "content")
    if empty:
        files = files.unionByName(empty_files(spark, root))
    return with_extension(files, extensions)


def with_extension(files: DataFrame, extensions: list[str], path: str = "path") -> DataFrame:
    return files.withColumn("ext", path_suffix(F.col(path))).where(F.col("ext").isin(extensions))


def scan_splits(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """A tree already divided into train, eval and test directories, as one table with ``split``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    missing = [
        f"{root}/{s}" for s in SPLITS if not fs.isDirectory(spark._jvm.org.apache.hadoop.fs.Path(hadoop_path, s))
    ]
    if missing:
        raise FileNotFoundError(f"required directories are missing: {', '.join(missing)}")
    absolute = fs.makeQualified(hadoop_path).toUri().getPath().rstrip("/") + "/"
    relative = F.substring(F.col("path"), F.instr("path", F.lit(absolute)) + F.lit(len(absolute)), F.length("path"))
    files = scan(spark, root, extensions).withColumn("split", F.split_part(relative, F.lit("/"), F.lit(1)))
    return files.where(F.col("split").isin(SPLITS))


def decode_files(files: DataFrame) -> DataFrame:
    """Add ``text`` with unix line ends (null where not UTF-8) and its bytes as ``content``."""
    text = unix_newlines(utf8_text(F.col("content")))
    decoded = files.withColumn("text", text)
    return decoded.withColumn("content", F.coalesce(F.encode("text", "UTF-8"), F.col("content")))


def valid_files(files: DataFrame) -> DataFrame:
    return decode_files(files).where(F.col("text").isNotNull())


def quarantined(files: DataFrame) -> DataFrame:
    """Files left out because they are not valid UTF-8."""
    return files.where(utf8_text(F.col("content")).isNull())


def archive_entries(spark: SparkSession, root: str) -> DataFrame:
    """Entries of every ``*.zip`` below ``root`` as ``(archive, path, n_bytes, content)`` rows."""
    zips = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.zip")
        .load(root)
        .select(F.col("path").alias("archive"), "content")
    )

    def unpack(batches):
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as opened:
                    for info in opened.infolist():
                        if not info.is_dir():
                            yield pd.DataFrame(
                                {
                                    "archive": [archive],
                                    "path": [f"{archive.removesuffix('.zip')}/{info.filename}"],
                                    "n_bytes": [info.file_size],
                                    "content": [opened.read(info)],
                                }
                            )

    return zips.mapInPandas(unpack, "archive string, path string, n_bytes bigint, content binary")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)
