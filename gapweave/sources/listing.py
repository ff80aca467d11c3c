"""Files of a tree by name, size and time, as a Python data source whose partitions are folders.

Spark's own file sources leave out files of zero length, and read a listing on the driver.  Here
the driver opens only the upper folders, until there are enough for the tasks; each task lists what
is below its folders.  Any store that Arrow's file systems reach can be listed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "path string, n_bytes bigint, modified timestamp"
#: The driver opens folders level by level until it has so many, or there are no deeper ones.
FOLDERS, LEVELS = 256, 6
_ROWS = 10_000


class FolderPartition(InputPartition):
    def __init__(self, folders: list[str], whole: bool):
        self.folders, self.whole = folders, whole


class ListingReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def _opened(self):
        from urllib.parse import urlparse

        from pyarrow import fs

        where = urlparse(self.root)
        if where.scheme in ("", "file"):
            return fs.LocalFileSystem(), where.path if where.scheme else self.root, "file:"
        system, path = fs.FileSystem.from_uri(self.root)
        return system, path, self.root[: len(self.root) - len(where.path)]

    def partitions(self):
        from pyarrow import fs

        system, root, _ = self._opened()
        if system.get_file_info(root).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no folder {self.root}")
        opened, level = [], [root]
        for _ in range(LEVELS):
            if not level or len(level) >= FOLDERS:
                break
            below = []
            for folder in level:
                found = system.get_file_info(fs.FileSelector(folder))
                below += [x.path for x in found if x.type == fs.FileType.Directory]
            opened += level
            level = below
        # Opened folders have their own files only; what is below the others belongs to one task each.
        own = [FolderPartition(opened[k : k + 64], False) for k in range(0, len(opened), 64)]
        return own + [FolderPartition([folder], True) for folder in level]

    def read(self, partition: FolderPartition):
        import pyarrow as pa
        from pyarrow import fs

        system, _, prefix = self._opened()
        names = ["path", "n_bytes", "modified"]
        kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC")]
        for folder in partition.folders:
            found = system.get_file_info(fs.FileSelector(folder, recursive=partition.whole))
            rows = [(prefix + x.path, x.size, x.mtime) for x in found if x.type == fs.FileType.File]
            for at in range(0, len(rows), _ROWS):
                columns = zip(*rows[at : at + _ROWS])
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gapweave_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["path"])


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``path, n_bytes, modified`` of every file below ``root``, empty ones too; no file is opened."""
    spark.dataSource.register(ListingSource)
    return spark.read.format("gapweave_listing").load(root.rstrip("/") or "/")


def empty_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of zero length below ``root``, as rows of a scan.

    Names that begin with a dot or an underscore are left out, as Spark's file sources do with folders
    and files of such names.
    """
    hidden = F.col("path").rlike(r"/[._][^/]*$|/_[^/]*/")
    nothing = F.lit(b"")
    return listing(spark, root).where((F.col("n_bytes") == 0) & ~hidden).select("path", "n_bytes", nothing.alias("content"))
