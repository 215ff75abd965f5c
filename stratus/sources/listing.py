"""A full listing of a folder as a Spark data source: directories, hidden files and files of zero bytes included.

The driver lists the upper levels until there are enough directories to
deal out; each of them is one partition, listed by a task down to its
last file.  Any file system that pyarrow opens by URI can be listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

COLUMNS = "path string, kind string, bytes long, modified timestamp, hidden boolean"


@dataclass
class _Folder(InputPartition):
    path: str
    deep: bool  # everything below it, or only what stands in it


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("give the folder as path")
        self.root, self.least = options["path"].rstrip("/"), int(options.get("partitions", "32"))

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root)

    def partitions(self) -> list[_Folder]:
        from pyarrow import fs

        system, root = self._open()
        shallow, deep = [], [root]
        # go down a level at a time until there are enough directories
        while deep and len(deep) < self.least:
            below = [[x.path for x in system.get_file_info(fs.FileSelector(d)) if x.type == fs.FileType.Directory] for d in deep]
            if not any(below):
                break
            shallow += deep
            deep = [p for ps in below for p in ps]
        return [_Folder(p, False) for p in shallow] + [_Folder(p, True) for p in deep]

    def read(self, partition: _Folder) -> Iterator[tuple]:
        from pyarrow import fs

        system, root = self._open()
        for x in system.get_file_info(fs.FileSelector(partition.path, recursive=partition.deep)):
            parts = x.path[len(root.rstrip("/")) + 1 :].split("/")
            folder = x.type == fs.FileType.Directory
            hidden = any(p.startswith((".", "_")) for p in parts)
            yield "/".join(parts), "directory" if folder else "file", 0 if folder else x.size, x.mtime, hidden


class FolderListing(DataSource):
    """``spark.read.format("folder_listing").load(path)``: one row per entry, with its path below the folder."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def list_folder(spark: SparkSession, path: str, partitions: int = 32) -> DataFrame:
    """path (below the folder), kind, bytes, modified and hidden (a name on the way begins with . or _) of every entry."""
    spark.dataSource.register(FolderListing)
    return spark.read.format("folder_listing").option("partitions", partitions).load(path)


def folder_totals(listing: DataFrame) -> DataFrame:
    """folder, files, empty_files, bytes of every directory with all that lies below it ('' is the listed folder itself).

    Every file counts for each directory on its way; partial sums are made
    before the shuffle, so a folder that holds most files is no hot group.
    """
    parts = F.split("path", "/")
    own = F.when(F.col("kind") == "directory", F.size(parts)).otherwise(F.size(parts) - 1)
    ways = F.transform(F.sequence(F.lit(0), own), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    file = F.col("kind") == "file"
    rows = listing.select(F.explode(ways).alias("folder"), "kind", "bytes")
    return rows.groupBy("folder").agg(
        F.count_if(file).alias("files"), F.count_if(file & (F.col("bytes") == 0)).alias("empty_files"), F.sum("bytes").alias("bytes")
    )
