"""A data source that lists every file below a folder, hidden and empty ones too, and first bytes.

Spark's own listing leaves out files whose name begins with a dot or an underscore, and its binary
reader loads whole files. ``spark.read.format("file_listing")`` has one partition per folder in the
root and yields files as it meets them, so no list of files is held anywhere. The folders are those
of any file system that Arrow opens by its address; a plain path is a local one, which every executor
must reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_FILES = "path string, length bigint, modificationTime timestamp"
_BATCH = 1000


def opened(address: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of an address, the path in it, and what to put before such paths."""
    parts = urlsplit(address)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path or address, "file:"
    system, path = pafs.FileSystem.from_uri(address)
    return system, path, address[: len(address) - len(path)] if address.endswith(path) else f"{parts.scheme}://"


class Folder(InputPartition):
    """A folder to list, with or without the folders in it."""

    def __init__(self, path: str, deep: bool) -> None:
        super().__init__(None)
        self.path, self.deep = path, deep


class FileReader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    def partitions(self) -> list[Folder]:
        system, path, _ = opened(self.root)
        kind = system.get_file_info(path).type
        if kind == pafs.FileType.File:
            return [Folder(path, False)]
        if kind != pafs.FileType.Directory:
            raise AnalysisException(
                errorClass="PATH_NOT_FOUND", messageParameters={"path": self.root}
            )
        inner = system.get_file_info(pafs.FileSelector(path))
        folders = sorted(i.path for i in inner if i.type == pafs.FileType.Directory)
        return [Folder(path, False), *(Folder(folder, True) for folder in folders)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, _, before = opened(self.root)
        waiting, rows = [partition.path], []
        while waiting:
            here = system.get_file_info(waiting.pop())
            alone = here.type == pafs.FileType.File
            for info in [here] if alone else system.get_file_info(pafs.FileSelector(here.path)):
                if info.type == pafs.FileType.Directory:
                    if partition.deep:
                        waiting.append(info.path)
                    continue
                rows.append((before + info.path, info.size, info.mtime))
                if len(rows) >= _BATCH:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.timestamp("us", "UTC"))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["path", "length", "modificationTime"])


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return _FILES

    def reader(self, schema) -> FileReader:
        return FileReader(self.options["path"])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: ``(path, length, modificationTime)``."""
    spark.dataSource.register(FileListing)
    return spark.read.format("file_listing").load(root)


def with_first_bytes(files: DataFrame, size: int | None, name: str = "head") -> DataFrame:
    """Add the first ``size`` bytes of each file of a listing, or all of them; no more is read."""

    def head(system: pafs.FileSystem, path: str) -> bytes:
        with system.open_input_file(path) as file:
            return file.read(size)

    return _looked_at(files, head, name, "binary")


def with_footers(files: DataFrame, name: str = "columns") -> DataFrame:
    """Add the names of the columns of each Parquet file, in its order; null if it has no footer.

    A file that cannot be opened at all is an error.
    """

    def columns(system: pafs.FileSystem, path: str) -> list[str] | None:
        with system.open_input_file(path) as file:
            if file.size() < 12 or file.read(4) != b"PAR1":
                return None
            file.seek(file.size() - 4)
            if file.read(4) != b"PAR1":
                return None
            try:
                return pq.ParquetFile(file).schema_arrow.names
            except (pa.ArrowException, OSError):
                return None

    return _looked_at(files, columns, name, "array<string>")


def _looked_at(files: DataFrame, look: Callable, name: str, kind: str) -> DataFrame:
    """Add what ``look`` finds in each file. Files are dealt out by their path, so that a folder with
    many files is opened by many tasks."""
    columns = files.columns
    at = columns.index("path")
    arrow = {"binary": pa.binary(), "array<string>": pa.list_(pa.string())}

    def run(batches) -> Iterator[pa.RecordBatch]:
        systems: dict[str, pafs.FileSystem] = {}
        for batch in batches:
            for start in range(0, len(batch), _BATCH):
                part = batch.slice(start, _BATCH)
                found = []
                for address in part.column(at).to_pylist():
                    parts = urlsplit(address)
                    place = f"{parts.scheme}://{parts.netloc}"
                    if parts.scheme in ("", "file"):
                        system = systems.setdefault(place, pafs.LocalFileSystem())
                        path = address.removeprefix("file:")
                    else:
                        if place not in systems:
                            systems[place] = pafs.FileSystem.from_uri(place)[0]
                        system, path = systems[place], address.removeprefix(f"{parts.scheme}://")
                    found.append(look(system, path))
                arrays = [*part.columns, pa.array(found, arrow[kind])]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition("path").mapInArrow(run, f"{kinds}, `{name}` {kind}")


def is_hidden(name: str = "name") -> Column:
    """A name that Spark's readers pass over."""
    return F.col(name).startswith(".") | (F.col(name).startswith("_") & ~F.col(name).contains("="))


def plain_path(path: Column) -> Column:
    """One form of the addresses of listings and of scans, which escape characters."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^([a-zA-Z0-9+.-]+):/+", "$1:/")


def scanned_forms(path: str) -> list[str]:
    """The addresses of a listed file as scans write it; listings by Spark have one slash."""
    scheme, _, rest = path.partition(":")
    legal = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-!.~'()*,;:$&+=/@")
    escaped = "".join(c if c in legal or ord(c) > 127 else f"%{ord(c):02X}" for c in rest)
    forms = [f"{scheme}:{escaped}"]
    return [*forms, f"file://{escaped}"] if scheme == "file" else forms
