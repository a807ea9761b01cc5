"""A sink whose files have names of the caller's choice, visible all at once or not at all.

A task writes the files it is dealt into a folder of its own attempt, below ``_pending-…`` beside them. Only
when every task has succeeded does the commit step move the files of the attempts that count to
their names; a failed job, a lost executor or a second attempt of a task leaves nothing but that
hidden folder, which is removed. Rows reach a file in the order they have; nothing is held but the
current Arrow batch.

The folder has to be one that driver and executors share, under a scheme that Arrow's file systems know
(a plain path or ``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

_NAME = re.compile(r"[^/._\\][^/\\]*\Z")
_MOVES = 16  # at a time, in the commit step


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^(s3)[an]:", r"\1:", path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    names: list[str]


# what stands before the first entry, between two, after the last one
_FRAMES = {"lines": (b"", b"\n", b"\n"), "object": (b"{", b",\n", b"}"), "array": (b"[", b",\n", b"]")}


class _Files:
    """The files of one attempt, one open at a time."""

    def __init__(self, system: fs.FileSystem, folder: str, frame: tuple[bytes, bytes, bytes]):
        self.system, self.folder = system, folder
        self.head, self.between, self.tail = frame
        self.names: list[str] = []
        self.seen: set[str] = set()
        self.stream = None

    def add(self, name: str | None, entries: Sequence[str]) -> None:
        if self.stream is None or name != self.names[-1]:
            self.close()
            if name is None or not _NAME.match(name):
                raise ValueError(f"not the name of a file: {name!r}")
            if name in self.seen:
                raise ValueError(f"the rows of {name} do not stand together")
            if not self.names:
                self.system.create_dir(self.folder)
            self.stream = self.system.open_output_stream(f"{self.folder}/{name}")
            self.names.append(name)
            self.seen.add(name)
            self.stream.write(self.head)
        else:
            self.stream.write(self.between)
        self.stream.write(self.between.join(one.encode() for one in entries))

    def close(self) -> None:
        if self.stream is not None:
            self.stream.write(self.tail)
            self.stream.close()
            self.stream = None


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, frame: str):
        self.path, self.frame = path.rstrip("/"), frame
        self.pending = f"{self.path}/_pending-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        attempt = uuid.uuid4().hex
        system, folder = _resolve(f"{self.pending}/{attempt}")
        files = _Files(system, folder, _FRAMES[self.frame])
        try:
            for batch in batches:
                names, entries = batch.column(0), batch.column(1)
                if entries.null_count:
                    raise ValueError("an entry is null")
                runs = pc.run_end_encode(names)
                start = 0
                for name, stop in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    files.add(name, entries.slice(start, stop - start).to_pylist())
                    start = stop
        finally:
            files.close()
        return _Written(attempt, files.names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, base = _resolve(self.path)
        pending = _resolve(self.pending)[1]
        moves = [(f"{pending}/{one.folder}/{name}", f"{base}/{name}") for one in messages if one for name in one.names]
        targets = [to for _, to in moves]
        if len(set(targets)) < len(targets):
            self._remove()
            raise ValueError("two tasks have written files of one name")
        with ThreadPoolExecutor(_MOVES) as pool:
            list(pool.map(lambda move: system.move(*move), moves))
        self._remove()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove()

    def _remove(self) -> None:
        system, pending = _resolve(self.pending)
        if system.get_file_info(pending).type == fs.FileType.Directory:
            system.delete_dir(pending)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, entry string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("frame", "lines"))


def write_named(
    df: DataFrame, path: str, name: Column, entry: Column, order: Sequence[str | Column] = (), frame: str = "lines"
) -> None:
    """One file per value of ``name`` below ``path``, holding ``entry`` of its rows in ``order``.

    ``frame`` puts the entries on lines, or into one JSON ``object`` or ``array``. A file is written by one task, as a
    stream, so bound its rows by the name (``with_shards``). Refused: a folder with visible files in it, an entry
    or a name that is null, a name with a slash or beginning with a dot or an underscore. No rows, no files.
    """
    if frame not in _FRAMES:
        raise ValueError(f"unknown frame: {frame}")
    system, base = _resolve(path)
    if system.get_file_info(base).type != fs.FileType.NotFound:
        inside = system.get_file_info(fs.FileSelector(base))
        if any(not one.base_name.startswith(("_", ".")) for one in inside):
            raise FileExistsError(path)
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    columns = [F.col(one) if isinstance(one, str) else one for one in order]
    places = [one.alias(f"_place{n}") for n, one in enumerate(columns)]
    rows = df.select(name.alias("file"), entry.alias("entry"), *places)
    dealt = rows.repartition("file").sortWithinPartitions("file", *[f"_place{n}" for n in range(len(places))])
    dealt.select("file", "entry").write.format("named_files").mode("append").option("frame", frame).save(path)
