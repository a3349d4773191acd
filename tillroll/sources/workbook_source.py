"""Workbooks as a Spark data source: `spark.read.format("workbook").load(folder)`.

A container's directory says where each part lies, so a task opens a container and
reads the bytes of its own parts only; no container passes through Spark. The options
`kinds` and `sheets` decide which parts are read at all, `columns` and `lastRow` thin and
end the parsing. They are options because Spark 4.1 keeps what the first filter of a
scan made a Python source read: a second query over the same DataFrame with another
filter would get the first one's rows, so filters are not pushed down on their own.
The source also writes: rows of `path, content` become files, all of them or none.
"""

from __future__ import annotations

import io
import json
import posixpath
import uuid
from collections.abc import Collection, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import chain
from zipfile import ZipFile

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.schemas import WORKBOOK_RECORD
from tillroll.sources import workbooks
from tillroll.sources.staging import staged

NAME = "workbook"
#: A task reads parts of together so many bytes, unpacked, or one part. 0: a task per part.
PARTITION_BYTES = 16 << 20
_BATCH = 10_000
_LISTERS = 16  # containers whose directories are read at a time
#: Containers that are opened to plan a scan, the largest; of more, the others are read whole by the tasks.
OPENED = 1_000
_PACKED = 4  # a container's bytes count so often as what they hold
_LIST_BYTES = 64 << 10  # what a container counts for of which no sheet is read
_BUFFER = 1 << 20
_ENDLESS = 1 << 62
_KINDS = ("cell", "string", "format", "style", "sheet", "relation", "part")

SCAN = T.StructType([*WORKBOOK_RECORD.fields, T.StructField("sheet", T.StringType()), T.StructField("col", T.IntegerType())])
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())])


def register_workbooks(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(WorkbookSource)


def scan_workbooks(
    spark: SparkSession,
    path: str,
    kinds: Collection[str] | None = None,
    sheets: Collection[str] | None = None,
    columns: Collection[int] | None = None,
    last_row: int | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """`SCAN` rows of a workbook or of a folder of them: `WORKBOOK_RECORD` with `sheet` and `col`.

    Only records of `kinds`; of cells only those in `sheets`, in `columns` (from 0) and up
    to `last_row`. What is left out is not read: a part by its entry in the container, the
    rest of a sheet by ending there.
    """
    register_workbooks(spark)
    picked = {"kinds": kinds, "sheets": sheets, "columns": columns}
    options = {name: json.dumps(sorted(values)) for name, values in picked.items() if values is not None}
    if last_row is not None:
        options["lastRow"] = str(last_row)
    return spark.read.format(NAME).options(**options, partitionBytes=partition_bytes).load(path)


def scan_tables(spark: SparkSession, path: str) -> workbooks.WorkbookTables:
    """The tables of workbooks: cells by a scan of their parts, the others from one pass, which is staged."""
    others = staged(scan_workbooks(spark, path, [k for k in _KINDS if k != "cell"]), "workbook-lists", "kind")
    cells = workbooks.split_records(scan_workbooks(spark, path, ["cell"])).cells
    return workbooks.split_records(others)._replace(cells=cells)


def write_files(files: DataFrame, folder: str) -> None:
    """Each row of `path, content` as a file of that name below `folder`."""
    register_workbooks(files.sparkSession)
    files.select("path", "content").write.format(NAME).mode("append").save(folder)


def opens(path: str) -> bool:
    """Can tasks open this path by themselves? If not, only Spark's own readers reach it."""
    try:
        pyarrow.fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False
    return True


@dataclass
class Unit:
    """What is read at once: one part, the short parts of a workbook, its directory alone, or all that is wanted of it."""

    uri: str  # below the path that was asked for
    place: str  # in its file system
    what: str  # "sheet", "strings", "lists", "directory", "workbook"
    part: str | None
    sheet: str | None
    size: int


class Parts(InputPartition):
    def __init__(self, units: list[Unit]) -> None:
        self.units = units


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return SCAN

    def reader(self, schema: T.StructType) -> WorkbookReader:
        return WorkbookReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> FileWriter:
        if [f.name for f in schema.fields] != FILES.fieldNames() or overwrite:
            raise ValueError("files are added, from the columns path and content")
        return FileWriter(self.options["path"])


def _open(files: pyarrow.fs.FileSystem, place: str) -> io.BufferedReader:
    return io.BufferedReader(files.open_input_file(place), _BUFFER)


def _listed(path: str) -> tuple[pyarrow.fs.FileSystem, str, list[pyarrow.fs.FileInfo]]:
    """The workbooks at a path, and what their places lack to be URIs."""
    files, root = pyarrow.fs.FileSystem.from_uri(path)
    found = files.get_file_info(root)
    if found.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.is_file:
        listed = [found]
    else:
        listed = [f for f in files.get_file_info(pyarrow.fs.FileSelector(root)) if f.is_file and f.path.endswith(".xlsx")]
    return files, path[: path.rindex(root)] if path.endswith(root) else "", listed


def tasks_for(path: str, partition_bytes: int = PARTITION_BYTES) -> int:
    """Into how many tasks work on all of what the workbooks at a path hold should go."""
    return 1 + _PACKED * sum(f.size for f in _listed(path)[2]) // partition_bytes


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionBytes", options.get("partitionbytes", PARTITION_BYTES)))
        picked = {name: json.loads(options[name]) for name in ("kinds", "sheets", "columns") if name in options}
        self.kinds = set(picked.get("kinds", _KINDS))
        self.sheets = set(picked["sheets"]) if "sheets" in picked else None
        self.columns = set(picked["columns"]) if "columns" in picked else None
        self.last_row = int(options.get("lastrow", options.get("lastRow", _ENDLESS)))

    def partitions(self) -> list[Parts]:
        """The wanted parts of all workbooks, small ones together.

        The part of the work that the driver does is bounded: where there are more than
        `OPENED` containers, only the largest are opened here, to spread their parts; a task
        finds the parts of the others by itself. `partitionBytes` 0 asks for every part.
        """
        files, stem, listed = _listed(self.path)
        by_size = sorted(listed, key=lambda f: (-f.size, f.path))
        whole = {f.path: f.size for f in by_size[OPENED:]} if self.partition_bytes else {}
        named = sorted((stem + f.path, f.path) for f in listed)
        with ThreadPoolExecutor(_LISTERS) as pool:
            opened = pool.map(lambda f: self._units(files, *f), [f for f in named if f[1] not in whole])
            units = [u for f in named for u in ([self._whole(*f, whole[f[1]])] if f[1] in whole else next(opened))]
        packed: list[Parts] = []
        size = 0
        for unit in units:
            if not packed or size + unit.size > self.partition_bytes:
                packed.append(Parts([]))
                size = 0
            packed[-1].units.append(unit)
            size += max(unit.size, 1)
        return packed or [Parts([])]

    def _whole(self, uri: str, place: str, size: int) -> Unit:
        content = self.kinds & {"cell", "string"} and (self.sheets is None or self.sheets)
        return Unit(uri, place, "workbook", None, None, _PACKED * size if content else min(size, _LIST_BYTES))

    def _units(self, files: pyarrow.fs.FileSystem, uri: str, place: str) -> list[Unit]:
        with _open(files, place) as stream, ZipFile(stream) as container:
            return self._units_of(container, uri, place)

    def _units_of(self, container: ZipFile, uri: str, place: str) -> list[Unit]:
        sizes = {m.filename: m.file_size for m in container.infolist()}
        names = workbooks.sheet_names(container)
        units = []
        if self.kinds & {"format", "style", "sheet", "relation"}:
            units.append(Unit(uri, place, "lists", None, None, sum(sizes.get(p, 0) for p in workbooks.LISTS)))
        content = [p for p in sorted(sizes) if p.endswith(".xml") and p not in workbooks.LISTS]
        if "part" in self.kinds:
            units.append(Unit(uri, place, "directory", None, None, 64 * len(content)))
        for part in content:
            if part == workbooks.STRINGS and "string" in self.kinds:
                units.append(Unit(uri, place, "strings", part, None, sizes[part]))
            elif part != workbooks.STRINGS and "cell" in self.kinds and (self.sheets is None or names.get(part) in self.sheets):
                units.append(Unit(uri, place, "sheet", part, names.get(part), sizes[part]))
        return units

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        files, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        pending: list[dict] = []
        for unit in partition.units:
            with _open(files, unit.place) as stream, ZipFile(stream) as container:
                own = self._units_of(container, unit.uri, unit.place) if unit.what == "workbook" else [unit]
                for record in chain.from_iterable(self._records(container, u) for u in own):
                    if record["kind"] in self.kinds:
                        record["workbook"] = unit.uri
                        pending.append(record)
                    if len(pending) == _BATCH:
                        yield _batch(pending, SCAN)
                        pending = []
        if pending:
            yield _batch(pending, SCAN)

    def _records(self, container: ZipFile, unit: Unit) -> Iterator[dict]:
        if unit.what == "lists":
            yield from workbooks.list_records(container)
            return
        if unit.what == "directory":
            for part in sorted(container.namelist()):
                if part.endswith(".xml") and part not in workbooks.LISTS:
                    yield {"kind": "part", "part": part}
            return
        with container.open(unit.part) as stream:
            if unit.what == "strings":
                yield from workbooks.shared_strings(stream)
                return
            for record in workbooks.sheet_cells(stream, unit.part):
                if record["row_no"] > self.last_row:
                    return  # the rest of the part is not even unpacked
                col = workbooks.column_of(record["ref"].rstrip("0123456789")) if record.get("ref") else None
                if self.columns is None or col in self.columns:
                    record["sheet"], record["col"] = unit.sheet, col
                    yield record


def _batch(records: list[dict], schema: T.StructType) -> pa.RecordBatch:
    columns = {name: [record.get(name) for record in records] for name in schema.fieldNames()}
    return pa.RecordBatch.from_pydict(columns, to_arrow_schema(schema))


@dataclass
class Written(WriterCommitMessage):
    places: list[tuple[str, str]]  # written to, to be moved to


class FileWriter(DataSourceArrowWriter):
    """Tasks write below a hidden folder; the files get their names when all tasks are done."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.hidden = f"_files-{uuid.uuid4().hex}"

    def _places(self) -> tuple[pyarrow.fs.FileSystem, str, str]:
        files, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        return files, root, posixpath.join(root, self.hidden)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root, hidden = self._places()
        places = []
        files.create_dir(hidden, recursive=True)
        for batch in iterator:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                if not name or posixpath.isabs(name) or ".." in name.split("/"):
                    raise ValueError(f"not a file name below the folder: {name!r}")
                made = posixpath.join(hidden, uuid.uuid4().hex)
                with files.open_output_stream(made) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                places.append((made, posixpath.join(root, name)))
        return Written(places)

    def commit(self, messages: list[Written | None]) -> None:
        files, _, hidden = self._places()
        moves = [move for message in messages if message for move in message.places]
        targets = [to for _, to in moves]
        if len(set(targets)) < len(targets):
            self.abort(messages)
            raise ValueError("several rows for one file")
        for folder in {posixpath.dirname(to) for to in targets}:
            files.create_dir(folder, recursive=True)
        for made, to in moves:
            files.move(made, to)
        files.delete_dir(hidden)

    def abort(self, messages: list[Written | None]) -> None:
        files, _, hidden = self._places()
        if files.get_file_info(hidden).type == pyarrow.fs.FileType.Directory:
            files.delete_dir(hidden)
