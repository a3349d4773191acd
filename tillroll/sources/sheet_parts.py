"""Worksheets as plain XML files, which Spark splits wherever rows end.

A worksheet inside a container is one compressed stream for one task. Unpacked once, it
is text: the scan cuts it at `</row>`, so a sheet of any size spreads over as many tasks
as it has blocks, and the XML of a row is parsed on the JVM. Small sheets, which need no
cutting by blocks, stand together in a table, a row each.
"""

from __future__ import annotations

import io
import posixpath
import shutil
import uuid
from collections.abc import Iterator
from urllib.parse import quote
from xml.etree import ElementTree
from zipfile import ZipFile

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.sources.staging import staged
from tillroll.sources.workbook_source import scan_workbooks, tasks_for

#: Sheets of up to so many bytes share the files of a table; a larger one gets a file.
SMALL = 256 << 10
_TABLE = "sheets"
_SHEETS = "workbook string, part string, file string, size long, xml binary"
_CHUNK = 1 << 20
_PENDING = 8 << 20  # bytes of small sheets that a task holds
_ROW = "</row>"
#: A row element; text is what is parsed, and meaning is left to `operators.sheets`.
_TEXTS = "array<struct<t: array<string>>>"
_ROW_SCHEMA = (
    "c array<struct<_r: string, _t: string, _s: int, v: string, "
    f"is: struct<t: array<string>, r: {_TEXTS}, rPh: {_TEXTS}>>>"
)


def unpack_sheets(spark: SparkSession, path: str, folder: str, small: int = SMALL) -> DataFrame:
    """Write each worksheet of the workbooks at `path` below `folder`; `workbook, part, file, size`.

    A task streams a part of more than `small` bytes from the container to its file, which
    gets its name when it is whole, so a task that runs again replaces it by the same.
    Smaller ones are rows of a table, and `file` names the table and, behind `#`, the sheet.
    Each call adds the table of its sheets; of a sheet in several, the last is read.
    """
    number = 1 + max(_calls(folder), default=0)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = pyarrow.fs.FileSystem.from_uri(path)
        target, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            done, pending = [], 0
            for workbook, part in zip(batch.column("workbook").to_pylist(), batch.column("part").to_pylist()):
                _, place = pyarrow.fs.FileSystem.from_uri(workbook)
                name = posixpath.join(quote(workbook, safe=""), part)
                sheet = {"workbook": workbook, "part": part, "file": posixpath.join(root, name)}
                with source.open_input_file(place) as stream, ZipFile(stream) as container:
                    size = container.getinfo(part).file_size
                    text = container.read(part) if size <= small else None
                    with container.open(part) if text is None else io.BytesIO(text) as xml:
                        _, top = next(ElementTree.iterparse(xml, events=("start",)))
                    if not top.tag.endswith("}worksheet"):
                        continue
                    if text is None:
                        file = sheet["file"]
                        hidden = posixpath.join(posixpath.dirname(file), f"_{uuid.uuid4().hex}")
                        target.create_dir(posixpath.dirname(file), recursive=True)
                        with container.open(part) as xml, target.open_output_stream(hidden) as out:
                            shutil.copyfileobj(xml, out, _CHUNK)
                        target.move(hidden, file)
                    else:
                        if number > 1 and target.get_file_info(sheet["file"]).is_file:
                            target.delete_file(sheet["file"])  # it was larger at an earlier call
                        sheet["file"] = f"{posixpath.join(root, _TABLE)}#{name}"
                        pending += size
                done.append(sheet | {"size": size, "xml": text})
                if pending >= _PENDING:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, pending = [], 0
            yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema(
        [("workbook", pa.string()), ("part", pa.string()), ("file", pa.string()), ("size", pa.int64()), ("xml", pa.binary())]
    )
    parts = scan_workbooks(spark, path, ["part"]).select("workbook", "part")
    # a given number, since adaptive execution would put all names, which are short, into one task
    tasks = max(tasks_for(path), spark.sparkContext.defaultParallelism)
    table = f"{folder}/{_TABLE}/call={number}"
    parts.repartition(tasks, "workbook", "part").mapInArrow(unpack, _SHEETS).write.parquet(table)
    return spark.read.schema(_SHEETS).parquet(table).drop("xml")


def _calls(folder: str) -> list[int]:
    """The numbers of the tables below `folder`."""
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    tables = files.get_file_info(pyarrow.fs.FileSelector(posixpath.join(root, _TABLE), allow_not_found=True))
    return [int(t.base_name.removeprefix("call=")) for t in tables if t.base_name.startswith("call=")]


def _row_elements(text: Column) -> Column:
    """The row elements in the text behind one row's end: rows without content, then the next row up to its end."""
    blank = F.regexp_extract_all(text, F.lit(r"<row(?:\s[^>]*)?/>"), F.lit(0))
    begun = F.regexp_extract(text, r"(?s)<row(?:\s(?:[^>]*[^>/])?)?>.*", 0)
    return F.concat(blank, F.when(begun != "", F.array(F.concat(begun, F.lit(_ROW)))).otherwise(F.array()))


def _cells() -> Column:
    """The cells of a row element in the column `xml`."""
    options = {"attributePrefix": "_", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}
    return F.from_xml("xml", _ROW_SCHEMA, options)["c"]


def _small_rows(spark: SparkSession, folder: str) -> DataFrame:
    """`workbook, part, row_no, cells` of the sheets in the tables; a sheet's rows are numbered where they are cut."""
    tables = spark.read.schema(f"{_SHEETS}, call int").parquet(f"{folder}/{_TABLE}")
    if len(_calls(folder)) > 1:
        last = tables.groupBy("workbook", "part").agg(F.max("call").alias("call"))
        tables = tables.join(last, ["workbook", "part", "call"], "left_semi")
    pieces = F.split(F.col("xml").cast("string"), _ROW)
    elements = F.flatten(F.transform(pieces, _row_elements))
    rows = tables.filter("xml is not null").select("workbook", "part", F.posexplode(elements).alias("at", "xml"))
    return rows.select("workbook", "part", (F.col("at") + 1).cast("long").alias("row_no"), _cells().alias("cells"))


def read_sheet_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The cells of unpacked sheets, as `split_records(...).cells`: the same rows as the decoder's.

    Row elements without namespace prefix are found, as office programs write them;
    attributes hold no `>`. Rows are numbered over a file by the rows of the blocks
    before, one count per block.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.xml")
        .text(folder, lineSep=_ROW)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    )
    rows = lines.select("file", "block", F.explode(_row_elements(F.col("value"))).alias("xml"))
    rows = staged(
        rows.select("file", "block", F.monotonically_increasing_id().alias("at"), _cells().alias("cells")), "sheet-rows"
    )
    blocks = rows.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("start"))

    # the folder that holds a workbook's parts is its quoted path
    where = F.split(F.url_decode("file"), "/")
    book_at = F.array_position(F.transform(where, lambda x: x.contains("%2F")), True)
    numbered = rows.join(starts, ["file", "block"]).select(
        F.url_decode(F.element_at(where, book_at.cast("int"))).alias("workbook"),
        F.array_join(F.slice(where, book_at.cast("int") + 1, F.size(where)), "/").alias("part"),
        (F.col("at") + F.col("start")).alias("row_no"),
        "cells",
    )
    if _calls(folder):
        numbered = numbered.unionByName(_small_rows(spark, folder))
    # a row without cells is one record without reference
    numbered = numbered.select("workbook", "part", "row_no", F.posexplode_outer("cells").alias("cell_no", "c"))
    texts = F.concat(
        F.coalesce("c.is.t", F.array()),
        *(F.flatten(F.coalesce(F.transform(f"c.is.{runs}", lambda r: F.coalesce(r["t"], F.array())), F.array())) for runs in ("r", "rPh")),
    )
    has_cell = F.col("c").isNotNull()
    return numbered.select(
        "workbook",
        "part",
        "row_no",
        F.coalesce("cell_no", F.lit(0)).alias("cell_no"),
        F.when(has_cell, F.coalesce("c._r", F.lit("A1"))).alias("ref"),
        F.col("c._t").alias("t"),
        F.when(has_cell, F.coalesce("c._s", F.lit(0))).alias("s"),
        F.nullif("c.v", F.lit("")).alias("raw"),
        F.when(F.col("c.is").isNotNull(), F.array_join(texts, "")).alias("inline"),
    )
