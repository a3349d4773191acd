"""Spreadsheet workbooks (.xlsx) as long tables, a record of parts at a time.

Only the container is opened in Python. The records it yields are XML facts;
what they mean (strings, dates, rows, headers) is decided by `operators.sheets`.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple
from xml.etree import ElementTree
from zipfile import ZipFile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.schemas import WORKBOOK_RECORD

_BATCH = 10_000
FAN_OUT = 4  # tasks that share a workbook's parts
_FIELDS = WORKBOOK_RECORD.fieldNames()

# --- fixed values: part names of the file format ------------------------------
STRINGS = "xl/sharedStrings.xml"
_STYLES = "xl/styles.xml"
_SHEETS = "xl/workbook.xml"
_RELATIONS = "xl/_rels/workbook.xml.rels"
# -----------------------------------------------------------------------------


LISTS = (_SHEETS, _RELATIONS, _STYLES)  # short parts that say what the others are


class WorkbookTables(NamedTuple):
    cells: DataFrame  # workbook, part, row_no, cell_no, ref, t, s, raw, inline
    string_runs: DataFrame  # workbook, idx, run_no, text
    formats: DataFrame  # workbook, fmt_id, code
    styles: DataFrame  # workbook, s, fmt_id
    sheets: DataFrame  # workbook, sheet_no, name, rel_id
    relations: DataFrame  # workbook, rel_id, target
    parts: DataFrame  # workbook, part


def read_workbook_records(spark: SparkSession, path: str) -> DataFrame:
    """Decode a workbook or a folder of them into `WORKBOOK_RECORD` rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return decode_workbooks(files.select("path", "content"))


def decode_workbooks(files: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """`WORKBOOK_RECORD` rows of workbooks given as `(path, content)`.

    A workbook's parts are dealt over `fan_out` tasks by name, each of which opens
    its own parts only and parses them as a stream; the container is held in memory
    compressed. A container cannot be read in pieces, so each of its tasks gets all
    of it.
    """
    shares = files.select("path", "content", F.explode(F.sequence(F.lit(0), F.lit(fan_out - 1))).alias("share"))
    spread = shares.repartition("path", "share") if fan_out > 1 else shares
    return spread.mapInArrow(partial(_decode, fan_out), WORKBOOK_RECORD)


def split_records(records: DataFrame) -> WorkbookTables:
    """The six tables of the records. Stage the records first to decode only once."""

    def of(kind: str, **columns: str) -> DataFrame:
        picked = [F.col(source).alias(name) for name, source in columns.items()]
        return records.filter(F.col("kind") == kind).select("workbook", *picked)

    cell_fields = [name for name in _FIELDS if name not in ("workbook", "kind")]
    return WorkbookTables(
        cells=of("cell", **{name: name for name in cell_fields}),
        string_runs=of("string", idx="row_no", run_no="cell_no", text="raw"),
        formats=of("format", fmt_id="s", code="raw"),
        styles=of("style", s="cell_no", fmt_id="s"),
        sheets=of("sheet", sheet_no="cell_no", name="raw", rel_id="ref"),
        relations=of("relation", rel_id="ref", target="raw"),
        parts=of("part", part="part"),
    )


def _batch(records: list[dict]) -> pa.RecordBatch:
    columns = {name: [record.get(name) for record in records] for name in _FIELDS}
    return pa.RecordBatch.from_pydict(columns, to_arrow_schema(WORKBOOK_RECORD))


def _decode(fan_out: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pending: list[dict] = []
    for batch in batches:
        for path, content, share in zip(batch["path"], batch["content"], batch["share"]):
            workbook = path.as_py()
            for record in _workbook_records(content.as_py(), share.as_py(), fan_out):
                record["workbook"] = workbook
                pending.append(record)
                if len(pending) == _BATCH:
                    yield _batch(pending)
                    pending = []
    if pending:
        yield _batch(pending)


def _workbook_records(content: bytes, share: int, fan_out: int) -> Iterator[dict]:
    """The records of the parts that fall to this share; the first share has the short parts too."""
    with ZipFile(io.BytesIO(content)) as container:
        parts = sorted(container.namelist())
        if share == 0:
            yield from list_records(container)
        for position, part in enumerate(parts):
            if position % fan_out != share or not part.endswith(".xml") or part in (_STYLES, _SHEETS):
                continue
            yield {"kind": "part", "part": part}
            with container.open(part) as stream:
                if part == STRINGS:
                    yield from shared_strings(stream)
                else:
                    yield from sheet_cells(stream, part)


def list_records(container: ZipFile) -> Iterator[dict]:
    """Sheets, relations, formats and styles of a workbook."""
    yield from _sheet_list(container.read(_SHEETS), container.read(_RELATIONS))
    if _STYLES in container.namelist():
        yield from _style_list(container.read(_STYLES))


def sheet_names(container: ZipFile) -> dict[str, str]:
    """The sheet that each part holds, by the same rule as `operators.sheets.sheet_catalog`."""
    records = list(_sheet_list(container.read(_SHEETS), container.read(_RELATIONS)))
    targets = {r["ref"]: r["raw"].lstrip("/") for r in records if r["kind"] == "relation"}
    named = [(targets.get(r["ref"]), r["raw"]) for r in records if r["kind"] == "sheet"]
    return {t if t.startswith("xl/") else f"xl/{t}": name for t, name in named if t}


@lru_cache(1 << 15)
def column_of(ref: str) -> int | None:
    """Zero-based column of a cell reference as `functions.sheet.column_index`, none without capitals."""
    index = 0
    for letter in ref:
        if not "A" <= letter <= "Z":
            break
        index = index * 26 + ord(letter) - 64
    return index - 1 if index else None


def _is(element: ElementTree.Element, name: str) -> bool:
    """Does the element have this name, in whichever edition of the format's namespace?"""
    return element.tag.endswith("}" + name)


def _texts(element: ElementTree.Element) -> list[str]:
    return [node.text for node in element.iter() if _is(node, "t") and node.text]


def _sheet_list(workbook: bytes, relations: bytes) -> Iterator[dict]:
    sheets = [e for e in ElementTree.fromstring(workbook).iter() if _is(e, "sheet")]
    for position, sheet in enumerate(sheets, 1):
        (rel_id,) = [value for key, value in sheet.attrib.items() if key.endswith("}id")]
        yield {"kind": "sheet", "cell_no": position, "raw": sheet.get("name"), "ref": rel_id}
    for relation in ElementTree.fromstring(relations):
        yield {"kind": "relation", "ref": relation.get("Id"), "raw": relation.get("Target")}


def _style_list(styles: bytes) -> Iterator[dict]:
    for group in ElementTree.fromstring(styles):
        if _is(group, "numFmts"):
            for fmt in group:
                code = fmt.get("formatCode", "")
                yield {"kind": "format", "s": int(fmt.get("numFmtId")), "raw": code}
        elif _is(group, "cellXfs"):
            for position, style in enumerate(group):
                yield {"kind": "style", "cell_no": position, "s": int(style.get("numFmtId", "0"))}


def _elements(stream, root_name: str, row_name: str) -> Iterator[ElementTree.Element]:
    """The finished `row_name` elements of a part, each freed once it was used."""
    parents: list[ElementTree.Element] = []
    ending = "}" + row_name
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            if not parents and not _is(element, root_name):
                return
            parents.append(element)
            continue
        parents.pop()
        if element.tag.endswith(ending):
            yield element
            parents[-1].clear()


def shared_strings(stream) -> Iterator[dict]:
    for position, item in enumerate(_elements(stream, "sst", "si")):
        for run_no, text in enumerate(_texts(item) or [""]):
            yield {"kind": "string", "row_no": position, "cell_no": run_no, "raw": text}


def sheet_cells(stream, part: str) -> Iterator[dict]:
    for row_no, row in enumerate(_elements(stream, "worksheet", "row"), 1):
        place = {"kind": "cell", "part": part, "row_no": row_no}
        cells = [cell for cell in row if _is(cell, "c")]
        if not cells:
            yield place | {"cell_no": 0}
        for cell_no, cell in enumerate(cells):
            value = inline = None
            for child in cell:
                if value is None and _is(child, "v"):
                    value = child
                elif inline is None and _is(child, "is"):
                    inline = child
            yield place | {
                "cell_no": cell_no,
                "ref": cell.get("r", "A1"),
                "t": cell.get("t"),
                "s": int(cell.get("s", "0")),
                "raw": None if value is None else value.text,
                "inline": None if inline is None else "".join(_texts(inline)),
            }
