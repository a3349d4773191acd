"""Workbooks to one retail table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.sheets import (
    align_cells,
    aligned_names,
    assemble_strings,
    date_styles,
    first_rows,
    header_alignment,
    header_names,
    place_cells,
    resolve_cells,
    rows_from_cells,
    sheet_catalog,
    union_sheets,
    used_runs,
)
from tillroll.sources.staging import staged
from tillroll.sources.workbook_source import opens, scan_workbooks
from tillroll.sources.workbooks import WorkbookTables, read_workbook_records, split_records


def catalog_of(tables: WorkbookTables) -> DataFrame:
    return sheet_catalog(tables.sheets, tables.relations, tables.parts)


def head_rows(tables: WorkbookTables) -> DataFrame:
    """The first row of every sheet, from the few strings that it shows."""
    heads = place_cells(first_rows(tables.cells), catalog_of(tables))
    resolved = resolve_cells(
        heads,
        assemble_strings(used_runs(heads, tables.string_runs)),
        date_styles(tables.styles, tables.formats),
    )
    return rows_from_cells(resolved)


def header_of(tables: WorkbookTables) -> list[str]:
    """Column names of the stacked table."""
    return header_names(head_rows(tables))


def stacked_sheets(
    tables: WorkbookTables, columns: Sequence[str] | None = None, by_name: bool = False
) -> DataFrame:
    """The sheets of the workbooks behind `tables` as one table.

    Columns are stacked by position, and workbooks must agree on their header. With
    `by_name` each workbook's columns go where their names are: headers may differ in
    order and number, and a column that a workbook lacks is `""` there.
    """
    if by_name:
        alignment = staged(header_alignment(head_rows(tables)), "header-alignment")
        columns = aligned_names(alignment) if columns is None else columns
    elif columns is None:
        columns = header_of(tables)
    resolved = resolve_cells(
        place_cells(tables.cells, catalog_of(tables)),
        assemble_strings(tables.string_runs),
        date_styles(tables.styles, tables.formats),
    )
    if by_name:
        resolved = align_cells(resolved, alignment, columns)
    return union_sheets(resolved, columns)


def ingest_workbooks(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    name: str = "workbook-records",
    by_name: bool = False,
) -> DataFrame:
    """All sheets of all workbooks below `path`, stacked, with their provenance.

    The workbooks are decoded once, into a table in the shared staging folder,
    partitioned by kind of record. Tasks read their parts from the containers; only
    where Spark alone reaches the path do containers go through Spark. Give `columns` to skip the look at the
    headers; like a CSV schema they then apply by position. `by_name` looks at every
    workbook's header and stacks by name, see `stacked_sheets`. `name` starts the
    staged table's folder; a job that is done with the result can delete it.
    """
    read = scan_workbooks if opens(path) else read_workbook_records
    records = staged(read(spark, path), name, "kind")
    return stacked_sheets(split_records(records), columns, by_name)
