"""Workbook semantics over long cell tables: many workbooks and sheets at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.sheet import (
    DATE_FORMAT_IDS,
    column_index,
    fit_width,
    is_date_code,
    serial_to_timestamp,
    timestamp_text,
)
from tillroll.schemas import SHEET_COLUMN

#: `row_no` counts the row elements of a sheet from here.
FIRST_ROW = 1

_POSITION = ["workbook", "sheet_no", "row_no"]


def assemble_strings(runs: DataFrame) -> DataFrame:
    """Text runs `(workbook, idx, run_no, text)` to shared strings `(workbook, idx, text)`.

    A group is the runs of one string, which a cell's text limit bounds.
    """
    ordered = F.sort_array(F.collect_list(F.struct("run_no", "text")))
    return runs.groupBy("workbook", "idx").agg(
        F.array_join(ordered["text"], "").alias("text")
    )


def date_styles(styles: DataFrame, formats: DataFrame) -> DataFrame:
    """The `(workbook, s)` of every style that shows a date."""
    custom = (
        formats.filter(is_date_code(F.col("code")))
        .select("workbook", "fmt_id")
        .distinct()
        .withColumn("custom", F.lit(True))
    )
    return (
        styles.join(custom, ["workbook", "fmt_id"], "left")
        .filter(F.col("fmt_id").isin(DATE_FORMAT_IDS) | F.col("custom"))
        .select("workbook", "s")
    )


def sheet_catalog(sheets: DataFrame, relations: DataFrame, parts: DataFrame) -> DataFrame:
    """`(workbook, sheet_no, name, part)`: sheets with the part that holds their rows.

    A target may be relative to `xl/` or absolute. A sheet without its relation, or
    whose part is not among the container's `parts` (`workbook, part`), fails the
    job rather than losing its rows. A sheet without rows is no failure.
    """
    target = F.ltrim(F.col("target"), F.lit("/"))
    part = F.when(target.startswith("xl/"), target).otherwise(F.concat(F.lit("xl/"), target))

    def problem(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(text), F.col("name"))).cast("string")

    related = sheets.join(relations, ["workbook", "rel_id"], "left").withColumn(
        "part", F.when(F.col("target").isNull(), problem("No relation for sheet: ")).otherwise(part)
    )
    present = parts.select("workbook", "part").distinct().withColumn("present", F.lit(True))
    return related.join(present, ["workbook", "part"], "left").select(
        "workbook",
        "sheet_no",
        "name",
        F.when(F.col("present"), F.col("part")).otherwise(problem("No part for sheet: ")).alias("part"),
    )


def place_cells(cells: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds `sheet_no` and `sheet` to cells; parts that are no sheet of the workbook go.

    The catalog has a row per sheet, and Catalyst broadcasts it while it is small.
    Placing narrow cells leaves nothing to join once rows are assembled.
    """
    return cells.join(catalog.withColumnRenamed("name", "sheet"), ["workbook", "part"])


def resolve_cells(cells: DataFrame, strings: DataFrame, date_styles: DataFrame) -> DataFrame:
    """Column (`col`) and text (`value`) of each cell, with `row_no`, `cell_no` and where it stands.

    Only cells that show a shared string go through the string lookup; the others
    meet the date styles, a table of a few rows per workbook that Catalyst can
    broadcast by itself. Each string goes through the exchange once; where very many
    cells show one, adaptive execution splits them by their measured bytes, and only
    that part of the strings is read several times.
    """
    place = [c for c in ("workbook", "part", "sheet_no", "sheet", "row_no", "cell_no") if c in cells.columns]
    has_raw = F.col("raw").isNotNull()
    by_index = F.coalesce((F.col("t") == "s") & has_raw, F.lit(False))
    by_text = (F.col("t").eqNullSafe("inlineStr")) & F.col("inline").isNotNull()

    lookup = strings.select("workbook", F.col("idx").cast("long").alias("idx"), "text")
    shown = cells.filter(by_index).select(
        *place,
        "ref",
        "raw",
        F.col("raw").cast("long").alias("idx"),
    )
    no_string = F.raise_error(F.concat(F.lit("No shared string "), F.col("raw"))).cast("string")
    shared = shown.join(lookup, ["workbook", "idx"], "left").select(
        *place, "ref", F.when(F.col("text").isNull(), no_string).otherwise(F.col("text")).alias("value")
    )

    dates = date_styles.select("workbook", "s").distinct().withColumn("is_date", F.lit(True))
    styled = cells.filter(~by_index).withColumn("s", F.coalesce("s", F.lit(0))).join(dates, ["workbook", "s"], "left")
    # steps of their own, so that each is computed once per cell
    serial = F.when(F.col("is_date") & ~by_text, F.col("raw").try_cast("double"))
    moments = styled.withColumn("serial", serial).withColumn("moment", serial_to_timestamp(F.col("serial")))
    # text under a date style is no serial number and stays as it is
    plain = F.coalesce(timestamp_text(F.col("moment")), F.col("raw"), F.lit(""))
    others = moments.select(*place, "ref", F.when(by_text, F.col("inline")).otherwise(plain).alias("value"))
    return shared.unionByName(others).select(*place, column_index(F.col("ref")).alias("col"), "value")


def _row_keys(resolved: DataFrame) -> list[str]:
    return [c for c in ("workbook", "part", "sheet_no", "sheet", "row_no") if c in resolved.columns]


def rows_from_cells(resolved: DataFrame, width: int | None = None) -> DataFrame:
    """The row's keys and `row`: an array of texts per worksheet row, gaps `""`.

    Rows are ragged: an array ends at the last cell present, or below `width`. A
    column given twice keeps its later cell. A record with a null `ref` marks a row
    without cells and yields an empty array. What is exchanged are the cells that a
    row has, however wide the sheet is; a group is one worksheet row, which the
    file format bounds.
    """
    inside = F.col("col").isNotNull() if width is None else F.col("col") < width
    # of a null struct collect_list keeps nothing, so a row of no such cells is an empty list
    cell = F.when(inside, F.struct("col", "cell_no", "value"))
    grouped = resolved.groupBy(*_row_keys(resolved)).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    cells = F.col("cells")
    last = F.filter(cells, lambda c, i: ~F.get(cells["col"], i + 1).eqNullSafe(c["col"]))
    kept = grouped.withColumn("cells", last)
    # each cell brings the gap before it, so the row is built in one pass
    with_gaps = F.transform(
        cells,
        lambda c, i: F.concat(
            F.array_repeat(F.lit(""), c["col"] - F.coalesce(F.get(cells["col"], i - 1), F.lit(-1)) - 1),
            F.array(c["value"]),
        ),
    )
    return kept.select(*_row_keys(resolved), F.flatten(with_gaps).alias("row"))


def columns_from_cells(resolved: DataFrame, width: int) -> DataFrame:
    """The row's keys and `c0 ...`: cells on `width` known columns.

    Gaps are `""`; cells beyond the width are dropped before the exchange; a column
    given twice keeps its later cell.
    """
    names = [f"c{i}" for i in range(width)]
    return columns_from_rows(rows_from_cells(resolved, width), names, keep=_row_keys(resolved))


def column_names(header: Sequence[str]) -> list[str]:
    """Header texts as column names: `_cN` for a blank, the position added to a repeat.

    A name that the union adds itself counts as repeated. Where a made name is
    taken, also by a header further on, the position is added again until it is free.
    """
    folded = [name.lower() for name in [*header, SHEET_COLUMN, *_POSITION]]
    taken = set(folded)
    names = []
    for position, name in enumerate(header):
        if not name or folded.count(name.lower()) > 1:
            name = f"{name or '_c'}{position}"
            while name.lower() in taken:
                name = f"{name}_{position}"
            taken.add(name.lower())
        names.append(name)
    return names


def header_names(rows: DataFrame) -> list[str]:
    """Column names from the first row of each workbook's first non-empty sheet.

    Later sheets are not asked. Workbooks that disagree are an error, as their
    columns could only be stacked wrongly. At most two rows reach the driver.
    """
    headers = (
        rows.filter(F.col("row_no") == FIRST_ROW)
        .groupBy("workbook")
        .agg(F.min_by("row", "sheet_no").alias("row"))
        .select("row")
        .distinct()
        .limit(2)
        .collect()
    )
    if len(headers) > 1:
        raise ValueError(f"workbooks disagree on the header: {headers[0].row} / {headers[1].row}")
    return column_names(headers[0].row) if headers else []


def header_alignment(rows: DataFrame) -> DataFrame:
    """`workbook, col, name` of every workbook's own header, from assembled first rows.

    A name is what stands in the first row of the workbook's first sheet that has one; a
    blank or repeated one gets its position, as in `column_names`. Workbooks whose made
    names meet another of their names are an error.
    """
    heads = rows.filter(F.col("row_no") == FIRST_ROW).groupBy("workbook").agg(F.min_by("row", "sheet_no").alias("row"))
    reserved = F.array(*[F.lit(name.lower()) for name in [SHEET_COLUMN, *_POSITION]])
    folded = F.concat(F.transform("row", F.lower), reserved)

    def made(name: Column, at: Column) -> Column:
        once = F.size(F.filter(folded, lambda other: other == F.lower(name))) == 1
        numbered = F.concat(F.when(name == "", F.lit("_c")).otherwise(name), at.cast("string"))
        return F.when((name != "") & once, name).otherwise(numbered)

    named = heads.select("workbook", F.transform("row", made).alias("names"))
    distinct = F.size(F.array_distinct(F.transform("names", F.lower))) == F.size("names")
    problem = F.raise_error(F.concat(F.lit("made column names repeat others in "), F.col("workbook")))
    checked = named.select("workbook", F.when(distinct, F.col("names")).otherwise(problem.cast("array<string>")).alias("names"))
    return checked.select("workbook", F.posexplode("names").alias("col", "name"))


def aligned_names(alignment: DataFrame) -> list[str]:
    """All workbooks' column names: those of the first workbook in its order, then what others add."""
    first = alignment.groupBy("name").agg(F.min(F.struct("workbook", "col")).alias("first")).orderBy("first").collect()
    names = [r.name for r in first]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"column names that differ in case only: {sorted(names, key=str.lower)}")
    return names


def align_cells(resolved: DataFrame, alignment: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cells moved to the column of their header's name.

    Those beyond their header lose their column, so that only their row is left of them.
    """
    places = F.create_map(*[F.lit(x) for pair in ((n, i) for i, n in enumerate(names)) for x in pair])
    moves = alignment.select("workbook", "col", F.try_element_at(places, F.col("name")).alias("to"))
    moved = resolved.join(moves, ["workbook", "col"], "left").withColumn("col", F.col("to"))
    return moved.select(*resolved.columns)


def columns_from_rows(rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Array rows as named text columns, cut or padded to the number of names."""
    fitted = rows.select(*keep, fit_width(F.col("row"), len(names)).alias("row"))
    return fitted.select(*keep, *[F.col("row")[i].alias(name) for i, name in enumerate(names)])


def first_rows(cells: DataFrame) -> DataFrame:
    """The cells of every sheet's first row."""
    return cells.filter(F.col("row_no") == FIRST_ROW)


def used_runs(cells: DataFrame, runs: DataFrame) -> DataFrame:
    """The text runs of the shared strings that these cells show."""
    shown = cells.filter(F.col("t") == "s").select(
        "workbook", F.col("raw").try_cast("long").alias("idx")
    )
    return runs.join(shown, ["workbook", "idx"], "left_semi")


def union_sheets(resolved: DataFrame, names: Sequence[str]) -> DataFrame:
    """All placed cells' rows below their sheet's first one, stacked by position, with the sheet's name.

    `workbook, sheet_no, row_no` keep the original order, which a table has not.
    """
    body = columns_from_cells(resolved.filter(F.col("row_no") > FIRST_ROW), len(names))
    return body.select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(names)],
        F.col("sheet").alias(SHEET_COLUMN),
        *_POSITION,
    )
