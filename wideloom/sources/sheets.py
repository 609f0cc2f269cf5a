"""Workbook sheets as a cell grid.

A workbook arrives as a *cell grid* (XLSX bytes are decoded into one by
the caller's reader): one row per sheet row with ``file``, ``sheet_pos``, ``sheet``,
``row_idx`` (0 = header) and ``cells ARRAY<STRING>``. :func:`stack_sheets` applies the table
rules to it with DataFrame operations:

* a sheet with fewer than two rows, or with no data row left, is skipped;
* header cells are trimmed text; a blank header cell becomes ``col_<i>``;
  a repeated one gets its position as a suffix;
* a data row whose cells are all null is dropped; short rows are padded with nulls and cells past
  the header are ignored;
* a ``_sheet`` column names the sheet; several sheets are combined as the reconciling union
  would (first-seen column order, missing columns null), in one projection over the grid.

Only per-sheet metadata (header row, row counts: one small row per sheet) reaches the driver;
the grid is read twice (that metadata, then the rows), whatever the number of sheets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.columns import unique_names


CELL_GRID_SCHEMA = "file string, sheet_pos int, sheet string, row_idx int, cells array<string>"


class NoDataSheetsError(ValueError):
    pass


def header_names(cells: Column) -> Column:
    """Column names from a header row: each cell without surrounding white space; an empty
    (null) cell is named by its position, ``col_<i>``."""
    return F.transform(cells, lambda c, i: F.coalesce(
        F.regexp_replace(c, r"^\s+|\s+$", ""), F.concat(F.lit("col_"), i.cast("string"))))


def stack_sheets(grid: DataFrame, *, file: str | None = None) -> DataFrame:
    """S2 for one workbook (or every workbook when ``file`` is None and there is one)."""
    if file is not None:
        grid = grid.filter(F.col("file") == file)
    has_value = F.exists("cells", lambda c: c.isNotNull())
    stats = (grid.groupBy("sheet_pos", "sheet")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(F.when((F.col("row_idx") > 0) & has_value, 1)).alias("n_data"),
                  F.max_by(F.when(F.col("row_idx") == 0, header_names(F.col("cells"))),
                           F.col("row_idx") == 0).alias("header"))
             .orderBy("sheet_pos"))
    sheets = []
    for s in stats.collect():  # one row per sheet
        if s.n_rows < 2 or s.n_data == 0 or s.header is None:
            continue
        names = unique_names(s.header)
        sheets.append((s.sheet_pos, s.sheet, names))
    if not sheets:
        raise NoDataSheetsError("no data sheets found in workbook")
    # Every cell is text, so the reconciling union of the sheets (first-seen column order, a
    # column a sheet lacks is null there) is one projection: each output column takes its cell
    # by the row's sheet. One pass over the grid instead of one per sheet.
    order: dict[str, None] = {}
    for _, _, names in sheets:
        order.update(dict.fromkeys(names + ["_sheet"]))
    pos = F.col("sheet_pos")
    cols = []
    for name in order:
        if name == "_sheet":
            cols.append(F.col("sheet").alias("_sheet"))
            continue
        expr = None
        for p, _, names in sheets:
            if name in names:
                cell = F.get(F.col("cells"), names.index(name))
                expr = F.when(pos == p, cell) if expr is None else expr.when(pos == p, cell)
        cols.append(expr.alias(name))
    kept = [p for p, _, _ in sheets]
    return grid.filter(pos.isin(kept) & (F.col("row_idx") > 0) & has_value).select(*cols)
