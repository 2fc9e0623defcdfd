"""Cells on the straight way between two points.

A way runs from west to east, so it can be described column by column: the way enters grid column
``i`` in some row and leaves it in another, and both rows follow from the height of the line in the
middle of that column. That makes all columns of all ways of a batch one flat numpy computation,
instead of a walk that needs the previous step to find the next one.

With ``y`` the height of the line in the middle of a column and TOLERANCE around whole numbers:

* going down (row numbers grow), a way leaves column ``i`` in the first row whose number is above
  ``y - TOLERANCE``; if that row is also within TOLERANCE of ``y``, the next column is entered one
  row further (a diagonal step);
* going up or level, it leaves in the last row whose number is below ``y + TOLERANCE``, and a
  diagonal step also passes over one whole column. Of neighbouring columns that would all step
  diagonally, those at odd distance from the first are therefore never visited; neighbours that
  would use the same row only use it once.

The way ends in the row of its end point, in its last column or, after a diagonal step at the very
end, one column beyond.

A column depends on the two before it and on where the run of diagonal steps it is in began. A way of any length is
therefore made piece by piece: a piece starts a few columns early, with that one number from the piece before.
:func:`path_cells` gives a row per cell and holds no more than a piece; :func:`grid_path` gives an array per way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.geo import GRID_COLUMNS, grid_x, grid_y

# Reach of a diagonal step, and what keeps the slope of an upright way finite.
TOLERANCE = 0.05
EPSILON = 0.00000001

#: columns or cells computed at once; bounds the memory of a Python worker, not the length of a way
CELLS_PER_CHUNK = 1_000_000
#: rows given at once
CELLS_PER_BATCH = 100_000
#: columns a piece starts early
_LEAD = 4
#: Any two points on earth are under 300,000 cells apart. Beyond this, coordinates are corrupt, and
#: an array of the way may not fit a worker: that is an error in :func:`grid_path` only.
LONGEST_WAY = 1_000_000


def grid_path(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """``array<int>`` of the cells on the way, always listed from west to east; an error beyond LONGEST_WAY."""
    return _way_cells(grid_x(lon1), grid_y(lat1), grid_x(lon2), grid_y(lat2))


def _ranges(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For consecutive runs of the given lengths: the run of each element, and its place in it."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return run, np.arange(len(run)) - first[run]


def _shifted(values: np.ndarray, by: int, fill) -> np.ndarray:
    out = np.empty_like(values)
    out[:by] = fill
    out[by:] = values[:-by]
    return out


@dataclass(frozen=True)
class _Stretches:
    """What ways cover of each grid column: ``rows`` cells from ``cell`` on, ``step`` apart. Ways are numbered by ``way``."""

    way: np.ndarray
    cell: np.ndarray
    step: np.ndarray
    rows: np.ndarray
    run_start: np.ndarray

    def cells(self, low: int = 0, high: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The way and the id of the cells from number ``low`` up to ``high`` of all."""
        high = self.count if high is None else min(high, self.count)
        first, last = np.searchsorted(self.through, [low, high - 1], "right")
        part = slice(first, last + 1)
        before = self.through[part] - self.rows[part]
        skipped = np.maximum(low - before, 0)
        entry, place = _ranges(np.minimum(self.through[part], high) - before - skipped)
        cells = self.cell[part][entry] + (place + skipped[entry]) * self.step[part][entry]
        return self.way[part][entry], cells.astype(np.int32)

    @cached_property
    def through(self) -> np.ndarray:
        return np.cumsum(self.rows)

    @property
    def count(self) -> int:
        return int(self.through[-1])


def _stretches(
    x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, columns: tuple[int, int] | None = None, run_start: int = 0
) -> _Stretches:
    """Stretches of all ways; of a single way also of some ``columns`` only.

    ``run_start`` is then the column in which the run of diagonal steps began that reaches the first of the columns
    that are computed, ``_LEAD`` before those wanted.
    """
    swap = x1 > x2
    x_start, x_end = np.where(swap, x2, x1), np.where(swap, x1, x2)
    y_start, y_end = np.where(swap, y2, y1), np.where(swap, y1, y2)
    width = x_end - x_start
    slope = (y_end - y_start) / (width + EPSILON)

    # one entry per grid column a way can touch, including the one beyond its end
    if columns is None:
        first, wanted, (way, column) = 0, 0, _ranges(width + 2)
    else:
        first, wanted = max(0, columns[0] - _LEAD), columns[0]
        column = np.arange(first, columns[1])
        way = np.zeros(len(column), np.int64)
    down = (slope > 0)[way]
    sign = np.where(down, 1, -1)
    from_row, to_row = y_start[way], y_end[way]
    height = (column + 0.5) * slope[way] + from_row - 0.5 * sign

    # row where the column is left, and whether that is a diagonal step
    near = np.where(down, np.floor(height), np.ceil(height))
    leave_near = np.where(down, height < near + TOLERANCE, height > near - TOLERANCE)
    leave = np.where(leave_near, near, near + sign)
    diagonal = (height > leave - TOLERANCE) & (height < leave + TOLERANCE)
    after = leave + sign * diagonal

    # going up: drop the columns passed over by the diagonal steps before them
    index = np.arange(len(way))
    run_goes_on = _shifted(diagonal, 1, False) & (column > 0)
    starts = np.where(diagonal & run_goes_on, np.iinfo(np.int64).min, index)
    if first:
        starts[0] = run_start - first
    starts = np.maximum.accumulate(starts)
    steps = diagonal & ((index - starts) % 2 == 0) & ((index == starts) | (leave != _shifted(leave, 1, 0)))
    passed_over = _shifted(steps & ~down, 1, False) & (column > 0)

    # row where the column is entered: what the last visited column left behind
    previous = np.where(_shifted(passed_over, 1, False), _shifted(after, 2, 0), _shifted(after, 1, 0))
    enter = np.where(column == 0, from_row, previous)
    enter = np.where(down, np.maximum(enter, from_row), np.minimum(enter, from_row)).astype(np.int64)

    # the last column is followed to the end row; nothing comes after it
    is_end = column == width[way]
    beyond = column > width[way]
    end_passed_over = _shifted(passed_over & is_end, 1, False)
    last = (is_end & ~passed_over) | (beyond & end_passed_over)
    kept = ~passed_over & (~beyond | end_passed_over)
    exit_row = np.where(down, np.maximum(enter, leave), np.minimum(enter, leave))
    exit_row = np.where(last, to_row, exit_row).astype(np.int64)

    rows = np.where(kept & (column >= wanted), np.abs(exit_row - enter) + 1, 0)
    return _Stretches(way, x_start[way] + column + enter * GRID_COLUMNS, sign * GRID_COLUMNS, rows, starts + first)


def way_cells(
    x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Cell ids of all ways one after another, and the number of cells of each way."""
    found = _stretches(x1, y1, x2, y2)
    way, cells = found.cells()
    return cells, np.bincount(way, minlength=len(x1))


def stream_of_cells(
    x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(way, step, cell) of all ways in order, a bounded number at once; steps of a way count from 0."""
    columns = np.abs(x2 - x1) + 2
    for ways in _chunks(columns):
        size = int(columns[ways.start])
        if ways.stop - ways.start > 1 or size <= CELLS_PER_CHUNK:
            pieces = iter([_stretches(x1[ways], y1[ways], x2[ways], y2[ways])])
        else:
            pieces = _pieces_of_a_way(x1[ways], y1[ways], x2[ways], y2[ways], size)
        last, steps = -1, 0
        for piece in pieces:
            for low in range(0, piece.count, CELLS_PER_BATCH):
                way, cells = piece.cells(low, low + CELLS_PER_BATCH)
                # the first cells may go on a way, the others count from their own start
                place = np.arange(len(way)) - np.searchsorted(way, way)
                place[way == last] += steps
                last, steps = int(way[-1]), int(place[-1]) + 1
                yield way + ways.start, place, cells


def _pieces_of_a_way(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, size: int) -> Iterator[_Stretches]:
    run_start = 0
    for low in range(0, size, CELLS_PER_CHUNK):
        high = min(size, low + CELLS_PER_CHUNK)
        piece = _stretches(x1, y1, x2, y2, (low, high), run_start)
        yield piece
        run_start = int(piece.run_start[-_LEAD]) if high - low >= _LEAD else 0


def path_cells(
    df: DataFrame,
    lon1: Column,
    lat1: Column,
    lon2: Column,
    lat2: Column,
    keep: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A row for each cell on the way of each row, with its ``step`` (from 0, west to east) and ``cell``.

    Ways of any length; rows with an unknown corner have no cells. The columns to ``keep`` (all) come along in every row.
    A row makes hundreds of cells, so few large files leave most tasks idle: ``partitions`` deals the rows out before.
    """
    corners = ["_x1", "_y1", "_x2", "_y2"]
    ends = [c.alias(name) for name, c in zip(corners, (grid_x(lon1), grid_y(lat1), grid_x(lon2), grid_y(lat2)))]
    ways = df.select(*(df.columns if keep is None else keep), *ends)
    kept = [field for field in ways.schema if field.name not in corners]
    schema = T.StructType([*kept, T.StructField("step", T.LongType()), T.StructField("cell", T.IntegerType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.logical_and.reduce([batch.column(c).is_valid().to_numpy(zero_copy_only=False) for c in corners])
            rows = np.flatnonzero(known)
            if not len(rows):
                continue
            at = [batch.column(c).take(pa.array(rows)).to_numpy().astype(np.int64) for c in corners]
            others = batch.drop_columns(corners)
            for way, step, cells in stream_of_cells(*at):
                taken = others.take(pa.array(rows[way]))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(step), pa.array(cells)], [*others.schema.names, "step", "cell"]
                )

    return (ways.repartition(partitions) if partitions else ways).mapInArrow(walk, schema)


def _chunks(work: np.ndarray) -> Iterator[slice]:
    """Cut a batch so that each piece stays near CELLS_PER_CHUNK cells (one way at the least)."""
    start, total = 0, 0
    for stop, cells in enumerate(work.tolist()):
        if total and total + cells > CELLS_PER_CHUNK:
            yield slice(start, stop)
            start, total = stop, 0
        total += cells
    if len(work):
        yield slice(start, len(work))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _way_cells(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for batch in batches:
        corners = [array.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for array in batch]
        known = np.logical_and.reduce([array.is_valid().to_numpy(zero_copy_only=False) for array in batch])
        x1, y1, x2, y2 = (np.where(known, corner, 0) for corner in corners)
        work = np.abs(x2 - x1) + np.abs(y2 - y1) + 2
        if len(work) and work.max() > LONGEST_WAY:
            raise ValueError("corrupt coordinates: way too long for one row; filter with in_nyc first")
        for piece in _chunks(work):
            cells, lengths = way_cells(x1[piece], y1[piece], x2[piece], y2[piece])
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(cells), mask=pa.array(~known[piece])
            )
        if not len(work):
            yield pa.array([], pa.list_(pa.int32()))
