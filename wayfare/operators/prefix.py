"""Running aggregates over the earlier rows of a group, for groups of any size.

Rows are dealt once, by ranges of (group, order), and sorted inside them: a group of any size is cut like any other rows,
and no task holds more than its range. One pass over the sorted rows of a range adds up what comes before each row in the
range. Only the first group of a range can have earlier rows elsewhere, and only the last group of a range
can have later ones, so what is left is one row per range: the total of its last group. The totals of
earlier ranges are carried into the rows of a first group by a join on the number of the range.

There is one plan, whatever the sizes. The sorted rows are a ``checkpoint()``, since the bounds of ranges are sampled and
a second evaluation could cut elsewhere; it runs while the frame is built. Sums are of whole numbers or decimals and
therefore the same however rows are cut; sums of doubles would not be and are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import ensure_checkpoint_dir

#: places of a row in its range
_FIRST, _LAST = 1, 2

_COMBINE: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max, "min": F.min}


def running_before(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[Column],
    running: Mapping[str, tuple[str, Column]],
    ranges: int | None = None,
) -> DataFrame:
    """Add, for each ``name: (kind, value)``, the aggregate of the rows before this one.

    Without ``group_by`` all rows are one group. ``kind`` is ``sum``, ``max`` or ``min``; values are bigints, or decimals for sums. Nulls count as nothing, and the
    first row of a group gets null. ``order_by`` must be a total order within the group for the result to be repeatable,
    and for rows to be cut anywhere. ``ranges`` is the number of tasks, by default that of shuffles.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = {name: f"_in_{name}" for name in running}
    valued = df.withColumns({own[name]: value for name, (_, value) in running.items()})
    kinds = {name: kind for name, (kind, _) in running.items()}
    for name in running:
        _check(kinds[name], valued.schema[own[name]].dataType)
    sorted_ = valued.repartitionByRange(ranges, *group_by, *order_by).sortWithinPartitions(*group_by, *order_by)
    schema = T.StructType(
        [
            *sorted_.schema,
            *(T.StructField(name, sorted_.schema[own[name]].dataType) for name in running),
            T.StructField("_head", T.BooleanType()),
            T.StructField("_edge", T.IntegerType()),
        ]
    )
    local = sorted_.mapInArrow(_pass_over_range(list(group_by), kinds), schema)
    stored = local.withColumn("_range", F.spark_partition_id()).checkpoint()
    carried = F.broadcast(_carried(stored, group_by, kinds))
    joined = stored.join(carried, "_range", "left")
    totals = {
        name: F.when(F.col("_head"), _both(kind, F.col(name), F.col(f"_before_{name}"))).otherwise(F.col(name))
        for name, kind in kinds.items()
    }
    return joined.withColumns(totals).select(*df.columns, *running)


def position_in_group(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[Column],
    name: str = "position",
    ranges: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    counted = running_before(df, group_by, order_by, {name: ("sum", F.lit(1).cast("bigint"))}, ranges)
    return counted.withColumn(name, F.coalesce(F.col(name), F.lit(0)) + F.lit(1))


def _check(kind: str, data_type: T.DataType) -> None:
    if kind not in _COMBINE:
        raise ValueError("an aggregate is a sum, max or min")
    decimal = isinstance(data_type, T.DecimalType) and data_type.precision < 38
    if not (isinstance(data_type, T.LongType) or kind == "sum" and decimal):
        raise ValueError("values must be bigints, or for sums decimals of at most 37 digits")


def _both(kind: str, one: Column, other: Column) -> Column:
    """The aggregate of two parts, each of which may be null."""
    if kind == "sum":
        return F.when(one.isNull(), other).when(other.isNull(), one).otherwise(one + other)
    return F.greatest(one, other) if kind == "max" else F.least(one, other)


def _carried(stored: DataFrame, group_by: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """(_range, _before_name …): what earlier ranges hold of the first group of a range. At most a row per range."""
    edges = stored.filter("_edge > 0")
    asks = edges.filter(F.col("_edge").bitwiseAND(_FIRST) > 0).select(
        *group_by,
        "_range",
        F.lit(False).alias("_gives"),
        *(F.lit(None).cast(stored.schema[name].dataType).alias(f"_before_{name}") for name in kinds),
    )
    gives = edges.filter(F.col("_edge").bitwiseAND(_LAST) > 0).select(
        *group_by,
        "_range",
        F.lit(True).alias("_gives"),
        *(
            _both(kind, F.col(name), F.col(f"_in_{name}")).cast(stored.schema[name].dataType).alias(f"_before_{name}")
            for name, kind in kinds.items()
        ),
    )
    # a range asks before it gives, so it does not get its own
    earlier = Window.partitionBy(*group_by).orderBy("_range", "_gives").rowsBetween(Window.unboundedPreceding, -1)
    summed = asks.union(gives).withColumns(
        {
            f"_before_{name}": _COMBINE[kind](f"_before_{name}").over(earlier).cast(stored.schema[name].dataType)
            for name, kind in kinds.items()
        }
    )
    return summed.filter("not _gives").select("_range", *(f"_before_{name}" for name in kinds))


def _pass_over_range(group_by: list[str], kinds: dict[str, str]):
    """Adds to the sorted rows of a range what comes before each in its group, and marks its first group and its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, totals, in_head, first = None, {}, True, True
        held: tuple[pa.RecordBatch, list, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(name) for name in group_by]
            starts = _changes(key, batch.num_rows)
            goes_on = last_key is not None and [column[0].as_py() for column in key] == last_key
            starts[0] = not goes_on
            group = np.cumsum(starts) - (not goes_on)
            head = (group == 0) if in_head and (first or goes_on) else np.zeros(len(group), bool)
            columns = []
            for name, kind in kinds.items():
                values = batch.column(f"_in_{name}")
                found, totals[name] = _RUNNING[kind, pa.types.is_decimal(values.type)](
                    values, group, totals[name] if goes_on else None, kind
                )
                columns.append(found)
            in_head = bool(head[-1])
            last_key = [column[-1].as_py() for column in key]
            edge = np.zeros(batch.num_rows, np.int32)
            edge[0] = _FIRST if first else 0
            first = False
            if held:
                yield _with(*held)
            held = batch, [*columns, pa.array(head)], edge
        if held:
            held[2][-1] |= _LAST
            yield _with(*held)

    def _with(batch: pa.RecordBatch, columns: list, edge: np.ndarray) -> pa.RecordBatch:
        names = [*batch.schema.names, *kinds, "_head", "_edge"]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(edge)], names)

    return run


def _changes(key: list[pa.Array], rows: int) -> np.ndarray:
    """Whether a row has another key than the one before it; the first row does not count."""
    changed = np.zeros(rows, bool)
    for column in key:
        one, other = column[: rows - 1], column[1:]
        differs = pc.fill_null(pc.not_equal(one, other), False)
        one_null = pc.not_equal(pc.is_null(one), pc.is_null(other))
        changed[1:] |= pc.or_(differs, one_null).to_numpy(zero_copy_only=False)
    return changed


def _seen_before(valid: np.ndarray, group: np.ndarray, carried: bool) -> np.ndarray:
    """Whether a row of the group before this one has a value."""
    counts = np.cumsum(valid) - valid
    starts = np.searchsorted(group, group)
    seen = counts > counts[starts]
    return seen | (group == 0) if carried else seen


def _before(limbs: np.ndarray, group: np.ndarray, carried: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of the group before each row, and of the last group with its last row."""
    through = np.cumsum(limbs, axis=0)
    excluded = through - limbs
    starts = np.searchsorted(group, group)
    sums = excluded - excluded[starts]
    sums[group == 0] += carried
    return sums, sums[-1] + limbs[-1]


def _whole_sums(values: pa.Array, group: np.ndarray, total, kind: str):
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    numbers = values.fill_null(0).to_numpy(zero_copy_only=False)
    sums, last = _before(numbers, group, 0 if total is None else total)
    seen = _seen_before(valid, group, total is not None)
    left = last if seen[-1] or valid[-1] else None
    return pa.array(sums, values.type, mask=~seen), left


def _decimal_sums(values: pa.Array, group: np.ndarray, total, kind: str):
    """Sums of decimals by their 128-bit numbers, four words each, without rounding."""
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    filled = pa.concat_arrays([values.fill_null(0)])
    words = np.frombuffer(filled.buffers()[1], "<u4")[filled.offset * 4 : (filled.offset + len(filled)) * 4]
    sums, last = _before(words.reshape(-1, 4).astype(np.int64), group, 0 if total is None else total)
    sums, last = _normal(sums), _normal(last[None])[0]
    seen = _seen_before(valid, group, total is not None)
    left = last if seen[-1] or valid[-1] else None
    buffers = [pa.py_buffer(np.packbits(seen, bitorder="little").tobytes()), pa.py_buffer(sums.astype("<u4").tobytes())]
    return pa.Array.from_buffers(values.type, len(values), buffers), left


def _normal(sums: np.ndarray) -> np.ndarray:
    """Words of 32 bits each; what is beyond 128 bits wraps, as in two's complement."""
    sums = sums.copy()
    for word in range(3):
        sums[:, word + 1] += sums[:, word] >> 32
    return sums & 0xFFFFFFFF


def _extremes(values: pa.Array, group: np.ndarray, total, kind: str):
    nothing = np.iinfo(np.int64).min if kind == "max" else np.iinfo(np.int64).max
    numbers = values.fill_null(nothing).to_numpy(zero_copy_only=False)
    # what was carried stands ahead of the rows
    numbers, groups = np.concatenate([[nothing if total is None else total], numbers]), np.concatenate([[0], group])
    by_group = pd.Series(numbers).groupby(groups, sort=False)
    through = (by_group.cummax() if kind == "max" else by_group.cummin()).to_numpy()
    before = np.where(np.diff(groups) == 0, through[:-1], nothing)
    left = None if through[-1] == nothing else int(through[-1])
    return pa.array(before, values.type, mask=before == nothing), left


_RUNNING = {
    ("sum", False): _whole_sums,
    ("sum", True): _decimal_sums,
    ("max", False): _extremes,
    ("min", False): _extremes,
}
