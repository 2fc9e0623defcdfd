"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seed within their source and numbered. Row r of n stands at (r - 1/2) / n, so every
source is spread evenly over (0, 1). All rows are then ordered by that fraction and cut into shards at equal
numbers of rows: each shard holds the mixture of the whole table, and shards differ by one row at most.

Defined results: a row without a source belongs to a source of its own, ordered last; rows that agree in id
and source are interchangeable; an empty table has no rows. Every column of the frame is carried along, so
only the columns wanted should be passed; names starting with an underscore are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.running import group_key, kept, seeded_fraction, totals_before


def interleave(
    df: DataFrame, shards: int, seed: int, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """The rows with ``shard`` (from 0) and ``slot``, their place in the shard (from 0)."""
    if shards < 1:
        raise ValueError("there must be a shard")
    drawn = kept(
        df.withColumns(
            {
                "_source": group_key(F.col(source_col)),
                "_draw": seeded_fraction(seed, F.col(id_col)),
                "_none": F.col(source_col).isNull(),
            }
        )
    )
    one = F.lit(1).cast("bigint")
    ranked = totals_before(drawn, "_source", "_draw", [id_col], one, "_rank", "_size")
    spread = kept(
        ranked.withColumns({"_fraction": (F.col("_rank") + 0.5) / F.col("_size"), "_all": F.lit("")}).drop("_rank", "_size")
    )
    order = ["_none", "_source", "_draw", id_col]
    placed = totals_before(spread, "_all", "_fraction", order, one, "_place", "_rows")
    shard = F.expr(f"_place * {shards} div _rows")
    first = F.expr(f"(shard * _rows + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_place") - first)
        .drop("_source", "_draw", "_none", "_fraction", "_all", "_place", "_rows")
    )
