"""Hard negatives of anchors among labelled vectors, by angular triangle filtering and exact integer scores.

Vectors have integer components; a score is the inner product. For each row its norm and its angles to a few reference
directions are kept. For an anchor and a row, every reference r bounds the angle between them:
``|a_r - x_r| <= angle <= min(a_r + x_r, 2 pi - a_r - x_r)``. The cosines of the tightest bounds times both norms,
widened by more than the rounding of their computation and rounded outwards, bound the score. Only rows
whose bounds overlap a window of wanted scores are scored, in integers.

Rows are dealt over blocks of bounded size by chance, whatever their vectors, labels or ids. The anchors, which are a
stated query set, visit every block; a block is held as arrays, and anchors stream past it. Inside a block rows are ordered
by label, nearest reference and angle to it, and cut into tiles: bounds are taken for whole tiles first, then
for rows of the tiles that are left. For the best of a label, a row whose upper bound is below the lower bounds of enough
others is left out; for a window likewise, counting rows that lie in it for certain. A block gives the best few per
anchor and window, and those of all blocks are ranked by a window function.

The references are chosen from ``SAMPLED`` rows, farthest first. They decide how much is left out, not what is found.

Defined results: rows without a label or vector, or with a component that is null or not finite, take no part. Rows equal
in id, label and vector count once; others that share an id are rows of their own. A row without an id can be a
partner, is no anchor, and comes last among equal scores. A shorter vector counts as ending in zeros; an empty one scores
0. Components and scores beyond a long count as the nearest long. An anchor without partners has no rows, nor has an
empty table. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.running import Stored

#: rows held at once by a task
ROWS_PER_BLOCK = 100_000
#: rows whose bounds are first taken together
TILE = 64
REFERENCES = 8
#: rows the references are chosen from
SAMPLED = 256

_LONG = 2**63 - 1

_FIELDS = "id long, label long, mark long, vector array<long>, norm double, angles array<double>"
_FOUND = "anchor_id long, anchor_mark long, place int, positive_id long, positive_score long, id long, mark long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """The floor of each component times ``scale``; null if a component is null or not finite."""
    wide = vector.cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * scale)))


def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Lists as rows, ended by zeros."""
    lengths = lists.value_lengths().to_numpy()
    width = max(width, int(lengths.max(initial=0)))
    values = lists.flatten().to_numpy()
    if (lengths == width).all():
        return values.reshape(len(lists), width)
    out = np.zeros((len(lists), width), values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, max(0, width - rows.shape[1]))))


def inner_products(rows: np.ndarray, one: np.ndarray, largest: float) -> np.ndarray:
    """Exact products, cut to a long; ``largest`` bounds them."""
    width = min(rows.shape[1], len(one))
    if largest < 2.0**62:
        return rows[:, :width] @ one[:width]
    exact = rows[:, :width].astype(object) @ one[:width].astype(object)
    return np.array([max(-_LONG, min(_LONG, int(score))) for score in exact], np.int64)


def score_bounds(
    angles: np.ndarray, low: np.ndarray, high: np.ndarray, norm: float, least: np.ndarray, most: np.ndarray, slack: float
) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers around the scores of an anchor with rows whose angles are in ``[low, high]``, norms in ``[least, most]``."""
    near = np.maximum(angles - high, low - angles).max(axis=1, initial=0.0)
    far = np.minimum(angles + high, 2 * math.pi - angles - low).min(axis=1, initial=math.pi)
    upper, lower = np.cos(np.clip(near - slack, 0, math.pi)), np.cos(np.clip(far + slack, 0, math.pi))
    room = norm * most * 1e-9 + 1
    top = norm * np.where(upper >= 0, most, least) * upper + room
    bottom = norm * np.where(lower >= 0, least, most) * lower - room
    return np.floor(bottom), np.ceil(top)


def angle_slack(width: int) -> float:
    """More than an angle can be off: a cosine is off by some units in the last place for each component."""
    return 4 * math.sqrt((width + 16) * np.finfo(float).eps)


def measure(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; a zero vector has angles of zero."""
    wide = vectors.astype(float)
    norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))
    unit = wide / np.where(norms > 0, norms, 1)[:, None]
    width = min(wide.shape[1], references.shape[1])
    angles = np.arccos(np.clip(unit[:, :width] @ references[:, :width].T, -1, 1))
    angles[norms == 0] = 0
    return norms, angles


class Block:
    """Rows as arrays, ordered for tiles with narrow bounds."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: table.column(name).chunk(0)
        labels, angles = column("label").to_numpy(), _matrix(column("angles"))
        if angles.shape[1]:
            order = np.lexsort((angles.min(axis=1), angles.argmin(axis=1), labels))
        else:
            order = np.argsort(labels, kind="stable")
        self.labels, self.angles = labels[order], angles[order]
        self.vectors, self.norms = _matrix(column("vector"))[order], column("norm").to_numpy()[order]
        self.marks = column("mark").to_numpy()[order]
        self.nameless = column("id").is_null().to_numpy(zero_copy_only=False)[order]
        self.ids = column("id").fill_null(0).to_numpy()[order]
        starts = np.arange(0, len(order), TILE)
        self._tiles = [
            (np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts))
            for values in (self.labels, self.angles, self.norms)
        ]
        self.largest = float(self.norms.max())

    def bounds(self, anchor: Anchor, same: bool, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the anchor's label (or of others) whose score may be in the range, and bounds of their scores."""
        (first, last), (least_angle, most_angle), (least, most) = self._tiles
        slack = angle_slack(max(self.vectors.shape[1], len(anchor.vector)))
        bottom, top = score_bounds(anchor.angles, least_angle, most_angle, anchor.norm, least, most, slack)
        labelled = (first <= anchor.label) & (last >= anchor.label) if same else (first != anchor.label) | (last != anchor.label)
        tiles = np.flatnonzero(labelled & (top >= low) & (bottom <= high))
        rows = (tiles[:, None] * TILE + np.arange(TILE)).ravel()
        rows = rows[rows < len(self.labels)]
        rows = rows[(self.labels[rows] == anchor.label) == same]
        norms, angles = self.norms[rows], self.angles[rows]
        bottom, top = score_bounds(anchor.angles, angles, angles, anchor.norm, norms, norms, slack)
        kept = (top >= low) & (bottom <= high)
        return rows[kept], bottom[kept], top[kept]

    def scores(self, anchor: Anchor, rows: np.ndarray) -> np.ndarray:
        return inner_products(self.vectors[rows], anchor.vector, anchor.norm * self.largest)

    def best(self, rows: np.ndarray, scores: np.ndarray, count: int) -> list[tuple[int | None, int, int]]:
        """(id, mark, score) of the first rows by score, then id."""
        if len(rows) > count:
            worst = np.partition(scores, len(scores) - count)[len(scores) - count]
            rows, scores = rows[scores >= worst], scores[scores >= worst]
        order = np.lexsort((self.marks[rows], self.ids[rows], self.nameless[rows], -scores))[:count]
        ids = [None if self.nameless[row] else int(self.ids[row]) for row in rows[order]]
        return list(zip(ids, self.marks[rows[order]].tolist(), scores[order].tolist()))

    def positives(self, anchor: Anchor, count: int) -> list[tuple[int | None, int, int]]:
        """The best other rows of the anchor's label."""
        rows, bottom, top = self.bounds(anchor, True, -math.inf, math.inf)
        other = self.nameless[rows] | (self.ids[rows] != anchor.id) | (self.marks[rows] != anchor.mark)
        rows, bottom, top = rows[other], bottom[other], top[other]
        if len(rows) > count:
            wanted = top >= np.partition(bottom, len(rows) - count)[len(rows) - count]
            rows = rows[wanted]
        return self.best(rows, self.scores(anchor, rows), count)

    def negatives(self, anchor: Anchor, windows: list[tuple[int, int]], count: int) -> list[list[tuple[int | None, int, int]]]:
        """The best rows of other labels in each window of scores."""
        open_ = [window for window in windows if window[0] <= window[1]]
        if not open_:
            return [[] for _ in windows]
        rows, bottom, top = self.bounds(anchor, False, min(w[0] for w in open_), max(w[1] for w in open_))
        wanted = np.zeros(len(rows), bool)
        for low, high in open_:
            sure = bottom[(bottom >= low) & (top <= high)]
            least = np.partition(sure, len(sure) - count)[len(sure) - count] if len(sure) > count else low
            wanted |= (top >= max(least, low)) & (bottom <= high)
        rows = rows[wanted]
        scores = self.scores(anchor, rows)
        found = []
        for low, high in windows:
            inside = (scores >= low) & (scores <= high)
            found.append(self.best(rows[inside], scores[inside], count))
        return found


class Anchor:
    def __init__(self, row: dict):
        self.id, self.label, self.mark, self.norm = row["id"], row["label"], row["mark"], row["norm"]
        self.vector, self.angles = np.array(row["vector"], np.int64), np.array(row["angles"], float)


def _measured(rows: DataFrame, references: np.ndarray) -> DataFrame:
    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float64())
        for batch in batches:
            norms, found = measure(_matrix(batch.column("vector")), references)
            offsets = np.arange(0, found.size + 1, max(1, len(references)), dtype=np.int32)
            lists = pa.ListArray.from_arrays(offsets, found.ravel()) if len(references) else pa.array([[]] * len(norms), kind)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), lists], ["id", "label", "mark", "vector", "norm", "angles"]
            )

    return rows.mapInArrow(angles, _FIELDS)


def references_of(rows: DataFrame) -> np.ndarray:
    """Unit vectors far apart from one another, of a bounded sample of rows."""
    sample = rows.filter(F.exists("vector", lambda x: x != 0)).orderBy(F.xxhash64("id", "mark"), "mark").limit(SAMPLED)
    vectors = [row["vector"] for row in sample.select("vector").collect()]
    if not vectors:
        return np.empty((0, 0))
    unit = _matrix(pa.array(vectors, pa.list_(pa.int64()))).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(REFERENCES, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _search(rows: DataFrame, anchors: DataFrame, blocks: int, count: int, low: int, high: int) -> DataFrame:
    """What the blocks find: positives of anchors without ``windows``, else negatives (shares ``low`` to ``high`` percent)."""
    none = F.lit(None).cast("array<struct<place: int, id: long, score: long>>")
    held = rows.withColumns({"windows": none, "asks": F.lit(False), "block": F.floor(F.rand(0) * blocks).cast("int")})
    asking = anchors.withColumns({"asks": F.lit(True), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    dealt = held.unionByName(asking).repartition(blocks, "block").sortWithinPartitions("block", "asks")

    def ask(block: Block, row: dict) -> Iterator[tuple]:
        anchor = Anchor(row)
        if row["windows"] is None:
            for found in block.positives(anchor, count):
                yield anchor.id, anchor.mark, None, None, None, *found
            return
        scores = [one["score"] for one in row["windows"]]
        windows = [(-(-low * score // 100), high * score // 100) for score in scores]
        for one, best in zip(row["windows"], block.negatives(anchor, windows, count)):
            for found in best:
                yield anchor.id, anchor.mark, one["place"], one["id"], one["score"], *found

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32()] + [pa.int64()] * 5
        names = [field.split()[0] for field in _FOUND.split(", ")]
        number, waiting, block = None, [], None
        for batch in batches:
            blocks_, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks_) != 0) | np.diff(asks)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(blocks_)]):
                if start == stop:
                    continue
                if blocks_[start] != number:
                    number, waiting, block = blocks_[start], [], None
                part = batch.slice(start, stop - start)
                if not asks[start]:
                    waiting.append(part)
                    continue
                if waiting:
                    block, waiting = Block(waiting), []
                if block is None:
                    continue
                found = [row for asked in part.to_pylist() for row in ask(block, asked)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    return dealt.mapInArrow(search, _FOUND)


def _first(found: DataFrame, per: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*per).orderBy(F.desc("score"), F.asc_nulls_last("id"), "mark")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Per anchor and positive, the first negatives that score ``low`` to ``high`` percent of the positive.

    ``df`` has ``id``, ``label`` and ``vector`` (``array<bigint>``); ``is_anchor`` is a condition on the id. The rows are
    written to the shared folder first, and references chosen, so jobs run while this is built.
    """
    named = df.select(*(F.col(c).cast("bigint").alias(c) for c in ("id", "label")), "vector")
    distinct = named.filter("label is not null and vector is not null").distinct()
    stored = Stored(distinct.withColumn("mark", F.xxhash64("label", "vector")), "vectors").rows
    stored = stored.select("id", "label", "mark", "vector")
    blocks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // ROWS_PER_BLOCK))
    rows = _measured(stored, references_of(stored))
    anchors = rows.filter(F.col("id").isNotNull() & is_anchor)
    key = ["anchor_id", "anchor_mark"]
    none = F.lit(None).cast("array<struct<place: int, id: long, score: long>>")
    best = _first(_search(rows, anchors.withColumn("windows", none), blocks, positives, low, high), key, positives)
    each = F.struct(F.col("rank").cast("int").alias("place"), "id", "score")
    windows = best.groupBy(*key).agg(F.sort_array(F.collect_list(each)).alias("windows"))
    asked = anchors.join(windows, (anchors["id"] == windows["anchor_id"]) & (anchors["mark"] == windows["anchor_mark"]))
    found = _search(rows, asked.drop(*key), blocks, negatives, low, high)
    return _first(found, [*key, "place"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
