"""Exact substring dedup: words in passages of ``window`` words or more that occur elsewhere.

Where a window could occur again is found by anchors. The anchor of a window is the least hash among its runs of
``ANCHOR`` words, so equal windows have equal anchors. Neighbouring windows with one anchor form a segment, which is
the unit that is counted and moved:

1. Segments of anchors that occur once are left out. The others are counted by content, and one copy of each content
   goes, with its count, to the shard of its anchor.
2. The shard builds an FM-index over its contents, weighted by their counts. Backward search first asks for whole
   contents; where one is not repeated as a whole, it asks, for each place, how many words up to it occur twice, and
   intervals of at least a window are reported.
3. An anchor with very many different segments (the edge of a passage that very many documents share) would make a
   shard too large. Its segments are cut to single windows, which need no neighbours, so they can be dealt to all
   shards; they are counted, indexed and searched as in 1 and 2.
4. The intervals of a content hold for each of its occurrences.

Every window is judged on the input. Shards hold each distinct content once, so copies cost nothing there; counts
combine before they are shuffled. The joins by anchor and content have one row for each on one side, and that side is
a stored table, so adaptive execution can cut a hot anchor or content on the other side.

Defined results: a null text has no words; texts shorter than a window lose nothing, however long or short; repeated rows
are repeated text and lose all their windows; rows without an id take part like others; an empty table has no result;
other columns, of any name, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.fmindex import FMIndex
from wayfare.llm.packing import packed, unpacker
from wayfare.llm.running import Stored
from wayfare.llm.words import WordCodes, mixed, window_codes

WINDOW = 35
ANCHOR = 8

#: words in the index of a shard, about
SHARD_WORDS = 1_000_000

#: the segments of anchors with more different ones are cut to windows, to be dealt to all shards
HOT_SEGMENTS = 5_000


def segments(codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content code, first window and number of windows of each segment of a text."""
    count = len(codes) - window + 1
    if count <= 0:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    size = min(ANCHOR, window)
    runs = window_codes(codes, size)
    spread = np.lib.stride_tricks.sliding_window_view(runs, window - size + 1)
    place = np.arange(count) + spread.argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    number = np.diff(np.append(first, count))
    whole = window_codes(codes, window)
    # a segment is shorter than two windows, so its first and last window tell all of it
    content = mixed(mixed(whole[first]) + whole[first + number - 1] + number.astype(np.uint64))
    return runs[place[first]], content, first, number


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("text"))


def _occurrences(keyed: DataFrame, window: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                found.append(segments(codes.of(text.split()), window))
            row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            parts = [np.concatenate([f[k] for f in found]) if found else np.empty(0) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row)),
                    batch.column("mark").take(pa.array(row)),
                    pa.array(parts[0].astype(np.uint64).view(np.int64)),
                    pa.array(parts[1].astype(np.uint64).view(np.int64)),
                    pa.array(parts[2].astype(np.int32)),
                    pa.array(parts[3].astype(np.int32)),
                ],
                ["id", "mark", "anchor", "content", "first", "windows"],
            )

    kind = keyed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, mark long, anchor long, content long, first int, windows int"
    return keyed.select("id", "mark", "text").mapInArrow(cut, schema)


def _moved(keyed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The words of the wanted contents; those of hot anchors as rows of one window, ``at`` windows from their start.

    ``whole`` is the code of such a window, and null for contents that stay in one piece.
    """
    lists = wanted.groupBy("id", "mark").agg(
        F.collect_list(F.struct("anchor", "content", "first", "windows", "n", "hot")).alias("runs")
    )
    same = keyed["id"].eqNullSafe(lists["id"]) & (keyed["mark"] == lists["mark"])
    texts = keyed.withColumn("text", packed(F.col("text"))).join(lists, same).select(keyed["id"], keyed["mark"], "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, unpack, last = WordCodes(), unpacker(), None
        for batch in batches:
            rows: list[tuple] = []
            for id_, mark, text, runs in zip(*(batch.column(name).to_pylist() for name in ("id", "mark", "text", "runs"))):
                if (id_, mark) == last:
                    continue  # a repeated row: its contents are counted already
                last = id_, mark
                words, whole = codes.of(unpack(text).split()).astype("<u8"), None
                for run in runs:
                    first, count = run["first"], run["windows"]
                    key = run["anchor"], run["content"], run["n"]
                    if run["hot"]:
                        whole = window_codes(words, window).view(np.int64) if whole is None else whole
                        rows += [
                            (*key, at, int(whole[first + at]), words[first + at : first + at + window].tobytes())
                            for at in range(count)
                        ]
                    else:
                        rows.append((*key, 0, None, words[first : first + count + window - 1].tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "content", "n", "at", "whole", "words"]
            )

    return texts.mapInArrow(cut, "anchor long, content long, n long, at int, whole long, words binary")


def reported(index: FMIndex, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, from, to): the intervals of at least a window of each indexed text that occur twice by their weights."""
    start = index.closing - lengths
    # whole texts first: that settles copies by one search each
    whole = index.repeated_before(index.closing - 1, lengths) == lengths
    asked = np.flatnonzero(~whole)
    # of the others, each place that ends a window
    counts = lengths[asked] - window + 1
    which = np.repeat(asked, counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    long = index.repeated_before(start[which] + offset + window - 1, window) >= window
    which, offset = which[long], offset[long]
    opens = np.ones(len(which), bool)
    opens[1:] = (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1)
    begin = np.flatnonzero(opens)
    end = np.flatnonzero(np.append(opens[1:], True)[: len(which)])
    whole = np.flatnonzero(whole)
    return (
        np.concatenate([whole, which[begin]]),
        np.concatenate([np.zeros(len(whole), np.int64), offset[begin]]),
        np.concatenate([lengths[whole], offset[end] + window]),
    )


def _searched(dealt: DataFrame, window: int) -> DataFrame:
    """(anchor, content, from, to): intervals the indexes of the shards report; ``dealt`` has ``shard, n, words`` too."""

    def search(shard: pa.Table) -> pa.Table:
        texts = [np.frombuffer(words, "<u8") for words in shard.column("words").to_pylist()]
        lengths = np.array([len(text) for text in texts], np.int64)
        index = FMIndex(texts, int(lengths.max()), shard.column("n").to_numpy())
        text, first, last = reported(index, lengths, window)
        rows = pa.array(text)
        return pa.table(
            {
                "anchor": shard.column("anchor").take(rows),
                "content": shard.column("content").take(rows),
                "from": pa.array(first.astype(np.int32)),
                "to": pa.array(last.astype(np.int32)),
            }
        )

    return dealt.groupBy("shard").applyInArrow(search, "anchor long, content long, from int, to int")


def repeated_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    hot_segments: int = HOT_SEGMENTS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(id, mark, from, to): word intervals [from, to) covered by repeated windows; they may overlap.

    ``mark`` is a hash of the text, which tells rows of one id apart.
    """
    keyed = _keyed(df, id_col, text_col)
    every = Stored(_occurrences(keyed, window), "segments")
    again = Stored(every.rows.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "segments")
    occurrences = Stored(every.rows.join(again.rows, "anchor", "left_semi"), "segments")
    every.drop()
    again.drop()

    contents = occurrences.rows.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "mark", "first", "windows")).alias("one")
    )
    sizes = Stored(contents, "segments")
    many = sizes.rows.groupBy("anchor").agg(F.count("*").alias("kinds")).filter(F.col("kinds") > hot_segments)
    hot = Stored(many.select("anchor", F.lit(True).alias("hot")), "segments")
    wanted = sizes.rows.join(hot.rows, "anchor", "left").select(
        "anchor", "content", "n", F.coalesce("hot", F.lit(False)).alias("hot"), "one.*"
    )
    moved = Stored(_moved(keyed, wanted, window), "segments")
    sizes.drop()
    hot.drop()

    words = moved.rows.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(4 * partitions, -(-words // (8 * shard_words)))
    pieces = moved.rows.filter("whole is null").select("anchor", "content", "n", "words")
    windows = moved.rows.filter("whole is not null")
    counted = windows.groupBy("whole").agg(F.sum("n").alias("n"), F.min("words").alias("words"))
    counted = counted.select(F.lit(None).cast("long").alias("anchor"), F.col("whole").alias("content"), "n", "words")
    # a window of a hot anchor goes by its own code, all else by the anchor
    shard = F.pmod(F.coalesce("anchor", "content"), F.lit(shards)).alias("shard")
    found = Stored(_searched(pieces.unionByName(counted).select("*", shard), window), "passages")

    own = found.rows.filter("anchor is not null")
    twice = found.rows.filter("anchor is null").select(F.col("content").alias("whole"))
    # neighbouring windows of a content make one interval
    nth = F.row_number().over(Window.partitionBy("anchor", "content").orderBy("at"))
    runs = (
        windows.select("anchor", "content", "at", "whole")
        .distinct()
        .join(twice, "whole")
        .withColumn("run", F.col("at") - nth)
        .groupBy("anchor", "content", "run")
        .agg(F.min("at").alias("from"), (F.max("at") + window).alias("to"))
        .drop("run")
    )
    intervals = Stored(own.unionByName(runs), "passages")
    places = occurrences.rows.select("id", "mark", "anchor", "content", "first").join(intervals.rows, ["anchor", "content"])
    passages = Stored(
        places.select("id", "mark", (F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to")).alias("to")),
        "passages",
    )
    for table in (occurrences, moved, found, intervals):
        table.drop()
    return passages.rows


def without_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **settings: int
) -> DataFrame:
    """(id, ``n_words``, ``n_removed``, ``kept_text``): the words that stay, joined by one space, for each row."""
    return _cleaned(df, id_col, text_col, window, "kept_text string", lambda words: b" ".join(words), pa.string(), settings)


def kept_digests(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **settings: int
) -> DataFrame:
    """As ``without_repeats``, with the digest ``kept_sha256`` of the text in its place."""
    digest = lambda words: hashlib.sha256(b" ".join(words)).hexdigest()
    return _cleaned(df, id_col, text_col, window, "kept_sha256 string", digest, pa.string(), settings)


def _cleaned(df, id_col, text_col, window, column, make, kind, settings) -> DataFrame:
    keyed = _keyed(df, id_col, text_col)
    found = repeated_passages(df, id_col, text_col, window, **settings)
    lists = found.groupBy("id", "mark").agg(F.collect_set(F.struct("from", "to")).alias("runs"))
    same = keyed["id"].eqNullSafe(lists["id"]) & (keyed["mark"] == lists["mark"])
    joined = keyed.withColumn("text", packed(F.col("text"))).join(lists, same, "left").select(keyed["id"], "text", "runs")
    name = column.split()[0]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            rows = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                words = unpack(text).split()
                if runs:
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, [run["from"] for run in runs], 1)
                    np.add.at(step, [run["to"] for run in runs], -1)
                    stays = np.cumsum(step[:-1]) == 0
                    left = list(compress(words, stays.tolist()))
                else:
                    left = words
                made = make(left)
                rows.append((len(words), len(words) - len(left), made.decode() if isinstance(made, bytes) else made))
            columns = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind)],
                ["id", "n_words", "n_removed", name],
            )

    id_kind = keyed.schema["id"].dataType.simpleString()
    result = joined.mapInArrow(clean, f"id {id_kind}, n_words long, n_removed long, {column}")
    return result.withColumnRenamed("id", id_col)
