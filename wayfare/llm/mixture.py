"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. The documents of a source, shuffled by a seed, are laid end to end and cut into blocks of
equal size (the last may be shorter). The blocks of the mix go to the sources one by one, always to the
highest quotient target / (2 k + 1) of a source that has k blocks so far; cut at the sizes of the shards,
this order gives every shard whole numbers of blocks in the same proportions. A source whose quota exceeds
its blocks is passed through whole as often as needed; for the rest, consecutive blocks of the shuffled
order are taken from a seeded start on, so that only documents at the two ends are cut.

The blocks of a source, in the order in which they are passed through, go to the shards by its quotas, so each shard holds
whole blocks in the proportions of the mix. A document that crosses the end of a shard's blocks is cut there.

Everything on one row per source is a window over that small table; documents are placed by
``running.totals_before``, so a source may be of any size.

Defined results: documents without words take part with size 0 and are never taken; a null source is a
source, ordered last; rows that agree in id, source and size are interchangeable; an empty table has no
result. The weights repeat in the order of the source names, by code point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.running import group_key, kept, seeded_fraction, totals_before

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 64
SHARDS = 16

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, passes: int = MOST_PASSES
) -> DataFrame:
    """Add ``number`` and ``target`` to (source, source_size), one row per source.

    Targets share ``share`` times all words by weight but end at ``passes`` times the source's words. Those that end
    there are the ones with least room per weight, so one pass in that order finds them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") - 1) % len(weights) + 1)
    weighed = (
        sources.withColumn("number", F.row_number().over(by_name))
        .withColumns({"weight": weight, "most": F.col("source_size") * passes})
        .withColumn("room", F.col("most") / F.col("weight"))
    )
    tightest = Window.orderBy("room", "number")
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    after = tightest.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    level = (
        F.sum("source_size").over(everywhere) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    levelled = weighed.withColumn("level", level).withColumn("full", F.col("room") <= F.col("level"))
    # all that are not full share what the full ones leave
    common = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(
        tightest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * common)
    return levelled.withColumn("target", target).select("source", "source_size", "number", "target")


def shard_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """(number, shard, quota): blocks of each source in each shard.

    With B blocks up to the end of a shard and S sources, a source of target share p surely has the quotients below
    p (B - S/2) - 1/2 and surely lacks those above p (B + S/2) - 1/2. Only the few between, about S in all, are ranked.
    """
    everywhere = Window.partitionBy()
    wanted = (
        targets.filter(F.col("target") > 0)
        .withColumns({"sources": F.count("*").over(everywhere), "words": F.sum("target").over(everywhere)})
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("blocks", F.round(F.col("words") / block_words).cast("bigint"))
        .withColumn("house", F.expr(f"blocks * (shard + 1) div {shards}"))
        .withColumn("part", F.col("target") / F.col("words"))
    )
    half = F.col("sources") / 2
    low = F.greatest(F.lit(0), F.floor(F.col("part") * (F.col("house") - half) - 0.5) - 1)
    high = F.ceil(F.col("part") * (F.col("house") + half) - 0.5) + 1
    bounded = wanted.withColumn("low", low).withColumn("high", F.greatest(high, F.col("low")))
    open_seats = F.col("house") - F.sum("low").over(Window.partitionBy("shard"))
    best = Window.partitionBy("shard").orderBy("quotient", "number")
    seats = (
        bounded.withColumn("open", open_seats)
        .withColumn("k", F.explode(F.sequence("low", "high")))
        .withColumn("quotient", (2 * F.col("k") + 1) / F.col("target"))
        .withColumn("seat", F.row_number().over(best))
        .groupBy("number", "shard", "low")
        .agg(F.count(F.when(F.col("seat") <= F.col("open"), True)).alias("won"))
        .withColumn("seats", F.col("low") + F.col("won"))
    )
    earlier = F.lag("seats", 1, 0).over(Window.partitionBy("number").orderBy("shard"))
    return seats.select("number", "shard", (F.col("seats") - earlier).alias("quota"))


def taken_words(
    sizes: DataFrame,
    seed: int,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    passes: int = MOST_PASSES,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
) -> DataFrame:
    """(doc_id, source, size) with ``source_size``, ``target`` and what the mix takes of each document.

    ``copies`` whole copies are taken, and words ``from_word`` (first is 0) to before ``to_word`` once more, then again
    ``wrap_words`` words from the start, if the run of blocks ends where it began; ``taken`` is the sum. ``shards`` has the
    same words as an array of (shard, first, last), ``last`` not included.
    """
    drawn = kept(
        sizes.select("doc_id", "source", "size").withColumns(
            {"_source": group_key(F.col("source")), "_draw": seeded_fraction(seed, F.col("doc_id"))}
        )
    )
    sources = drawn.groupBy("source", "_source").agg(F.sum("size").alias("source_size"))
    targets = kept(source_targets(sources.select("source", "source_size"), weights, share, passes))
    # what all shards up to each one get
    ends = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(
            F.filter("quotas", lambda q: q["shard"] <= s), F.lit(0).cast("bigint"), lambda total, q: total + q["quota"]
        ),
    )
    quotas = (
        shard_quotas(targets, block_words, shards)
        .groupBy("number")
        .agg(F.sum("quota").alias("quota"), F.collect_list(F.struct("shard", "quota")).alias("quotas"))
        .withColumn("_ends", ends)
    )
    blocks = F.ceil(F.col("source_size") / block_words)
    plan = kept(
        targets.join(quotas, "number", "left")
        .withColumns({"_source": group_key(F.col("source")), "_blocks": blocks})
        .withColumn("_quota", F.least(F.coalesce("quota", F.lit(0)), F.col("_blocks") * passes))
        .withColumn("_passes", F.coalesce(F.expr("_quota div nullif(_blocks, 0)"), F.lit(0)))
        .withColumn("_rest", F.col("_quota") - F.col("_passes") * F.col("_blocks"))
        .withColumn("_first", F.floor(seeded_fraction(seed, F.col("source")) * F.col("_blocks")))
        # the run of blocks as words: from _begin up to _end, and if it wraps, up to _wrap from the front
        .withColumn("_begin", F.col("_first") * block_words)
        .withColumn("_end", F.least((F.col("_first") + F.col("_rest")) * block_words, F.col("source_size")))
        .withColumn("_wrap", F.greatest(F.lit(0), F.col("_first") + F.col("_rest") - F.col("_blocks")) * block_words)
        .withColumn("_ends", F.transform("_ends", lambda end: F.least(end, F.col("_quota"))))
        .select("_source", "source_size", "target", "_passes", "_begin", "_end", "_wrap", "_blocks", "_first", "_ends")
    )
    placed = totals_before(drawn, "_source", "_draw", ["doc_id", "size"], F.col("size"), "_start", "_sum").drop("_sum")
    inside = {
        "from_word": F.greatest(F.lit(0), F.col("_begin") - F.col("_start")),
        "to_word": F.least(F.col("size"), F.col("_end") - F.col("_start")),
        "wrap_words": F.least(F.col("size"), F.greatest(F.lit(0), F.col("_wrap") - F.col("_start"))),
    }
    return (
        placed.join(plan, "_source")
        .withColumns(inside)
        .withColumn("to_word", F.greatest("from_word", "to_word"))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("_passes")).otherwise(0))
        .withColumn(
            "taken",
            F.col("copies") * F.col("size") + F.col("to_word") - F.col("from_word") + F.col("wrap_words"),
        )
        .withColumn("shards", _shard_parts(passes, block_words))
        .select(
            "doc_id", "source", "size", "source_size", "target", "taken", "copies", "from_word", "to_word", "wrap_words", "shards"
        )
    )


def _shard_parts(passes: int, block_words: int) -> Column:
    """The words of a document that are taken, cut where shards end.

    Blocks are numbered as the source gives them: those of whole passes, then the run from ``_first`` on, then its wrap.
    """

    def run(first: Column, last: Column, block: Column) -> Column:
        """Words ``first`` to before ``last`` of the document, with the number of the block with the source's first word."""
        return F.struct(first.cast("bigint").alias("a"), last.cast("bigint").alias("b"), block.cast("bigint").alias("block"))

    whole = [
        F.when(F.col("copies") > p, run(F.lit(0), F.col("size"), p * F.col("_blocks"))) for p in range(passes)
    ]
    behind = F.col("_passes") * F.col("_blocks") - F.col("_first")
    rest = [
        run(F.col("from_word"), F.col("to_word"), behind),
        run(F.lit(0), F.col("wrap_words"), behind + F.col("_blocks")),
    ]

    def cut(r: Column) -> Column:
        at = lambda end: (end - r["block"]) * block_words - F.col("_start")
        return F.transform(
            "_ends",
            lambda end, s: F.struct(
                s.alias("shard"),
                F.greatest(r["a"], at(F.when(s == 0, 0).otherwise(F.get("_ends", s - 1)))).alias("first"),
                F.least(r["b"], at(end)).alias("last"),
            ),
        )

    runs = F.filter(F.array(*whole, *rest), lambda r: r["b"] > r["a"])
    return F.filter(F.flatten(F.transform(runs, cut)), lambda part: part["last"] > part["first"])


def mixed_rows(
    df: DataFrame,
    seed: int,
    text_col: str = "text",
    source_col: str = "source",
    id_col: str = "doc_id",
    shard_col: str | None = None,
) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, cut to the words taken where it is taken in part.

    Documents that are taken whole keep their text; in a cut one, words are joined by one space. Columns of any name come
    along. ``shard_col`` names a column for the shard, at whose end documents are then cut; it must be a new one.
    """
    if shard_col in df.columns:
        raise ValueError(f"there is a column {shard_col} already")
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    keyed = df.select(F.struct("*").alias("row"), key.alias("key"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    sizes = keyed.select(F.col("key").alias("doc_id"), "source", count_words(F.col("text")).alias("size"))
    taken = taken_words(sizes, seed).withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "source").orderBy("from_word", "to_word", "wrap_words")))
    keyed = keyed.drop("text").withColumn("nth", F.row_number().over(Window.partitionBy("key", "source").orderBy(F.lit(0))))
    part = lambda first, last: F.struct(first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))
    parts = F.col("shards") if shard_col else F.concat(
        F.array_repeat(part(F.lit(0), F.col("size")), F.col("copies").cast("int")),
        F.filter(
            F.array(part(F.col("from_word"), F.col("to_word")), part(F.lit(0), F.col("wrap_words"))),
            lambda p: p["last"] > p["first"],
        ),
    )
    taken = taken.select(
        F.col("doc_id").alias("taken_key"), F.col("source").alias("taken_source"), F.col("nth").alias("taken_nth"), "size",
        parts.alias("parts"),
    )
    same = (
        (keyed["key"] == taken["taken_key"])
        & (keyed["nth"] == taken["taken_nth"])
        & keyed["source"].eqNullSafe(taken["taken_source"])
    )
    rows = keyed.join(taken, same).select("row", "size", F.explode("parts").alias("part"))
    first, count = F.col("part.first").cast("int"), (F.col("part.last") - F.col("part.first")).cast("int")
    whole = F.col("row")[text_col]
    words = F.slice(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), first + 1, count)
    text = F.when(count == F.col("size"), whole).otherwise(F.array_join(words, " "))
    return rows.select(
        *((text if c == text_col else F.col("row")[c]).alias(c) for c in df.columns),
        *([F.col("part.shard").alias(shard_col)] if shard_col else []),
    )


def count_words(text):
    """Words of a text column; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
