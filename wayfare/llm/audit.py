"""How filters interact: what each removes in every order, and what others would have removed as well.

A filter is a failure condition over the text. Those that look at one text are bits of a projection. The filter of exact
copies looks at the table: a row fails it if an equal text has a smaller id, whether or not that text is removed. It is
an existential self-join: a left-semi join on a hash of the text, the text itself and the smaller id. Its other side is
combined to one row, the smallest id, for each text that occurs again, so a group of copies meets one partner however
large it is. Texts
that hold over ``1 / HOT_SHARES`` of all rows are dealt over salts; there are fewer than ``HOT_SHARES`` of them, which
bounds the table of salts that is broadcast.

The ids that fail the copy filter are united with the ids and bits of the other filters, one row per id and text gets
all its bits, and rows are counted by part, bits and labels. All orders follow from those few counts: what a filter
removes depends on the set of filters before it only.

Defined results: a null text is empty, a null part is the empty string; a row without an id counts in its part, is no
copy and makes none, and has no labels; rows that agree in id, part and text are counted each but are not copies of one
another; of several labels for an id, one that is 1 is enough; an id without labels is neither good nor toxic; texts of
any length are read whole; an empty table has no parts and no rows. Only the named columns are read, so others may have
any name.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: a text with over this share (one in so many) of all rows is dealt over several tasks
HOT_SHARES = 1_000

#: a word, as the text filters count them
WORD = r"[^\x20\x09-\x0D]+"

#: ids are united under these columns, which rows of one table share only if they are interchangeable
_ROW = ["doc_id", "part", "key", "size"]
_LOST = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions: short, repetitive, loud, and full of marks."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _texts(df: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.xxhash64(text).alias("key"),
        F.octet_length(text).alias("size"),
    )


def copies(texts: DataFrame) -> DataFrame:
    """The rows (without their text) for which an equal text has a smaller id."""
    named = texts.filter("doc_id is not null")
    counts = named.groupBy("key").agg(F.count("*").alias("n"))
    all_rows = counts.agg(F.sum("n")).scalar()
    hot = counts.filter(F.col("n") * HOT_SHARES > all_rows).select(
        F.col("key").alias("hot_key"), F.ceil(F.col("n") * HOT_SHARES / all_rows).cast("int").alias("salts")
    )
    salts = F.coalesce("salts", F.lit(1))

    def with_salts(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), df["key"] == F.col("hot_key"), "left")

    rows = with_salts(named).withColumn("salt", F.floor(F.rand(0) * salts).cast("int"))
    first = named.groupBy("key", "text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = with_salts(first).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    same = [rows[c] == firsts[c] for c in ("key", "salt", "text")]
    return rows.join(firsts, [*same, firsts["first"] < rows["doc_id"]], "left_semi").select(*_ROW)


def failures(
    df: DataFrame,
    filters: Mapping[str, Column],
    copy_filter: str = "E",
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(doc_id, part, key, size, bits, n): which filters the rows fail, a bit for each in the order given, copies last.

    ``filters`` are conditions on a column ``text`` that is never null.
    """
    if copy_filter in filters:
        raise ValueError("the filter of copies has a name of its own")
    texts = _texts(df, id_col, text_col, part_col)
    bits = F.lit(0)
    for place, fails in enumerate(filters.values()):
        bits = bits + F.when(fails, 1 << place).otherwise(0)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    single = texts.select(*_ROW, bits.alias("bits"), one.alias("n"))
    repeated = copies(texts).select(*_ROW, F.lit(1 << len(filters)).alias("bits"), none.alias("n"))
    united = single.union(repeated)
    return united.groupBy(*_ROW).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, good, toxic, n): rows counted by the filters they fail and their labels."""
    is_one = lambda name: F.coalesce(F.max(F.col(name) == 1), F.lit(False))
    known = (
        labels.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    )
    labelled = failed.filter("doc_id is not null").join(known, "doc_id", "left")
    nameless = failed.filter("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    rows = labelled.unionByName(nameless).select(
        "part", "bits", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")), "n"
    )
    return rows.groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def _places(names: str) -> dict[tuple[str, int], list[str]]:
    """Each filter and bits of others: the orders in which just those stand before it."""
    orders: dict[tuple[str, int], list[str]] = {}
    for order in map("".join, permutations(names)):
        before = 0
        for name in order:
            orders.setdefault((name, before), []).append(order)
            before |= 1 << names.index(name)
    return orders


def in_all_orders(counts: DataFrame, names: str) -> DataFrame:
    """What every step of every order keeps and removes, from the counts of :func:`combinations`.

    ``names`` has one letter per bit, lowest first. A part has at most 2 to the power of their number times 4 counts,
    and as many rows in the result as there are orders times steps.
    """
    places = _places(names)
    found = [
        {"name": name, "bit": 1 << names.index(name), "before": before, "step": before.bit_count() + 1}
        for name, before in places
    ]
    place = F.from_json(F.lit(json.dumps(found)), "array<struct<name: string, bit: int, before: int, step: int>>")
    met = counts.withColumn("at", F.explode(place)).select("part", "bits", "good", "toxic", "n", "at.*")
    fails, gone = (F.col("bits").bitwiseAND(F.col(c)) != 0 for c in ("bit", "before"))
    lost = fails & ~gone

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    sums = met.groupBy("part", "name", "bit", "before", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(lost).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("bit")).alias("unique_fails"),
        total(lost & F.col("good")).alias("good_lost"),
        total(lost & F.col("toxic")).alias("toxic_lost"),
    )
    # a set of s filters stands before this one in s! (k - 1 - s)! orders
    weights = [factorial(s) * factorial(len(names) - 1 - s) for s in range(len(names))]
    weight = F.get(F.array(*map(F.lit, weights)), F.col("step") - 1)
    shapley = F.sum(F.col("removed") * weight).over(Window.partitionBy("part", "name"))
    by_place = {f"{name}{before}": orders for (name, before), orders in places.items()}
    orders = F.from_json(F.lit(json.dumps(by_place)), "map<string, array<string>>")
    at = F.concat("name", F.col("before").cast("string"))
    return sums.withColumn("shapley", shapley).select(
        "part",
        F.explode(F.element_at(orders, at)).alias("filter_order"),
        "step",
        *(F.col(c).cast("bigint") for c in (*_LOST, "shapley")),
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, counts): the five filters A to E, E being that of copies, in all 120 orders."""
    filters = text_filters(F.col("text"))
    names = "".join([*filters, "E"])
    return in_all_orders(combinations(failures(documents, filters, "E"), labels), names)
