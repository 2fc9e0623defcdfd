import random
from collections import Counter

import pytest

from wayfare.llm import mixture

SHARDS, BLOCK = 4, 8


def corpus():
    """Sources of very different sizes, one null, one of one row, one without words; ties, repeated rows, a long text."""
    draw = random.Random(7)
    rows = [(i, "abc"[min(i % 7, 2)], f"w{i} " * draw.randint(0, 40)) for i in range(150)]
    rows += [(200, None, "n " * 90), (201, None, None), (None, "a", "x y z"), (None, "a", "x y z"), (3, "a", "x y z")]
    rows += [(300, "one", "o " * 33), (301, "empty", " \n"), (302, "empty", None), (303, "b", "long " * 5000), (303, "b", "long " * 5000)]
    return rows


@pytest.fixture(scope="module")
def taken(spark):
    sizes = [(key, source, len((text or "").split())) for key, source, text in corpus()]
    frame = spark.createDataFrame(sizes, "doc_id long, source string, size long")
    return mixture.taken_words(frame, 5, block_words=BLOCK, shards=SHARDS).collect()


def highest_quotients(targets, blocks):
    """(source, number of its blocks so far) in the order in which they are given."""
    given, order = Counter(), []
    for _ in range(blocks):
        name = min(targets, key=lambda s: ((2 * given[s] + 1) / targets[s], s is None, s or ""))
        given[name] += 1
        order.append(name)
    return order


def test_shards_get_the_quotas_of_highest_quotients(taken):
    targets = {row["source"]: row["target"] for row in taken if row["target"] > 0}
    sizes = {row["source"]: row["source_size"] for row in taken}
    blocks = round(sum(targets.values()) / BLOCK)
    order = highest_quotients(targets, blocks)
    got = Counter()
    for row in taken:
        for part in row["shards"]:
            got[row["source"], part["shard"]] += part["last"] - part["first"]
    for source in targets:
        most = 2 * -(-sizes[source] // BLOCK)
        before = 0
        for shard in range(SHARDS):
            after = min(most, order[: blocks * (shard + 1) // SHARDS].count(source))
            # the last block of a source may be short; it is taken up to three times
            short = 3 * BLOCK if (source, shard) in got else BLOCK
            assert BLOCK * (after - before) - short < got[source, shard] <= BLOCK * (after - before)
            before = after


def test_parts_are_what_is_taken(taken):
    for row in taken:
        assert sum(p["last"] - p["first"] for p in row["shards"]) == row["taken"] <= 2 * row["size"]
        assert all(0 <= p["first"] < p["last"] <= row["size"] and 0 <= p["shard"] < SHARDS for p in row["shards"])
        words = Counter(w for p in row["shards"] for w in range(p["first"], p["last"]))
        want = Counter({w: row["copies"] for w in range(row["size"])})
        want.update(range(row["from_word"], row["to_word"]))
        want.update(range(row["wrap_words"]))
        assert +want == words
    assert {row["source"] for row in taken} == {"a", "b", "c", None, "one", "empty"} and len(taken) == len(corpus())


def test_rows_of_the_mix_by_shard(spark):
    frame = spark.createDataFrame(corpus(), "doc_id long, source string, text string")
    mixed = mixture.mixed_rows(frame, 5, shard_col="part").collect()
    plain = mixture.mixed_rows(frame, 5).collect()
    words = lambda rows: Counter((r["doc_id"], r["source"], w) for r in rows for w in (r["text"] or "").split())
    assert words(mixed) == words(plain) and mixed[0].asDict().keys() == {"doc_id", "source", "text", "part"}
    assert {row["part"] for row in mixed} == set(range(mixture.SHARDS))
    with pytest.raises(ValueError):
        mixture.mixed_rows(frame, 5, shard_col="text")


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixture.mixed_rows(frame, 5, shard_col="part").collect() == []
