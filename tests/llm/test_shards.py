import collections
import zlib

from wayfare.llm import queries, shards

FOLDER = "/root/testdata/sf0.001"


def check(rows, n, count):
    """Rows at most one apart, slots without gaps, each source at most one row off its share."""
    sizes = collections.Counter(r["shard"] for r in rows)
    counts = [sizes[k] for k in range(count)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    for k in range(count):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sizes[k]))


def test_every_shard_has_the_mixture(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    got = shards.interleave(spark.createDataFrame(rows, "doc_id long, source string"), 8, 1).collect()
    check(got, 600, 8)
    total = collections.Counter(source for _, source in rows)
    held = collections.Counter((r["shard"], r["source"]) for r in got)
    assert all(abs(held[k, s] - n / 8) < 2 for s, n in total.items() for k in range(8))
    again = shards.interleave(spark.createDataFrame(rows[::-1], "doc_id long, source string").repartition(7), 8, 1).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_nulls_repeated_rows_few_rows_and_empty_table(spark):
    schema = "doc_id long, source string, size string, shards int"
    rows = [(1, None, "x", 1), (1, None, "x", 1), (None, "a", None, 2), (None, None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    got = shards.interleave(frame, 3, 1)
    assert got.columns == [*frame.columns, "shard", "slot"]
    check(got.collect(), 4, 3)
    assert shards.interleave(frame.limit(0), 3, 1).collect() == []


def test_query(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.QUERIES["op2_shards"](spark, FOLDER).collect()
    check(got, len(texts), 40)
    for r in got:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), "rows", None)
