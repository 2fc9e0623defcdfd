import collections
import itertools
import re

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from wayfare.llm import audit, oracles, queries

DOCS, LABELS = "doc_id long, text string, lang string, n int, bits string, salt int", "doc_id long, quality int, toxic int, part int"


def brute(rows, labels):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {i for i, quality, _, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, bad, _ in labels if i is not None and bad == 1}
    found = collections.defaultdict(list)
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and doc_id > first[text],
        }
        found[lang or ""].append(({name for name, bad in fails.items() if bad}, doc_id in good, doc_id in toxic))
    want = {}
    for part, docs in found.items():
        total = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, name in enumerate(order, 1):
                removed = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                total[name] += len(removed)
                want[part, order, step] = [
                    len(left), len(removed), sum(name in d[0] for d in docs) - len(removed),
                    sum(d[0] == {name} for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed),
                ]
        for (p, order, step), values in want.items():
            if p == part:
                values.append(total[order[step - 1]])
    return want


@pytest.fixture(scope="module")
def rows():
    long = " ".join(f"w{i}" for i in range(250))
    texts = [long, long + " #", "Short Text", "a b " * 120, long.upper(), "", None, "ß " + long, long + "\x0b\x1f" * 3, "x" * 400_000]
    rows = [(i, texts[i % len(texts)], ["en", "de", None, ""][i % 4], i, "b", 1) for i in range(60)]
    # a hot text, repeated rows, rows without an id, equal ids with other texts
    rows += [(1000 + i, "copy me " * 10, "en", 0, None, None) for i in range(120)]
    rows += [(1000, "copy me " * 10, "en", 0, None, None)] * 2 + [(None, "copy me " * 10, "en", 0, None, None)] * 3
    return rows + [(None, None, None, None, None, None), (7, "other", "en", 0, "", 0), (7, "other", "fr", 0, "", 0)]


def test_against_brute_force_and_sql(spark, rows):
    labels = [(i, i % 2, i % 3 % 2, 0) for i in range(0, 1100, 3)] + [(3, 0, 1, 0), (6, None, None, None), (None, 1, 1, 1)]
    docs, known = spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)
    got = audit.audit(docs, known)
    want = brute(rows, labels)
    result = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got.collect()}
    assert result == want and len(want) == 600 * 4
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", known.toArrow())
    assert compare.differences(got, con, oracles.ORACLES["op13_audit"]) == []


def test_hot_texts_are_dealt_over_tasks(spark, monkeypatch):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    docs = rows.select("id", "text", F.lit("en").alias("lang"))
    monkeypatch.setattr(audit, "HOT_SHARES", 20)
    marked = audit.copies(audit._texts(docs, "id", "text", "lang"))
    assert marked.count() == 999 and {r[0] % 3 for r in marked.select("doc_id").collect()} == {0}


def test_empty_tables(spark, rows):
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit(docs.limit(0), known).collect() == []
    got = audit.audit(docs, known).collect()
    assert len(got) == 2400 and not any(r["good_lost"] or r["toxic_lost"] for r in got)
    with pytest.raises(ValueError):
        audit.failures(docs, {"E": F.lit(True)})


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    frame = queries.QUERIES["op13_audit"](spark, folder)
    assert compare.differences(frame, compare.connect(folder), oracles.ORACLES["op13_audit"]) == []
