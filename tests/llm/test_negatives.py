import math
import random

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import negatives, oracles, queries

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, asks int, block string"


def brute(rows, positives=5, best=10, low=30, high=90):
    """Rows as the contract says, one anchor after another; a shorter vector ends in zeros."""
    kept = set()
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.add((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda found: (-found[0], found[1] is None, found[1] or 0)
    result = []
    for anchor in sorted((row for row in kept if row[0] is not None and row[0] % 100 == 0), key=str):
        scored = [(product(anchor[2], row[2]), row[0], row[1]) for row in kept if row != anchor]
        for positive, positive_id, _ in sorted((s for s in scored if s[2] == anchor[1]), key=order)[:positives]:
            inside = [s for s in scored if s[2] != anchor[1] and low * positive <= 100 * s[0] <= high * positive]
            for rank, (score, found, _) in enumerate(sorted(inside, key=order)[:best], 1):
                result.append((anchor[0], positive_id, rank, found, positive, score))
    return sorted(result, key=str)


def mined(frame):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = frame.select(F.col("vec_id").alias("id"), label.alias("label"), negatives.quantised(F.col("embedding")).alias("vector"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def found(frame):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(row[n] for n in names) for row in mined(frame).collect()), key=str)


def vectors(draw, count, width, labels=4):
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(3)]
    rows = []
    for i in range(count):
        centre, spread = draw.choice(centres), draw.choice([0.05, 0.5, 2])
        vector = [c + draw.gauss(0, spread) for c in centre]
        rows.append((i, vector, draw.randrange(labels), "x", 0, "b"))
    return rows


@pytest.mark.parametrize("width", [1, 3, 40])
def test_against_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 4)
    rows = vectors(random.Random(width), 900, width)
    want = brute(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == want and want


def test_ties_repeats_nulls_hot_vectors_and_odd_components(spark):
    draw = random.Random(9)
    rows = vectors(draw, 300, 6, 2)
    same = rows[0][1]
    rows += [(1000 + i, same, i % 3, None, None, None) for i in range(200)]  # one vector holds two fifths
    rows += rows[:50]  # repeated rows
    rows += [(100, [1.0] * 6, 1, "", 0, ""), (100, [2.0] * 6, 0, "", 0, "")]  # anchors that share an id
    rows += [(None, same, 0, None, 0, None), (None, same, 1, None, 0, None), (200, None, 1, "", 0, ""), (201, same, None, "", 0, "")]
    rows += [(202, [1.0, None], 1, "", 0, ""), (203, [float("nan")], 1, "", 0, ""), (204, [float("inf")], 0, "", 0, "")]
    rows += [(205, [], 0, "", 0, ""), (206, [0.0] * 6, 1, "", 0, ""), (207, [1.0, -1.0], 0, "", 0, ""), (208, [3.0] * 9, 1, "", 0, "")]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_scores_beyond_a_long_are_the_nearest_long():
    rows = np.array([[2**62, 2**62], [-(2**62), -(2**62)], [1, 0]], np.int64)
    got = negatives.inner_products(rows, np.array([4, 4], np.int64), 2.0**66)
    assert got.tolist() == [2**63 - 1, -(2**63 - 1), 4]


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0], 1, "", 0, "")], SCHEMA)
    assert found(frame) == [] and found(frame.limit(0)) == []
    zeros = spark.createDataFrame([(i, [0.0], i % 2, "", 0, "") for i in range(6)], SCHEMA)
    rows = [tuple(row) for row in zeros.collect()]
    assert found(zeros) == brute(rows)


def test_bounds_hold_for_random_vectors():
    draw = np.random.default_rng(3)
    for width in (1, 2, 5, 64):
        rows = draw.integers(-300, 300, (200, width))
        rows[0] = 0
        rows[1] = rows[2] * -1
        references = draw.normal(size=(4, width))
        references /= np.linalg.norm(references, axis=1)[:, None]
        norms, angles = negatives.measure(rows, references)
        for k in range(20):
            low, high = negatives.score_bounds(
                angles[k], angles, angles, norms[k], norms, norms, negatives.angle_slack(width)
            )
            scores = rows @ rows[k]
            assert (low <= scores).all() and (scores <= high).all()


def test_query_against_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    frame = queries.QUERIES["op11_negatives"](spark, folder)
    assert compare.differences(frame, compare.connect(folder), oracles.ORACLES["op11_negatives"]) == []
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted((tuple(row[n] for n in names) for row in frame.collect()), key=str) == brute(rows)
