import math
import random

import numpy as np
from pyspark.sql import functions as F

from wayfare.llm import quality
from wayfare.llm.words import WordCodes

SCHEMA = "doc_id long, text string, quality_rules_x string, n_words int"
GOOD = "the committee has read the report with care and found that its method holds for all of the cases named in it number {}"
BAD = "click click WIN $$$ now!!! %% free ## offer {} >>> buy buy buy <<< zzz qqq xxx jjj kkk vvv"


def corpus(spark):
    """Rows, their frame, and labels of every second one."""
    end = " so that we may go on with the work at hand and see what the year will bring to us and to those who come later on"
    rows = [(i, GOOD.format(i) + end + f" and on page {i * 7}", None, i) for i in range(40)]
    draw = random.Random(1)  # shuffled words, so that the repeats of the base rules do not reject them
    rows += [(100 + i, " ".join(draw.sample(BAD.split() * 4, 60)) + f" {i}", "x", None) for i in range(40)]
    labels = [(row[0], int(row[0] < 100)) for row in rows[::2]]
    return rows, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


def test_counts_of_words():
    codes = WordCodes()
    text = "a b c a b c\n\n x#$\n x#$\nlast é\x0b<y>"
    words = text.split()
    assert quality.base_counts(text.encode(), codes) == (len(words), sum(map(len, words)), 6, 1, 6)
    assert quality.base_counts(b"", codes) == (0, 0, 0, 0, 0)
    assert quality.base_failed(49, 0) and quality.base_failed(100, 51) and not quality.base_failed(100, 50)


def test_score_is_length_normalised_and_finite():
    ratio = np.linspace(-1, 1, quality.BUCKETS)
    once = quality.score(b"abcdefgh" * 50, ratio)
    assert math.isclose(once, quality.score(b"abcdefgh" * 5000, ratio), rel_tol=0.05, abs_tol=0.02)
    assert quality.score(b"", ratio) == quality.score(b"abc", ratio) == 0


def test_unseen_rows_are_judged_right(spark):
    rows, frame, labels = corpus(spark)
    model = quality.fit(frame, labels)
    for row in rows[1::2]:
        assert (quality.score(row[1].encode(), model.ratio) >= model.threshold) == (row[0] < 100)
    again = quality.fit(frame.repartition(5), labels.repartition(3))
    assert again.threshold == model.threshold and (again.ratio == model.ratio).all()


def test_nulls_long_texts_and_repeated_rows(spark):
    _, frame, labels = corpus(spark)
    model = quality.fit(frame, labels)
    long = " ".join(GOOD.format(i) for i in range(20_000))
    odd = [(None, None, None, None), (1, "", None, None), (1, long, None, None), (1, long, None, None)]
    got = quality.judged(spark.createDataFrame(odd, SCHEMA), model)
    assert got.columns == [*frame.columns, "quality_rules"]
    by_text = {r["text"]: r["quality_rules"] for r in got.collect()}
    assert len(got.collect()) == 4
    assert by_text[None] == by_text[""] and by_text[None]["base_failed"] and not by_text[None]["kept"]
    assert by_text[long]["n_words"] == len(long.split())


def test_empty_tables(spark):
    _, frame, labels = corpus(spark)
    assert quality.judged(frame.limit(0), quality.fit(frame.limit(0), labels)).collect() == []
    unlabelled = quality.fit(frame, labels.limit(0))
    kept = quality.judged(frame, unlabelled).select("quality_rules.*").collect()
    assert all(r["kept"] != r["base_failed"] for r in kept)


def plain_threshold(judged):
    judged = sorted(judged)
    scores, good = np.array([s for s, _ in judged]), np.array([g for _, g in judged], bool)
    if not len(scores) or good.all() or not good.any():
        return -np.inf
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    cut = int(np.argmax(caught - 10 * lost))
    if cut == 0:
        return -np.inf
    return float((scores[cut - 1] + scores[cut]) / 2) if cut < len(scores) else float(scores[-1])


def test_threshold_equals_that_of_sorted_rows(spark):
    draw = random.Random(3)
    cases = [[], [(0.5, True)], [(0.5, False)], [(0.1, False), (0.2, True)], [(0.2, False), (0.2, True)]]
    cases += [[(0.3, True), (0.4, False)], [(-0.1, False), (0.1, False), (-0.5, True), (0.1, True)]]
    for size, shift in ((300, 0.6), (300, 0.2)):
        good = [draw.random() < 0.6 for _ in range(size)]
        cases.append([(round(draw.random() + shift * g, 2), g) for g in good])
    for case in cases:
        frame = spark.createDataFrame(case, "score double, good boolean")
        assert quality.threshold(frame) == plain_threshold(case), case


def test_all_labelled_rows_take_part(spark):
    """More labels of a kind than were once looked at (20,000), and rows with equal ids."""
    rows, frame, _ = corpus(spark)
    rows = rows + [rows[0], (None, "null ids are never trusted", None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    labels = frame.select("doc_id", (F.col("doc_id") < 100).cast("int").alias("quality")).union(
        spark.range(1000, 61_000).selectExpr("id", "int(id % 2)")
    )
    known = labels.dropna().distinct().withColumn("draw", F.xxhash64("doc_id"))
    good = [r["doc_id"] for r in known.filter("quality = 1").orderBy("draw", "doc_id").collect()]
    trusted, codes = set(good[::2]), WordCodes()
    counts = np.zeros((2, quality.BUCKETS))
    for key, text, _, _ in rows:
        found = np.bincount(quality._buckets(text.encode()), minlength=quality.BUCKETS)
        counts += [found * (key in trusted), found]
    smooth = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    ratio = np.log(smooth[0] / smooth[1])
    held_out = [(quality.score(r[1].encode(), ratio), r[0] < 100, r[1]) for r in rows if r[0] is not None and r[0] not in trusted]
    passed = [(s, g) for s, g, t in held_out if not quality.base_failed(*quality.base_counts(t.encode(), codes)[::4])]
    model = quality.fit(frame, labels)
    assert (model.ratio == ratio).all()
    assert model.threshold == plain_threshold(passed) > -np.inf
