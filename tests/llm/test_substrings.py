import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import substrings
from wayfare.llm.fmindex import FMIndex, WaveletTree
from wayfare.llm.substrings import kept_digests, reported, segments, without_repeats
from wayfare.llm.words import window_codes


def brute(texts, window):
    documents = [(text or "").encode().split() for text in texts]
    starts = Counter(tuple(d[i : i + window]) for d in documents for i in range(len(d) - window + 1))
    results = []
    for words in documents:
        gone = set()
        for i in range(len(words) - window + 1):
            if starts[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        results.append((len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return results


def test_wavelet_tree():
    draw = np.random.default_rng(0)
    for symbols in (1, 2, 3, 17, 64):
        sequence = draw.integers(0, symbols, 300)
        tree = WaveletTree(sequence, symbols)
        for place in (0, 1, 63, 64, 65, 299, 300):
            every = np.arange(symbols)
            want = np.bincount(sequence[:place], minlength=symbols)
            assert (tree.rank(every, np.full(symbols, place)) == want).all()


def test_index_counts_repeats():
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 4, n).astype(np.uint64) for n in (0, 1, 40, 60, 3)]
    index = FMIndex(texts, 6)
    starts = index.closing - [len(t) for t in texts]
    counted = Counter(tuple(t[i : i + k]) for t in texts for k in range(1, 7) for i in range(len(t) - k + 1))
    for text, start in zip(texts, starts):
        got = index.repeated_before(start + np.arange(len(text)), 6)
        for end in range(len(text)):
            want = max((k for k in range(1, min(6, end + 1) + 1) if counted[tuple(text[end - k + 1 : end + 1])] > 1), default=0)
            assert got[end] == want


def test_windows_have_codes_of_their_own():
    codes = np.array([1, 2, 3] * 30 + [4], np.uint64)
    for size in (1, 2, 3, 5, 8, 35):
        got = window_codes(codes, size)
        by_content = {}
        for i, code in enumerate(got):
            by_content.setdefault(tuple(codes[i : i + size]), set()).add(int(code))
        assert all(len(c) == 1 for c in by_content.values())
        assert len(set(map(int, got))) == len(by_content)


def test_segments_cover_all_windows():
    codes = np.random.default_rng(2).integers(0, 50, 400).astype(np.uint64)
    _, _, first, number = segments(codes, 35)
    assert first[0] == 0 and (first[1:] == first[:-1] + number[:-1]).all() and first[-1] + number[-1] == 366
    assert len(segments(codes[:34], 35)[0]) == 0


def made_up(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    fresh = lambda n: draw.choices(vocabulary, k=n)
    passages = [fresh(draw.randint(10, 70)) for _ in range(6)]
    texts = ["", None, " \n ", "one", " ".join(["x"] * 200), " ".join(["a", "b"] * 40)]
    for _ in range(40):
        words = fresh(draw.randint(0, 60))
        for _ in range(draw.randint(0, 3)):
            words += draw.choice(passages) + fresh(draw.randint(0, 30))
        texts.append((" " if draw.random() < 0.5 else "\n").join(words))
    texts += [texts[10], texts[11], texts[12] + " tail", "É " + (texts[13] or "")]
    return texts


@pytest.mark.parametrize("settings", [{}, {"hot_segments": 1}, {"hot_segments": 3, "shard_words": 200}])
def test_against_brute_force(spark, settings):
    texts = made_up(7)
    frame = spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)], "doc_id long, text string, mark string, n int")
    got = {r["doc_id"]: r for r in without_repeats(frame, **settings).collect()}
    want = brute(texts, 35)
    assert sum(w[1] for w in want) > 500 and any(0 < w[1] < w[0] for w in want)
    for i, expected in enumerate(want):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_text"]) == expected


def test_repeated_rows_and_no_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (None, text + " more"), (None, None), (2, "short"), (2, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, without_repeats(frame).collect()), key=str)
    assert got == sorted(
        [(1, 50, 50, ""), (1, 50, 50, ""), (None, 51, 50, "more"), (None, 0, 0, ""), (2, 1, 0, "short"), (2, 1, 0, "short")], key=str
    )
    digests = {r["n_words"]: r["kept_sha256"] for r in kept_digests(frame).collect()}
    assert digests[51] == hashlib.sha256(b"more").hexdigest()
    assert kept_digests(frame.limit(0)).collect() == []


def test_rows_without_ids_whose_short_hashes_collide(spark):
    names = spark.range(400_000).select(F.concat(F.lit("name"), "id").alias("name"))
    text = F.concat_ws(" ", F.array_repeat("name", 3), F.lit(" ".join(f"w{i % 37}" for i in range(90))))
    pairs = names.groupBy(F.hash(text).alias("h")).agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a < b")
    a, b = pairs.orderBy("a").first()[1:]
    shared = " ".join(f"w{i % 37}" for i in range(90))
    texts = [f"{a} {a} {a} {shared}", f"{b} {b} {b} {shared}", "some other words " + shared[:150], None, "x y"]
    got = kept_digests(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"))
    want = Counter((n, gone, hashlib.sha256(kept.encode()).hexdigest()) for n, gone, kept in brute(texts, 35))
    assert Counter((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()) == want


def test_index_counts_copies_by_weight():
    draw = np.random.default_rng(3)
    texts = [draw.integers(0, 5, n).astype(np.uint64) for n in (9, 30, 12, 8, 8)]
    weights = [1, 1, 3, 1, 2]
    index = FMIndex(texts, 30, np.array(weights))
    counted = Counter()
    for text, weight in zip(texts, weights):
        for i in range(len(text) - 7):
            counted[tuple(text[i : i + 8])] += weight
    covered = {k: set() for k in range(len(texts))}
    for k, first, last in zip(*reported(index, np.array([len(t) for t in texts]), 8)):
        covered[int(k)].update(range(first, last))
    for k, text in enumerate(texts):
        want = set()
        for i in range(len(text) - 7):
            if counted[tuple(text[i : i + 8])] > 1:
                want.update(range(i, i + 8))
        assert covered[k] == want
    assert covered[2] == set(range(12)) and len(covered[1]) < 30


def test_results_come_from_the_index(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(50))
    frame = spark.createDataFrame([(1, text), (2, text), (3, "own " + text)], "doc_id long, text string")
    for settings in ({}, {"hot_segments": 1}):
        assert sorted(r["n_removed"] for r in without_repeats(frame, **settings).collect()) == [50, 50, 50]
    nothing = np.empty(0, np.int64)
    monkeypatch.setattr(substrings, "reported", lambda *_: (nothing, nothing, nothing))
    monkeypatch.setattr(substrings, "_searched", _with(substrings._searched, substrings.reported))
    for settings in ({}, {"hot_segments": 1}):
        assert [r["n_removed"] for r in without_repeats(frame, **settings).collect()] == [0, 0, 0]


def _with(function, reported_):
    """The function with another ``reported``, carried by value to the workers."""
    return type(function)(function.__code__, {**function.__globals__, "reported": reported_, "__name__": "__main__"})


def test_very_long_text(spark):
    draw = random.Random(4)
    words = [f"w{draw.randrange(3000)}" for _ in range(150_000)]
    texts = [" ".join(words), " ".join(words[70_000:70_200]), "x " * 120_000, " ".join(["y"] + words[-40:])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in kept_digests(frame).collect()}
    assert got == {0: (150_000, 240), 1: (200, 200), 2: (120_000, 120_000), 3: (41, 40)}
