import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from wayfare.llm import imatch


def made_up():
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(2000)] + ["the"] * 600
    texts = ["", None, " \n", "a", "é ü"] + [" ".join(draw.choices(vocabulary, k=draw.randint(1, 300))) for _ in range(120)]
    return [*texts, texts[9], texts[10]]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(7 * i % 1000 - 50, text, "g", i) for i, text in enumerate(made_up())]
    rows = [(None if i == 20 else key, *rest) for i, (key, *rest) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, guest string, chain int")


def band(texts, least, most):
    counts = Counter(w for text in texts for w in set((text or "").encode().split()))
    return sorted(xxhash.xxh64_intdigest(w) for w, n in counts.items() if least <= n <= most)


@pytest.mark.parametrize("room", [imatch.COUNTED_TERMS, 100])
def test_lexicon_is_the_band(frame, room, monkeypatch):
    monkeypatch.setattr(imatch, "COUNTED_TERMS", room)
    want = band(made_up(), imatch.LEAST_TEXTS, int(0.2 * len(made_up())))
    assert imatch.lexicon(frame, most_share=0.2).terms().tolist() == want and len(want) > 1000


@pytest.mark.parametrize("bound", [1 << 22, 3000, 1500])
def test_lexicon_has_a_bound(frame, bound):
    """The rarest terms go first, however few the bound leaves."""
    counts = Counter(w for text in made_up() for w in set((text or "").split()))
    least = max(2, math.ceil(sum(n for n in counts.values() if n >= 2) / bound))
    got = imatch.lexicon(frame, most_share=0.2, most_terms=bound).terms()
    assert got.tolist() == band(made_up(), least, 25) and 0 < len(got) <= bound


def test_lexicon_of_two_million_terms(spark):
    """Terms by themselves decide: of two million, those of an even number are in two texts, the others in one."""
    text = "array_join(transform(sequence(id * 100, id * 100 + 99), n -> concat('t', if(id < 20000, n, 2 * (n - 2000000)))), ' ')"
    frame = spark.range(0, 30000, numPartitions=8).selectExpr("id doc_id", f"{text} text")
    got = imatch.lexicon(frame).terms()
    assert np.array_equal(got, np.sort(np.array([xxhash.xxh64_intdigest(f"t{2 * n}") for n in range(1000000)], np.uint64)))


def test_rows_against_brute_force(frame):
    lexicon = imatch.lexicon(frame)
    make = imatch.Fingerprinter(lexicon)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["doc_id"], r["text"] or "") for r in frame.collect()))
    got = {r["doc_id"]: r for r in imatch.compare_with_next(frame, lexicon).collect()}
    assert len(got) == len(rows)
    for at, (_, _, key, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][3]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        row = got[key]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (make(t.encode()) for t in (text, changed, following))
        assert (row["fingerprint"], row["edited_fingerprint"]) == (imatch.shown(a), imatch.shown(b))
        assert (row["near_edited"], row["near_next"]) == (imatch.likeness(a, b), imatch.likeness(a, c))
    near = np.mean([r["near_edited"] for r in got.values()])
    far = np.mean([r["near_next"] for r in got.values()])
    assert near > far + 0.05


def test_fingerprints_follow_the_terms(frame):
    make = imatch.Fingerprinter(imatch.lexicon(frame))
    a = make(b"w1 w2 w3 w4 w5")
    assert imatch.likeness(a, make(b"w5 w4  w3\nw2 w1 w1")) == 1
    assert imatch.likeness(make(b""), make(b" \n")) == 1
    assert imatch.likeness(make(b""), a) == 0


def test_few_rows(spark):
    frame = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    row = imatch.compare_with_next(frame, imatch.lexicon(frame)).collect()
    assert len(row) == 1 and row[0]["near_next"] == 1
    none = frame.limit(0)
    assert imatch.compare_with_next(none, imatch.lexicon(none)).collect() == []
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, None)], "doc_id long, text string")
    got = imatch.compare_with_next(twice, imatch.lexicon(twice)).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 3, 3]
