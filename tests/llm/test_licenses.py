import collections
import random
import re

import pytest

from wayfare.llm import licenses, queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def bag_distance(a, b):
    a, b = collections.Counter(a), collections.Counter(b)
    return max((a - b).total(), (b - a).total())


def brute(text):
    """Base columns, and the fewest slips of each notice that is near enough, over all runs of words."""
    words = WORD.findall(lowered(text))
    base = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    fewest = {}
    for label, notice in licenses.NOTICES:
        most = max(1, len(notice) // licenses.CHARACTERS_PER_SLIP)
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                run = " ".join(words[i:j])
                if len(run) > len(notice) + most:
                    break
                # more letters apart than slips could account for
                if len(run) < len(notice) - most or bag_distance(run, notice) > most:
                    continue
                if (slips := distance(run, notice)) <= most:
                    fewest[notice] = min(slips, fewest.get(notice, slips))
    return len(words), base, fewest


def check(row, text):
    n_words, base, fewest = brute(text)
    starts = [i for i, _ in base]
    labels = {label for _, label in base}
    all_labels = labels | {label for label, notice in licenses.NOTICES if notice in fewest}
    assert (row["n_words"], row["n_base"]) == (n_words, len(base))
    assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
    assert row["base_labels"] == ",".join(sorted(labels)) and row["labels"] == ",".join(sorted(all_labels))
    score = 1.0 if base else max((1 - n / len(notice) for notice, n in fewest.items()), default=0.0)
    assert row["score"] == pytest.approx(score)
    return fewest


def slipped(text, slips, draw):
    chars = list(text)
    for _ in range(slips):
        at = draw.randrange(len(chars))
        kind = draw.randrange(3)
        if kind == 0:
            chars[at] = draw.choice("abcxyz")
        elif kind == 1:
            chars.insert(at, draw.choice("abcxyz "))
        else:
            del chars[at]
    return "".join(chars)


def test_slips_are_found_up_to_the_bound_and_no_further(spark):
    draw, texts = random.Random(5), []
    for _, notice in licenses.NOTICES:
        for extra in range(-1, 3):
            slips = max(1, len(notice) // licenses.CHARACTERS_PER_SLIP) + extra
            body = slipped(notice, max(0, slips), draw)
            texts.append(f"some words. {body.upper() if draw.random() < 0.5 else body}, and\n// more words")
    texts += ["xreleased under the mit license", "released under the mit licensed", "re leased under the m it license"]
    rows = [(i, text) for i, text in enumerate(texts)]
    got = licenses.scanned(spark.createDataFrame(rows, "id long, text string")).select("id", "text", "licenses.*").collect()
    found = 0
    for row in got:
        fewest = check(row, row["text"])
        by_notice = collections.defaultdict(list)
        for span in row["spans"]:
            by_notice[span["notice"]].append(span["slips"])
            words = " ".join(WORD.findall(lowered(row["text"][span["start"] : span["stop"]])))
            assert distance(words, span["notice"]) <= span["slips"]
        assert {notice: min(slips) for notice, slips in by_notice.items()} == fewest
        found += bool(fewest)
    assert 0 < found < len(texts)


def test_spans_of_several_notices_with_marks_between(spark):
    text = "# Permission is hereby granted, free of charge,\n#  to any person obtaining a copy of this sofware.\n\nMIT License MIT license"
    row = licenses.scanned(spark.createDataFrame([(text,)], "text string")).select("licenses.*").first()
    (span,) = row["spans"]
    assert (span["label"], span["slips"], span["first_word"], span["last_word"]) == ("mit", 1, 0, 15)
    assert text[span["start"] : span["stop"]].startswith("Permission") and text[span["start"] : span["stop"]].endswith("sofware")
    assert (row["n_base"], row["first_word"], row["last_word"], row["labels"], row["score"]) == (2, 16, 18, "mit", 1.0)


def test_nulls_empty_long_repeated_and_clashing(spark):
    long = "straße ß\x00" * 50_000 + " released under teh mit license " + "é" * 100_000
    rows = [(None, None, 1), (2, "", 1), (3, long, 1), (3, long, 1), (None, "GENERAL  public\nLicense", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = licenses.scanned(frame).collect()
    assert [tuple(r["licenses"][:7]) for r in got[:2]] == [(0, 0, None, None, "", "", 0.0)] * 2
    assert got[2]["licenses"] == got[3]["licenses"] and got[2]["licenses"]["labels"] == "mit"
    assert tuple(got[4]["licenses"][:7]) == (3, 1, 0, 0, "gpl", "gpl", 1.0) and got[4]["n_words"] == 2
    assert licenses.scanned(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        licenses.scanned(frame, name="n_words")
    with pytest.raises(ValueError):
        licenses.NoticeSearch([("x", "Not Normal")], {})


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.QUERIES["op12_licenses"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for row in got:
        words = len(WORD.findall(lowered(texts[row["doc_id"]])))
        if words < 120 or row["labels"]:
            check(row, texts[row["doc_id"]])
        else:
            assert row["n_words"] == words
    assert sum(bool(r["labels"]) for r in got) > 0
