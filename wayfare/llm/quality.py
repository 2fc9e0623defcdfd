"""Quality rules: counts of words, symbols and repetitions, and a likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed byte n-grams: one fitted on trusted texts (rows labelled
good), one on the whole corpus. The score of a text is the mean logarithm of the ratio over its n-grams, so
it does not depend on the length, and every text is judged by the same threshold, without a draw.

Every labelled row takes part in the fit: every other good one is trusted, found by a join with the texts, and the
threshold is sought over running counts of all the others, found by a join with the scores. What reaches the driver is
a row per bucket and one cut, whatever the size of the tables.

Defined results: a null or empty text has no words and score 0; a row whose id is null is scored like any
other but is never a trusted one; without labelled rows of both kinds every score passes. Repeated rows are
counted and judged each on its own. Columns beside the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.words import WordCodes, window_codes
from wayfare.operators.prefix import position_in_group, running_before

#: bytes of an n-gram, and the number of hash buckets they are counted in
GRAM = 4
BUCKETS = 1 << 16

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_NOT_A_START = _SPACE + bytes(range(0x80, 0xC0))

RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_PENDING = 1 << 21


@dataclass(frozen=True)
class Model:
    """``ratio``: for each bucket the logarithm of trusted over raw; texts scoring below are rejected."""

    ratio: np.ndarray
    threshold: float


def _buckets(text: bytes) -> np.ndarray:
    """The bucket of each n-gram of a text."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(data) < GRAM:
        return np.empty(0, np.uint32)
    stop = len(data) - GRAM + 1
    code = data[:stop].copy()
    for k in range(1, GRAM):
        code |= data[k : stop + k] << np.uint32(8 * k)
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def base_counts(text: bytes, codes: WordCodes) -> tuple[int, int, int, int, int]:
    words = text.split()
    if not words:
        return 0, 0, len(text) - len(text.translate(None, SYMBOLS)), 0, 0
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    windows = window_codes(codes.of(words), 3)
    repeated = 0
    if len(windows) > 1:
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[which] > 1)
        if len(starts):
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[starts + k] = True
            repeated = int(covered.sum())
    return (
        len(words),
        len(text.translate(None, _NOT_A_START)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def score(text: bytes, ratio: np.ndarray) -> float:
    buckets = _buckets(text)
    return float(ratio[buckets].mean()) if len(buckets) else 0.0


def gram_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): n-grams of the column ``text``, which is binary.

    Each task adds up its own table of buckets, so the shuffle holds at most one row per bucket and task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        pending: list[np.ndarray] = []

        def add_up() -> None:
            nonlocal counts
            if pending:
                counts += np.bincount(np.concatenate(pending), minlength=BUCKETS)
                pending.clear()

        waiting = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                buckets = _buckets(text)
                pending.append(buckets)
                waiting += len(buckets)
                if waiting > _PENDING:
                    add_up()
                    waiting = 0
        add_up()
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    partial = texts.select("text").mapInArrow(count, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def labelled_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(id, good, trusted) of every labelled id; in an order by hash, every other good one is trusted."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("good"))
        .dropna()
        .groupBy("id")
        .agg((F.min("good") == 1).alias("good"))
        .withColumn("draw", F.xxhash64("id"))
    )
    placed = position_in_group(known, ["good"], [F.col("draw"), F.col("id")])
    return placed.select("id", "good", (F.col("good") & (F.col("position") % 2 == 1)).alias("trusted"))


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Fit the ratio on half of the labelled good rows, the threshold on the other labelled rows."""
    keyed = _keyed_text(df, id_col, text_col)
    ids = labelled_ids(labels, id_col, label_col)
    # labels grow with the rows, so neither side of a join is broadcast
    trusted = keyed.hint("merge").join(ids.filter("trusted"), "id")
    counts = np.zeros((2, BUCKETS))
    for kind, texts in enumerate((trusted, keyed)):
        for row in gram_counts(texts).collect():
            counts[kind, row["bucket"]] = row["n"]
    if not counts[0].sum():
        return Model(np.zeros(BUCKETS), -np.inf)
    # one more n-gram in each bucket, so that none is impossible
    smooth = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    ratio = np.log(smooth[0] / smooth[1])
    return Model(ratio, threshold(scores(keyed, ratio).hint("merge").join(ids.filter("not trusted"), "id")))


def scores(keyed: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(id, score) of the rows (id, text) that have an id and are not rejected by the base rules.

    All rows are scored, labelled or not, since joining scores moves far less than joining texts.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            rows, values = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                counts = base_counts(text, codes)
                if not base_failed(counts[0], counts[4]):
                    rows.append(row)
                    values.append(score(text, ratio))
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(values, pa.float64())], ["id", "score"])

    schema = T.StructType([keyed.schema["id"], T.StructField("score", T.DoubleType())])
    return keyed.filter("id is not null").mapInArrow(judge, schema)


def threshold(judged: DataFrame) -> float:
    """The middle of the gap between rejected and good rows (score, good) where most are told apart.

    A good row lost counts as much as ten bad rows kept, since clean texts are to stay. Of the cuts, only those right
    above the bad rows of a score can be the best.
    """
    tally = judged.groupBy("score").agg(
        F.count_if(~F.col("good")).alias("bad"), F.count_if(F.col("good")).alias("good")
    )
    running = {"bad_before": ("sum", F.col("bad")), "good_before": ("sum", F.col("good"))}
    tally = running_before(tally, [], [F.col("score")], running)
    bad, good = tally.agg(F.sum("bad"), F.sum("good")).first()
    if not bad or not good:
        return -np.inf
    before = F.coalesce("good_before", F.lit(0))
    caught = (F.coalesce("bad_before", F.lit(0)) + F.col("bad")) / F.lit(float(bad))
    cuts = tally.filter("bad > 0").withColumn("worth", caught - F.lit(10.0) * (before / F.lit(float(good))))
    best = cuts.orderBy(F.desc("worth"), "score").first()
    if best["worth"] <= 0:
        return -np.inf
    if best["good"]:
        return best["score"]
    above = tally.filter(F.col("score") > best["score"]).agg(F.min("score")).first()[0]
    return best["score"] if above is None else (best["score"] + above) / 2


def quality_udf(model: Model):
    """Column function of a binary text: struct of the counts, ``score``, ``base_failed`` and ``kept``."""
    ratio, threshold = model.ratio, model.threshold

    @F.arrow_udf(f"struct<{_fields(RULES)}, score: double, base_failed: boolean, kept: boolean>")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codes = WordCodes()
        for batch in texts:
            columns: list[list] = [[] for _ in range(8)]
            for text in batch.to_pylist():
                text = text or b""
                counts = base_counts(text, codes)
                failed = base_failed(counts[0], counts[4])
                value = score(text, ratio)
                for column, item in zip(columns, (*counts, value, failed, not failed and value >= threshold)):
                    column.append(item)
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [*names, "score", "base_failed", "kept"]
            )

    # else the optimizer may evaluate it once for a filter and again for the result
    return judge.asNondeterministic()


def judged(df: DataFrame, model: Model, text_col: str = "text", name: str = "quality_rules") -> DataFrame:
    """The rows with one struct column more; ``name`` must not be a column already."""
    if name in df.columns:
        raise ValueError(f"column {name} exists; choose another name")
    return df.withColumn(name, quality_udf(model)(F.col(text_col).cast("binary")))


def _fields(ddl: str) -> str:
    return ", ".join(": ".join(part.split()) for part in ddl.split(","))


def _keyed_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return df.select(F.col(id_col).alias("id"), text.alias("text"))
