"""Document fingerprints by I-Match over several randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band: terms in too few texts are mostly slips,
those in too many say nothing. Document frequencies are counted over all texts, for each term by its 64-bit code. The band
ends where all the texts' terms together, divided by the texts of a term, give ``MOST_TERMS``: no more terms than that can
be in so many texts each, so the lexicon has a proven size and can go to every task. With n terms in a text on average,
that is one inverse document frequency, ``MOST_TERMS`` / n, for tables of any size. A fingerprint is one hash per random subset of the lexicon,
taken over the sorted distinct terms of the text that are in the subset. Subsets keep from a half to a 256th of the
lexicon, so that for texts of any length some subsets hold only a few of their terms.

Defined results: a null text is empty; a text without terms in the band uses all its terms; a text without words
has empty hashes only; two such texts are alike (1), and not like any other (0). Equal texts have equal
fingerprints. For ``with_next``, rows without an id come first, and rows of one id are ordered by a hash of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.packing import packed, unpacker
from wayfare.llm.running import Stored
from wayfare.llm.words import WordCodes, mixed

#: the lexicon has at most so many terms, of eight bytes each
MOST_TERMS = 1 << 22

#: a task adds up so many distinct terms before it passes them on
COUNTED_TERMS = 1 << 22

#: the band: terms of at least so many texts, and of at most this share of all texts
LEAST_TEXTS = 2
MOST_SHARE = 0.05

#: random subsets of the lexicon: so many for each of the shares 1/2, 1/4, …
SUBSETS_PER_SHARE = 4
HALVINGS = 8

_EMPTY = 0


@dataclass(frozen=True)
class Lexicon:
    """``codes``: a broadcast of the sorted codes of the terms in the band, as bytes."""

    codes: Broadcast[bytes]

    def terms(self) -> np.ndarray:
        return np.frombuffer(self.codes.value, np.uint64)


def document_frequencies(df: DataFrame, text_col: str) -> DataFrame:
    """(code, texts) over all rows; each task adds up its own terms first, in bounded room."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordCodes()
        none = np.empty(0, np.uint64), np.empty(0, np.int64)
        (codes, counts), new, size = none, [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                new.append(np.unique(words.of(list(set(text.split())))))
                size += len(new[-1])
                if size >= COUNTED_TERMS:
                    (codes, counts), new, size = _added(codes, counts, new), [], 0
                    if len(codes) >= COUNTED_TERMS:
                        yield _frequencies(codes, counts)
                        codes, counts = none
        yield _frequencies(*_added(codes, counts, new))

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return df.select(text).mapInArrow(count, "code long, texts long").groupBy("code").agg(F.sum("texts").alias("texts"))


def _added(codes: np.ndarray, counts: np.ndarray, new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([codes, *new])
    weights = np.concatenate([counts, np.ones(len(every) - len(codes), np.int64)])
    order = np.argsort(every)
    every, weights = every[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else order
    return every[starts], np.add.reduceat(weights, starts) if len(every) else weights


def _frequencies(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], ["code", "texts"])


def lexicon(
    df: DataFrame,
    text_col: str = "text",
    least_texts: int = LEAST_TEXTS,
    most_share: float = MOST_SHARE,
    most_terms: int = MOST_TERMS,
) -> Lexicon:
    """The band of the table. Jobs run at once; at most eight bytes for each of ``most_terms`` go to the driver."""
    most = max(least_texts, int(df.count() * most_share))
    counted = Stored(document_frequencies(df, text_col).filter(F.col("texts") >= least_texts), "frequencies")
    together = counted.rows.agg(F.sum("texts")).first()[0] or 0
    least = max(least_texts, -(-together // most_terms))

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary())], ["codes"])

    inside = counted.rows.filter(F.col("texts").between(least, max(least, most))).select("code")
    found = b"".join(row["codes"] for row in inside.mapInArrow(as_bytes, "codes binary").collect())
    counted.drop()
    codes = np.sort(np.frombuffer(found, np.uint64)).tobytes()
    return Lexicon(df.sparkSession.sparkContext.broadcast(codes))


class Fingerprinter:
    def __init__(self, lexicon: Lexicon):
        self._band, self._words = lexicon.terms(), WordCodes()
        number = np.arange(SUBSETS_PER_SHARE * HALVINGS, dtype=np.uint64)
        self._salt = mixed(number + np.uint64(1))[:, None]
        share = np.uint64(1) + number // np.uint64(SUBSETS_PER_SHARE)
        self._limit = (np.uint64(1) << (np.uint64(32) - share))[:, None]

    def __call__(self, text: bytes) -> np.ndarray:
        """A 32-bit hash for each subset; 0 for a subset without terms of the text."""
        codes = np.unique(self._words.of(list(set(text.split()))))
        terms = codes[self._holds(codes)]
        if not len(terms):
            terms = codes
        chosen = mixed(terms[None, :] ^ self._salt) >> np.uint64(32) < self._limit
        hashes = [
            (xxhash.xxh32_intdigest(terms[row].astype("<u8").tobytes()) or 1) if any_ else _EMPTY
            for row, any_ in zip(chosen, chosen.any(axis=1).tolist())
        ]
        return np.array(hashes, np.uint32)

    def _holds(self, codes: np.ndarray) -> np.ndarray:
        if not len(self._band):
            return np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(self._band, codes), len(self._band) - 1)
        return self._band[at] == codes


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal hashes among the subsets in which either text has terms."""
    used = (a != _EMPTY) | (b != _EMPTY)
    return float((a == b)[used].mean()) if used.any() else 1.0


def shown(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprint_udf(lexicon: Lexicon):
    """Column function of a binary text: the hashes in hexadecimal digits, eight for each subset."""

    @F.arrow_udf("string")
    def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make = Fingerprinter(lexicon)
        for batch in texts:
            yield pa.array([shown(make(text or b"")) for text in batch.to_pylist()], pa.string())

    return fingerprints


def in_chains(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chain, guest, place, mark, id, packed text), dealt and sorted so that a row's successor by id is the next row.

    Ids are cut into chains at approximate quantiles, so the chains have about equal numbers of rows. The last row of a
    chain is followed by a guest: a copy of the first row of the next chain, or of the first of all after the last. How
    the cuts fall changes nothing but the balance.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63)))
    rows = df.select(
        place.alias("place"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"),
        F.col(id_col).alias("id"),
        packed(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    )
    chains = 4 * partitions
    shares = F.lit([i / chains for i in range(1, chains)])
    cuts = df.select(place.alias("place")).agg(F.percentile_approx("place", shares, F.lit(20 * chains)).alias("cuts")).first()[0]
    edges = np.array(sorted(set(cuts or [])), np.int64)
    chain = _chain_udf(edges)(F.col("place"))
    firsts = {
        row["first"]: row["chain"]
        for row in df.select(place.alias("place")).groupBy(chain.alias("chain")).agg(F.min("place").alias("first")).collect()
    }
    starts = np.array(sorted(firsts), np.int64)
    # the first row of a chain is the guest of the chain before it
    hosts = np.roll(np.array([firsts[start] for start in starts.tolist()], np.int32), 1)
    own = F.struct(F.col("chain"), F.lit(False).alias("guest"))
    copies = F.when(F.col("host").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.col("host").alias("chain"), F.lit(True).alias("guest")))
    )
    return (
        rows.withColumn("chain", chain)
        .withColumn("host", _host_udf(starts, hosts)(F.col("place")))
        .withColumn("copy", F.explode(copies))
        .select("copy.chain", "copy.guest", "place", "mark", "id", "text")
        .repartition(partitions, "chain")
        .sortWithinPartitions("chain", "guest", "place", "mark")
    )


def _chain_udf(edges: np.ndarray):
    @F.arrow_udf("int")
    def chain(places: pa.Array) -> pa.Array:
        found = np.searchsorted(edges, places.to_numpy(zero_copy_only=False), side="right")
        return pa.array(found.astype(np.int32))

    return chain


def _host_udf(starts: np.ndarray, hosts: np.ndarray):
    @F.arrow_udf("int")
    def host(places: pa.Array) -> pa.Array:
        values = places.to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(starts, values), max(len(starts) - 1, 0))
        if not len(starts):
            return pa.nulls(len(values), pa.int32())
        return pa.array(hosts[at], mask=starts[at] != values)

    return host


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its fingerprint, that of the text edited with the next row's, and both likenesses."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, unpack = Fingerprinter(lexicon), unpacker()
        last = None
        for batch in batches:
            ids, rows = [], []
            columns = (batch.column(name).to_pylist() for name in ("chain", "guest", "id", "text"))
            for chain, guest, key, text in zip(*columns):
                if guest and (last is None or last[0] != chain or last[1]):
                    continue  # one guest closes a chain
                data = unpack(text)
                text, own = data.decode(), make(data)
                if last is not None and last[0] == chain:
                    changed = edited(last[3], text)
                    new = make(changed.encode())
                    ids.append(last[2])
                    rows.append(
                        (
                            len(last[3]),
                            hashlib.sha256(changed.encode()).hexdigest(),
                            shown(last[4]),
                            shown(new),
                            likeness(last[4], new),
                            likeness(last[4], own),
                        )
                    )
                last = chain, guest, key, text, own
            made = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("id").type), *(pa.array(c, k) for c, k in zip(made, kinds))],
                ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_chains(df, id_col, text_col).mapInArrow(walk, schema).withColumnRenamed("id", id_col)
