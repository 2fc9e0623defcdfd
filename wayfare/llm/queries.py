"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import audit, chat, imatch, licenses, mixture, negatives, pages, pieces, pii, quality, shards, simhash, substrings
from wayfare.sources.tables import read_table

SHARDS = 40
SEED = 20
#: a secret in production, where it comes from the settings of the job
PII_KEY = "surrogates"

Query = Callable[[SparkSession, str], DataFrame]


def _model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(read_table(spark, sf_dir, "documents"))


def round_trips(documents: DataFrame) -> DataFrame:
    result = pieces.round_trip_udf(_model())(F.col("text").cast("binary"))
    return documents.select("doc_id", result.alias("r")).select("doc_id", "r.*")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    sizes = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shards.interleave(sizes, SHARDS, SEED).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        "select bigint(-1) conv_id, bigint(id) turn, if(id = 0, 'user', 'assistant') role, "
        f"'{tricky}' text from range(2)"
    )
    chats = chat.format_chats(turns.union(extra))
    read = chats.select(
        "conv_id",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(documents, PII_KEY, count_col="n_replaced")


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extracted(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return imatch.compare_with_next(documents, imatch.lexicon(documents))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    sizes = documents.select("doc_id", "source", mixture.count_words(F.col("text")).alias("size"))
    # for each part taken its shard and its words, the last not included
    parts = F.transform("shards", lambda p: F.concat_ws(":", p["shard"], p["first"], p["last"]))
    taken = mixture.taken_words(sizes, SEED)
    return taken.select("doc_id", "size", "source_size", "target", "taken", F.array_join(parts, ",").alias("shards"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = quality.fit(documents, read_table(spark, sf_dir, "labels"))
    return quality.judged(documents, model).select("doc_id", "quality_rules.*")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digests(read_table(spark, sf_dir, "documents"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        negatives.quantised(F.col("embedding")).alias("vector"),
    )
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("licenses.spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["stop"], s["slips"]))
    digest = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", *(f"licenses.{c}" for c in digest), F.array_join(spans, ",").alias("spans"))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_shards": op2_shards,
    "op3_chat": op3_chat,
    "op4_simhash": op4_simhash,
    "op5_pii": op5_pii,
    "op6_pages": op6_pages,
    "op7_imatch": op7_imatch,
    "op8_mixture": op8_mixture,
    "op9_quality": op9_quality,
    "op10_substrings": op10_substrings,
    "op11_negatives": op11_negatives,
    "op12_licenses": op12_licenses,
    "op13_audit": op13_audit,
}
