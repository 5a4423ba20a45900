"""The operators of this package bound to the driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.llm import (
    conversation_repair,
    decontaminate,
    licenses,
    line_dedup,
    oracles,
    packing,
    quality,
    quality_rules,
    sharding,
    simhash,
    spelling,
    surrogates,
    threshold_topk,
    token_orc,
)
from riskfold.llm.common import read_table, shared_path, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_threshold_topk": oracles.topk_sql(), "op7_license_sentences": oracles.licenses_sql(), "op11_rule_cascade": oracles.rule_cascade_sql()}

#: Key of the catalogue's surrogates; a real run passes its own secret.
SURROGATE_KEY = "catalogue"


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file installed with the environment."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as ORC and read back."""
    path = shared_path(spark, "token-orc")
    token_orc.write_token_orc(
        read_table(spark, sf_dir, "documents", "doc_id", "text"), path, tokenizer_file("byte_bpe_50k.json"), end_id=2
    )
    rows = token_orc.ids_crc32(token_orc.read_positions(spark, path))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


@register
def op3_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, shard sizes at most one row apart."""
    placed = sharding.shuffle_shards(read_table(spark, sf_dir, "documents", "doc_id", "text"), n_shards=16)
    text = F.encode(text_of("text"), "utf-8")
    return placed.select(
        "doc_id",
        (F.length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces, packed into sequences of 2048."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)
    return packing.pack_pieces(token_orc.ids_crc32(pieces), 2048)


@register
def op10_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, at most 4 bits apart."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), words=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


@register
def op5_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    weights = quality.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = quality.score(docs, weights, threshold=0.7)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@register
def op2_winnowing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the line runs of 20 words or more that an earlier place has."""
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"), min_words=20)


@register
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, exact or edited, with the item and the passage."""
    found = decontaminate.find_matches(
        read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text")
    )
    return found.drop("text_key")


@register
def op6_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    rows = threshold_topk.quantised(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    found = threshold_topk.top_k(rows, rows.filter("id % 20 = 0"), k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@register
def op7_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of all documents."""
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licenses", " ").alias("licenses"),
        F.array_join("loose_ids", " ").alias("loose_ids"),
    )


@register
def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    return surrogates.replace_entities(read_table(spark, sf_dir, "documents", "doc_id", "text"), key=SURROGATE_KEY)


@register
def op11_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of all documents, and the verdict of the rules' cascade."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    order = [e.name for e in quality_rules.estimate(docs, ready=quality_rules.BASE)]
    judged = quality_rules.cascade(quality_rules.measure(docs), order, ready=quality_rules.BASE)
    few, repeated = (quality_rules.RULES[r]({n: F.col(n) for n in quality_rules.BASE}) for r in quality_rules.BASE_RULES)
    return judged.select("doc_id", *quality_rules.BASE, (few | repeated).alias("base_failed"), "kept")


@register
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    conversations = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(conversation_repair.damaged(conversations), also=conversations.select("conv_id"))
    return conversation_repair.summaries(repaired)


@register
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots, after planted misspellings."""
    found = spelling.spelling_variants(read_table(spark, sf_dir, "documents", "doc_id", "text"), damage=199)
    return found.select("word", "form", "root", "n", "n_near", "form_n")
