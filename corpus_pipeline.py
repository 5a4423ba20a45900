"""A training-corpus pipeline over ``documents``.

``STAGES`` run in order; each takes what its predecessor kept, and all but the
last return the columns of ``documents``:

* quality_classifier - documents scored below 0.7 go (none, if no label can be used);
* line_dedup - line runs of 20 words or more that occurred before are cut from
  the texts (``n_chars`` follows); documents left without any text go;
* simhash_near_dedup - of each group of linked documents the one with the
  least id stays (4-word shingles, at most 4 bits); rows that repeat both id and
  text are one document;
* benchmark_decontamination - documents that hold a benchmark item, exact or
  edited, go;
* best_fit_packing - the rest as token pieces placed in sequences of 2048.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.llm import decontaminate, line_dedup, packing, quality, simhash
from riskfold.llm.common import read_table, saved, text_key
from riskfold.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _named(column: str) -> Column:
    """An id as a join key that is never NULL."""
    return F.coalesce(F.col(column).cast("long").cast("string"), F.lit("none"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels outside the held-out fold; keep what scores 0.7 or more.

    Without a usable label nothing is known of any document, and all stay.
    """
    weights = quality.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    if not weights.any():
        return docs
    scored = quality.score(docs, weights, threshold=0.7, score_col="_quality_score", predicted_col="_quality_predicted")
    return scored.filter("_quality_predicted = 1").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated line runs; a document that loses all its text goes."""
    cut = line_dedup.dedup_lines(docs, min_words=20, removed_col="_lines_removed")
    changed = F.col("_lines_removed") > 0
    left = cut.filter(~changed | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    kind = docs.schema["n_chars"].dataType
    return left.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(kind)).select(*docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component: its least id, then the least text hash."""
    found = simhash.near_duplicates(docs, words=4, max_bits=4, with_root=True)
    # by root: components without ids, or with equal ones, share a component_id
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k"))
    keep = saved(least.select(_named("k.doc_id").alias("_keep_id"), F.col("k.text_key").alias("_keep_key")), "simhash-keep")
    keys = ["_keep_id", "_keep_key"]
    rows = docs.withColumns({"_keep_id": _named("doc_id"), "_keep_key": text_key("text")})
    # rows that repeat both id and text are one document; the join has them together already
    return rows.join(keep.hint("merge"), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset."""
    pieces = packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)
    return packing.pack_pieces(pieces, 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack),
]

#: Model training, token vocabularies and alignment scores have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
