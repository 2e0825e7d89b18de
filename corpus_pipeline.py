"""From documents to packed sequences: each stage reads what the one before it kept.

Defined results: a null or empty text is judged by the classifier like any other; without labels,
all stay. Empty texts link with nothing, so all of them pass the join; a null id is a document of
its own. Secrets are replaced in the text, which drops no row. A mix of no words takes no row. An
empty table of documents gives no rows at every stage. Other columns of the documents stay until the last
stage, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from afterplay.llm import jaccard, mixing, packing, quality, secrets
from afterplay.llm.arrow import small_batches
from afterplay.llm.components import written
from afterplay.llm.queries import GOOD_FROM, HELD_OUT, remainder, tokenizer
from afterplay.plans.registry import table
from afterplay.session import pin_utc, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; those it rejects go."""
    counted = written(quality.with_statistics(docs, "doc_id"), "statistics")
    trees = quality.train(counted, table(spark, sf_dir, "labels"), remainder("doc_id", HELD_OUT) != 0)
    return quality.keep_good(docs, trees, GOOD_FROM)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return jaccard.keep_first(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the secrets that the scan finds."""
    return secrets.redact(docs, secrets.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(mixing.mix(docs, mixing.word_count(F.col("text"))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place in it."""
    return packing.pack(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", keep_one_of_each),
    ("secret_scans", hide_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# trees, n-gram sets, Markov models and the tokenizer are beyond SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    small_batches(pin_utc(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
