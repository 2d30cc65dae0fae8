"""Corpus preparation in five stages, each one of the corpus operators.

1. toxicity: documents that the classifier takes for toxic go.
2. near_duplicates: of every group of documents linked by five-word shingles (Jaccard
   similarity of 0.8 or more), the one of the smallest id stays.
3. decontamination: documents that hold a benchmark passage go.
4. personal_data: personal data in the texts is replaced by its kind in brackets.
5. tokens: texts become token ids.

All stages but the last return the columns of ``documents``; n_chars follows the text.
Documents with a null or empty text are clean and pass, and so do rows without an id in
stage 2. Rows that repeat a document id share the fate of their group.

Stages return lazy tables of whole texts. A batch of texts is held several times over, by
the JVM and by Python, so every stage sets the session to Arrow batches of ``BATCH_ROWS`` rows at most
(``spark.sql.execution.arrow.maxRecordsPerBatch``), for whoever writes its result; that changes no row.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm import bpe, decontam, ngram_join, pii, toxicity
from claimlake.llm.common import id_filter, keep_batches_small, maybe_in, stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(step: Stage) -> Stage:
    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        keep_batches_small(spark)
        return step(spark, docs, sf_dir)

    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.model_of(spark, docs, sf_dir)
    return toxicity.without_toxic(docs.select(*COLUMNS), model)


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, _, groups = ngram_join.ngram_join(spark, docs, k=5, percent=80)
    gone = stage(spark, groups.where("doc <> component").select(F.col("doc").alias("doc_id")), "gone")
    bits = id_filter(gone, "doc_id")
    docs = docs.select(*COLUMNS)
    # only documents that may be among them are shuffled
    return maybe_in(docs, "doc_id", bits, inside=False).union(maybe_in(docs, "doc_id", bits).join(gone, "doc_id", "left_anti").select(*COLUMNS))


@in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


@in_small_batches
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs.select(*COLUMNS), pii.train(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


@in_small_batches
def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token_ids, n_tokens."""
    ids = bpe.encode(docs, bpe.vocabulary_path(), keep=("doc_id", "lang", "source"), decoded=False)
    return ids.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", to_tokens),
]

#: Trained models, edit distances and the tokenizer are beyond SQL; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), name)
    return docs
