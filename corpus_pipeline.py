"""From raw documents to token ids: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's docs.  All but the
last return the columns of documents, with ``n_chars`` kept in step with
the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import bpe, line_dedup, mixing, ngram_join, quality
from stratus.llm.common import small_batches, table, word_count, written

# Production parameters
VOCABULARY = "byte_bpe_50k.tiktoken"
MIX_WEIGHTS, MIX_SHARE, MIX_MOST = (3, 1, 2), 1.5, 2


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents, does not reject.

    A null or blank text is scored as a text without words; null and
    repeated ids are scored row by row.  An empty table stays empty.
    """
    small_batches(spark)
    forest = quality.train(docs, table(spark, sf_dir, "labels"), quality.SAMPLE)
    return docs.filter(quality.score_column(spark, forest) >= quality.THRESHOLD)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier; a document goes when all its lines do.

    Documents without any words (null and blank texts too) stay as they
    are.  Rows that repeat id and text are cut alike.
    """
    small_batches(spark)
    cut = line_dedup.drop_lines(docs)
    n_lines, n_dropped = (F.col(c) for c in cut.columns[len(docs.columns) :][:2])
    return _with_text(cut.filter((n_lines == 0) | (n_dropped < n_lines)), docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Null and blank texts link with nothing and stay, and so do rows without
    an id, which cannot be named.  Rows that repeat an id are one document:
    all of them stay, or none.
    """
    small_batches(spark)
    texts = docs.select("doc_id", "text")
    found = ngram_join.similar_components(texts, width=ngram_join.WIDTH, percent=ngram_join.PERCENT)
    gone = written(found.filter("component_id <> doc_id").select("doc_id").distinct(), "pipeline-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a whole document per row, as often as the mix takes it (once to ``MIX_MOST`` times, or never).

    Where a source's target ends inside a document, the document comes once
    more if half of its words or more are taken, so a source misses its
    target by less than half a document.  Documents without words (null and
    blank texts too) take nothing of a target and stay once.  Rows that
    repeat id and text are taken alike.
    """
    small_batches(spark)
    named = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("text_hash"))
    pieces = mixing.mix_sources(named, MIX_WEIGHTS, MIX_SHARE, MIX_MOST, carry=("text_hash",)).pieces()
    # of one document and pass, pieces come from its first word on without gaps
    taken = pieces.groupBy("doc_id", "text_hash", "pass").agg(F.max("to_word").alias("upto"), F.max("size").alias("size"))
    taken = taken.filter(2 * F.col("upto") >= F.col("size")).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).cast("int").alias("times"))
    taken = taken.select(*[F.col(c).alias(f"mix.{c}") for c in taken.columns])
    wanted = docs.join(
        taken, F.col("doc_id").eqNullSafe(F.col("`mix.doc_id`")) & (F.xxhash64("text") == F.col("`mix.text_hash`")), "left"
    )
    times = F.when(word_count(F.col("text")) == 0, 1).otherwise(F.coalesce("`mix.times`", F.lit(0)))
    # as many copies as times, none for 0
    return wanted.select(*docs.columns, F.explode(F.array_repeat(F.lit(True), times)).alias("mix.copy")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, packed ids, and the digest of the bytes they decode to.

    A null or empty text has no ids and the digest of nothing; rows are
    kept one for one, also with null or repeated ids.
    """
    small_batches(spark)
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = tokenizer.decode(tokenizer.encode(docs))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", dedup_lines),
    ("near_duplicates", one_per_group),
    ("mix", mix),
    ("encode", encode),
]

# The classifier's trees and the vocabulary's merges are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
