"""A cleaning pipeline over ``documents``, each stage one operator of ``adspend.llm``.

Quality classifier, exact dedup, near-dedup, benchmark decontamination, then
SentencePiece encoding and decoding. A stage's result is written as Parquet in
the shared folder and read again as the next one's input. The first four
stages return the columns of ``documents``; the last one returns the kept
documents with the size and digests of their token ids.

``ORACLE_SQL`` is None: neither the language model nor the tokenizer can be
said in SQL. The pipeline is tested against a plain version of its stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspend.llm import sentencepiece_codec as codec
from adspend.llm.decontaminate import drop_contaminated
from adspend.llm.exact_dedup import exact_dedup
from adspend.llm.near_dedup import near_dedup
from adspend.llm.quality import keep_good
from adspend.llm.queries import piece_model, table
from adspend.llm.scratch import cut


#: Similarity in per cent at which documents count as near copies.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the trusted texts' model is not beyond their language's quantile."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest doc_id."""
    carry = [c for c in docs.columns if c != "doc_id"]
    return exact_dedup(docs, carry=carry, only_kept=True).select(*(f"`{c}`" for c in docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles alike by 80 % or more), the one with the
    smallest doc_id."""
    return near_dedup(docs, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document left."""
    rows = codec.round_trip(docs.select("doc_id", "text"), piece_model())
    return rows.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece_codec", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{name}")
    return docs
