"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that works on all rows its
predecessor kept. All but the last return the columns of ``documents``. ``run`` writes every
stage's rows as Parquet in the shared folder and rereads them as the next stage's documents,
so a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgate.llm import bpe, dart_minhash, decontaminate, pii, quality
from sparkgate.llm.common import table
from sparkgate.session import materialize

BPE_VOCABULARY = "byte_bpe_50k.tiktoken"
#: Key of the surrogates in the registered query; a real run takes its own secret.
PII_KEY = b"registered query"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate class."""
    return dart_minhash.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts and their lengths measured anew."""
    out = pii.pseudonymize(docs, PII_KEY)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    import public_tokenizers
    ranks = bpe.read_ranks(public_tokenizers.path(BPE_VOCABULARY))
    return bpe.digests(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pseudonyms),
    ("bpe", tokens),
]

#: Trained weights, signatures and keyed draws are beyond SQL; tests hold the rows against
#: brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
