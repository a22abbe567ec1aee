"""From raw documents to token ids: five stages, each on all that the one before it kept.

Stages take ``(spark, docs, sf_dir)``; what a stage returns is written as Parquet and read again as the next one's
documents. All but the last return the columns of ``documents``. SQL can express neither the repeated passages nor the
encoding, so there is no SQL for the whole; the tests compare it with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, common, decontaminate, jaccard, quality_rules, suffix_dedup
from tributary.llm.queries import tokenizer


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the ratio of trusted to raw n-grams keep."""
    trusted = common.read(common.start(spark), sf_dir, "labels").where("quality = 1")
    return quality_rules.kept(docs, quality_rules.fit(docs, trusted))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    common.start(spark)
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand anywhere else, too."""
    common.start(spark)
    return suffix_dedup.clean(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of test items; documents that are mostly test items go."""
    items = common.read(common.start(spark), sf_dir, "benchmark")
    return decontaminate.without_items(docs, items)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of the text they decode to."""
    common.start(spark)
    path = tokenizer("byte_bpe_50k.json")
    decoded = bpe.decode(bpe.encode(docs, path), path)
    return bpe.digests(decoded, F.col("ids"))


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(common.start(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.Staged(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return docs
