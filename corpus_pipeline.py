"""From raw documents to packed training windows, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet in the folder that ``spark.checkpoint.dir`` names and
hands the table to the next one.  Every stage works on all that its
predecessor kept, and all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinlink.llm import iforest_rules, kk_packing, mixing, secret_tokens, simhash_anchor
from kinlink.llm.common import table
from kinlink.llm.queries import PACK_VOCABULARY, SECRET_VOCABULARY, labelled_domains
from kinlink.session import materialize

#: Share of all tokens that each labelled domain shall have after mixing.  The
#: rules have taken most poor documents before; good ones keep rates of 1 or more.
TARGETS = {"good": 0.955, "good_toxic": 0.04, "poor": 0.004, "poor_toxic": 0.001}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return iforest_rules.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_anchor.keep_one(docs, shingle=4, max_bits=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_tokens.redact(docs, SECRET_VOCABULARY)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their rates say; good domains are raised, others lowered."""
    return mixing.mix(docs, labelled_domains(spark, sf_dir), TARGETS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 4096 token ids."""
    return kk_packing.pack(docs, PACK_VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix_domains", mix_domains),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return docs


#: Stages learn models and cut texts into token ids, which SQL cannot express.
ORACLE_SQL = None
