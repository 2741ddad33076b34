"""Documents to token ids: language ID, exact dedup, n-gram Jaccard join, mixing to target weights, BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. Empty tables pass through
every stage; nulls, ties and repeated rows have the results that the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import bpe, exact_dedup, langid, mixing, ngram_join
from finlake.llm.common import cut, importable, table
from finlake.llm.queries import VOCABULARY

#: Posterior share below which no language is accepted.
MIN_SCORE = 0.3
#: Near copies: percent of the shingles, and words in a shingle. op7_ngram_join has its own.
NEAR, WORDS = 80, 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and texts that no language explains, go."""
    importable(spark)
    labelled = langid.predict(docs, langid.train(docs))
    return labelled.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).drop("lang_pred", "score")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    importable(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the first stays. Texts link from a Jaccard similarity of NEAR on WORDS-word shingles."""
    importable(spark)
    return ngram_join.one_of_each(docs, percent=NEAR, words=WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each row is one taking of a document, or of the run of its words that is taken equally often."""
    importable(spark)
    return mixing.mix_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, one row per row of the mix."""
    importable(spark)
    return bpe.encode_texts(docs.select("doc_id", "source", "text"), VOCABULARY, keep_ids=False)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: The stages learn, draw and tokenize; SQL can't express them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
