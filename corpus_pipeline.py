"""A corpus pipeline: toxic documents go, near copies go, sources are mixed, texts become ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadvane.llm import bpe, jaccard, mixing, toxicity
from loadvane.llm.common import store, table
from loadvane.llm.queries import RANKS, SOURCE_WEIGHTS, TOXIC_SCORE, train_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity is below the bound of the toxicity query.

    Null and empty texts are scored as empty ones and stay; equal rows stay or go together.
    """
    model = train_toxicity(spark, sf_dir)
    # the row travels as one column, so that no name of it meets one of the score
    scored = toxicity.score(docs, model, {"row": F.struct(*docs.columns)})
    return scored.where(F.col("score") < TOXIC_SCORE).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near copies."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it, sources weighing 3, 1, 2, ...

    The null source is one source; a document without words is never taken in part, and a source
    without words not at all.
    """
    weights = mixing.cyclic_weights(docs.select("source").distinct(), SOURCE_WEIGHTS)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "source")
    return mixing.repeated(mixing.mix(rows, weights, share=1.5, max_epochs=2.0)).select("row.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its ids as one array, their number, and digests of them and of their bytes.

    Null and empty texts have no ids; every row gives one row.
    """
    return bpe.digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: Toxicity learns a classifier and the join is randomised: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
