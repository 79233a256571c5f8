"""A corpus pipeline over ``documents``: each stage is one operator of ``retail_lakehouse.llm``.

Every stage works on all rows that the one before it kept, and but for the last
returns the columns of ``documents`` and any further ones of its input. Null texts count as empty: they
have no language and go in the first stage. A stage's ``docs`` is read from stored Parquet. Its result has to be stored before the
next stage is called: that call deletes the intermediate tables which the result
was made from, so only one stage's tables are on the disk at a time.
"""

from __future__ import annotations

from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from retail_lakehouse.llm import exact_dedup, language_id, mixing, near_join, packing, queries
from retail_lakehouse.llm.common import shared_path
from retail_lakehouse.session import drop_materialized, table_scope

# Intermediate tables of the stage called last in this thread.
_BEFORE: ContextVar[tuple[str, ...]] = ContextVar("before", default=())


def stage(fn):
    """A stage that owns the tables it writes: the next stage deletes them, and it does so itself if it fails."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_materialized(spark, _BEFORE.get())
        _BEFORE.set(())
        with table_scope() as written:
            try:
                out = fn(spark, docs, sf_dir)
            except BaseException:
                drop_materialized(spark, written)
                raise
        _BEFORE.set(tuple(written))
        return out

    return run_stage


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters, or whose decision is rejected, go."""
    found = language_id.identify(docs, queries.language_dictionaries(docs), docs.columns)
    return found.where("not rejected").select(*docs.columns)


@stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: one row of each text stays."""
    return exact_dedup.deduplicated(docs, stored=True)


@stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group of near copies stays."""
    return near_join.without_near_copies(docs)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: each document's text becomes the words the mix takes."""
    return mixing.mixed_documents(docs, queries.MIX)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that is left: one row per piece with its sequence and place."""
    return packing.pack_documents(docs, queries.tokenizer_path(queries.BYTE_BPE), queries.SEQUENCE, end_id=0)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_join", without_near_copies),
    ("source_mix", mixed),
    ("best_fit_packing", packed),
]

# Compression, signatures and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet in
    the shared folder and read again as the next stage's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
