"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lakehouse.session import ensure_checkpoint_dir, materialize

__all__ = ["text_table", "materialize", "shared_path", "crc32_fold", "buckets_for"]

# The word separators of the contracts: space and the five ASCII controls 09-0D.
ASCII_SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def text_table(df: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """``columns`` of ``df`` with the text column's nulls read as ''. Selecting
    by name leaves any further columns of the input out of the operator."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c == text else F.col(c) for c in columns])


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def crc32_fold(doc_id, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null ids fold as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def buckets_for(rows: int, rows_per_bucket: int) -> int:
    """How many buckets keep each near ``rows_per_bucket`` rows."""
    return max(1, -(-rows // rows_per_bucket))


def hash_cut(wanted: float, rows: int) -> int:
    """The 64-bit hash under which about ``wanted`` of ``rows`` distinct ids lie."""
    return int(-2 ** 63 + min(1.0, wanted / max(1, rows)) * (2 ** 64 - 1025))


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, or that with as many underscores as it takes not to be among ``columns`` (in any case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A stable copy of ``docs`` with a number per row, so that rows alike in
    every column can still be told apart by later joins; and the number's column, a new one."""
    name = free_name(docs.columns, "row__")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def located(docs: DataFrame) -> tuple[DataFrame, str]:
    """The same for rows as they lie in stored Parquet (columns may be added, rows
    left out, none repeated): a row is told apart by its file (128 bits of
    its name) and its place there, without a copy. Anything else is copied."""
    name, file = free_name(docs.columns, "row__"), F.col("_metadata.file_path")
    place = F.struct(F.xxhash64(file).alias("a"), F.xxhash64(file, F.lit("b")).alias("b"), F.col("_metadata.row_index").alias("at"))
    try:
        return (docs.select("*", place.alias(name)), name) if "_metadata" not in docs.columns else numbered(docs)
    except AnalysisException:  # not read from files
        return numbered(docs)
