"""Row-level operators: deterministic deduplication, latest version, semi join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def latest_version(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per ``key`` under ``order`` (``row_number() = 1``).

    NULL keys form one group, as in SQL windows. Catalyst adds a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key is cut down to one row
    per map task before it is exchanged.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return (
        df.withColumn("_version", F.row_number().over(w))
        .where(F.col("_version") == 1)
        .drop("_version")
    )


def dedupe_rows(df: DataFrame, key: str = "_row_hash",
                order: Sequence[Column | str] = ("_batch_date", "_source_file")) -> DataFrame:
    """One row per content hash; the earliest landing (batch date, then file)
    survives, so repeated loads keep the first ``_batch_date``."""
    return latest_version(df, key, list(order))


def left_semi(df: DataFrame, keys: DataFrame, left_on: str, right_on: str | None = None,
              null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``left_on`` appears in ``keys``; ``null_safe``
    makes NULL match NULL (``<=>``)."""
    right_on = right_on or left_on
    k = keys.select(F.col(right_on).alias("_semi_key"))
    cond = df[left_on].eqNullSafe(k["_semi_key"]) if null_safe else df[left_on] == k["_semi_key"]
    return df.join(k, cond, "left_semi")
