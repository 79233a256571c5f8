"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so (``CHUNK``), so an insertion moves
only the cuts beside it. Every distinct chunk crosses the network once per map
task, into the chunk store, where identifiers are verified: two different
chunks with one identifier make the run start again with the next seed. A
document is then its ordered list of identifiers, and documents are grouped by
that list (and, as the exact check, by the text's sha256): long texts are not
moved to compare them.

Copies of one text may hold a third of all rows: chunks and recipes are
combined in the map tasks before they are shuffled, and the group's row meets
its members in a join that Spark may split.

Defined results: null text counts as ''; all empty texts are one group (of the
empty recipe); of rows equal in text and doc_id one is kept; a null doc_id is
smaller than any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import located, materialize, numbered, text_table

# A chunk ends after a sentence or line end that comes before a character other
# than the first half of the alphabet, 256 characters on at least, 4096 at most.
CHUNK = r"(?s).{256,4094}?[.!?\n]\s?(?=[^A-Ma-m])|.{1,4096}"


def chunks(text):
    """The chunks of a text column, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def chunk_id(chunk, seed: int):
    """128 bits of content hash."""
    return F.struct(F.xxhash64(F.lit(f"{seed}a"), chunk).alias("a"), F.xxhash64(F.lit(f"{seed}b"), chunk).alias("b"))


def chunk_store(docs: DataFrame, seed: int) -> DataFrame:
    """Every distinct chunk of ``docs`` (with ``text``) once: (id, chunk, uses)."""
    each = text_table(docs, "text").select(F.explode(chunks(F.col("text"))).alias("chunk"))
    return each.groupBy(chunk_id(F.col("chunk"), seed).alias("id"), "chunk").agg(F.count(F.lit(1)).alias("uses"))


def verified_seed(docs: DataFrame, attempts: int = 8) -> int:
    """The first seed under which no two different chunks share an identifier."""
    for seed in range(attempts):
        shared = chunk_store(docs, seed).groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if shared.isEmpty():
            return seed
    raise RuntimeError(f"chunk identifiers collide under {attempts} seeds")


def recipes(docs: DataFrame, seed: int, row: str | None = None) -> DataFrame:
    """(doc_id, row__, recipe, text_sha256) of ``docs``; ``row`` names a column
    that tells its rows apart, otherwise they are numbered here."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", number.alias("row__"), F.transform(chunks(text), lambda c: chunk_id(c, seed)).alias("recipe"),
                       F.sha2(text, 256).alias("text_sha256"))


def exact_copies(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc_id, row__, keep_id, group_size, kept, text_sha256)."""
    table = materialize(recipes(docs, verified_seed(docs), row), "recipes")
    groups = table.groupBy("recipe", "text_sha256").agg(
        F.max(F.struct("doc_id", "row__")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return table.join(groups, ["recipe", "text_sha256"]).select(
        "doc_id", "row__", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row__") == F.col("best.row__")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, stored: bool = False) -> DataFrame:
    """``docs`` without the rows that are exact copies of a row that stays.
    ``stored``: ``docs`` reads Parquet files and nothing else, so its rows need no copy to be told apart."""
    rows, row = located(docs) if stored else numbered(docs)
    kept = exact_copies(rows, row).filter("kept").select(F.col("row__").alias(row))
    # Most rows are kept: a sort-merge join at every size.
    return rows.join(kept.hint("merge"), row, "left_semi").drop(row)
