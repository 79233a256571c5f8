"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lakehouse.llm import exact_dedup, framefile, interpolated_lm, language_id, learned_ann, mixing, near_join, packing, prefix_trie, source_divergence, suffix_dedup, toxicity, url_lists
from retail_lakehouse.llm.common import crc32_fold, numbered
from retail_lakehouse.session import prepare

# Files of the public vocabularies.
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
SEQUENCE = packing.Capacity(tokens=2048, documents=2048, attention=2048 * 2048)
MIX = mixing.Mix()


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary file is (never copied into the repository)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(BYTE_BPE), SEQUENCE, end_id=0)


def op2_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_texts(documents(spark, sf_dir), crc32_fold(F.col("doc_id"), 5) != 1)


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)  # the derived times are UTC
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_lists.judge(url_lists.captures_of(pages), url_lists.list_of(pages))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir)).drop("row__")


def language_dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Learned from the documents whose fold is not 2."""
    return language_id.learn(docs.where(crc32_fold(F.col("doc_id"), 4) != 2))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", crc32_fold(F.col("doc_id"), 4) == 2)
    return language_id.identify(docs, language_dictionaries(docs), ["doc_id", "held_out"])


def op6_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, row = numbered(documents(spark, sf_dir).select("doc_id", "text"))
    return near_join.near_copies(docs, row=row).drop("row__", "class_row__")


def op7_learned_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cleaned(documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return framefile.token_files(spark, documents(spark, sf_dir), tokenizer_path(WORD_BPE), end_id=2)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir), MIX).drop("row__")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", crc32_fold(F.col("doc_id"), 5) == 0)
    network = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~F.col("held_out"))
    return toxicity.scored(docs, network, ["doc_id", "held_out"])


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergences(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_interpolated_lm": op2_interpolated_lm,
        "op3_url_lists": op3_url_lists,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_language_id": op5_language_id,
        "op6_near_join": op6_near_join,
        "op7_learned_ann": op7_learned_ann,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_token_files": op9_token_files,
        "op10_source_mix": op10_source_mix,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_toxicity": op12_toxicity,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_lists": url_lists.ORACLE,
        "op13_source_divergence": source_divergence.ORACLE,
        "op4_exact_dedup": """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents""",
    }
