"""Language ID by compression: the language whose dictionary compresses a text best.

Each language has a raw-content zstandard dictionary, made of ``SNIPPETS``
snippets of ``SNIPPET_CHARS`` characters from its training documents (those with
the smallest id hashes; a bounded, documented sample, taken from the ids under a cut
computed from the language's count, so what is ranked does not grow with the table). A whole text, reduced to
its lower-case letters with single spaces between words, is encoded in segments
of ``SEGMENT_BYTES`` with every dictionary, so that the dictionary and not the
text's own past explains it; the smallest sum wins. If the runner-up is larger
by less than ``min_margin`` of its size, the decision is rejected.

Defined results: a null text or one without letters is 'und', score 0,
rejected; ties go to the first language in code point order, score 0, rejected;
training documents without language or text teach nothing, of rows with one doc_id
and language the smallest snippet teaches; with no language learned every text is 'und'. Equal rows are predicted alike; an empty table
gives an empty result; columns of the input named like an output give way to it.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import hash_cut
from retail_lakehouse.llm.tokens import slices, strings

SNIPPETS = 600
SAMPLED = SNIPPETS * 1.5  # under the cut; the ids there are random, ten deviations from too few
SNIPPET_CHARS = 200
DICTIONARY_BYTES = SNIPPETS * (SNIPPET_CHARS + 1) * 4  # all snippets, in any script
SEGMENT_BYTES = 700
MIN_MARGIN = 0.002
UNKNOWN = "und"
ADDED = ("lang_pred", "score", "rejected")

_OTHER = r"[^\pL\pM]+"
_LETTER = re.compile(r"[^\W\d_]")
_PARAMETERS = dict(strategy=zstd.STRATEGY_GREEDY, window_log=19, hash_log=17, chain_log=17, search_log=2, min_match=4,
                   write_content_size=False)


def letters_only(texts: pa.Array) -> list[str]:
    """Lower-case letters, one space for everything between them."""
    return [t.strip() for t in strings(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _OTHER, " "))]


def sampled(training: DataFrame) -> DataFrame:
    """(lang, order, doc_id, snippet): about SAMPLED snippets of each language (all, if it has
    fewer), however many rows and tasks there are. To the driver comes a count per language."""
    at = F.pmod(F.xxhash64("doc_id", F.lit("at")), F.greatest(F.length("text") - SNIPPET_CHARS, F.lit(1))) + 1
    known = training.where("lang is not null and text is not null")
    cut = F.lit(None).cast("long")
    for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        cut = F.when(F.col("lang") == r["lang"], F.lit(hash_cut(SAMPLED, r["n"]))).otherwise(cut)
    under = known.select("lang", "doc_id", "text", F.xxhash64("doc_id").alias("order")).where(F.col("order") <= cut)
    return under.groupBy("lang", "order", "doc_id").agg(F.min(F.substring("text", at.cast("int"), F.lit(SNIPPET_CHARS))).alias("snippet"))


def learn(training: DataFrame) -> dict[str, bytes]:
    """Dictionaries by language from ``training`` (doc_id, text, lang). To the
    driver come at most SNIPPETS snippets per language."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    rows = sampled(training).withColumn("rank", rank).where(F.col("rank") <= SNIPPETS).select("lang", "rank", "snippet").collect()
    by_lang: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        by_lang.setdefault(r["lang"], []).append(r["snippet"])
    out = {}
    for lang, texts in by_lang.items():
        content = " ".join(t for t in letters_only(pa.array(texts)) if t).encode()[:DICTIONARY_BYTES]
        if content:
            out[lang] = content
    return out


def compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstd.ZstdCompressor]]:
    parameters = zstd.ZstdCompressionParameters(**_PARAMETERS)
    out = []
    for lang in sorted(dictionaries):
        content = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=parameters)
        out.append((lang, zstd.ZstdCompressor(dict_data=content, compression_params=parameters)))
    return out


def classify(text: str, by_lang: list[tuple[str, zstd.ZstdCompressor]], min_margin: float) -> tuple[str, float, bool]:
    """(language, relative margin, rejected) of a text of letters and spaces."""
    if not by_lang or not _LETTER.search(text):
        return UNKNOWN, 0.0, True
    raw = text.encode()
    parts = [raw[i:i + SEGMENT_BYTES] for i in range(0, len(raw), SEGMENT_BYTES)]
    sizes = sorted((sum(len(c.compress(p)) for p in parts), lang) for lang, c in by_lang)
    if len(sizes) == 1:
        return sizes[0][1], 1.0, False
    margin = 1 - sizes[0][0] / sizes[1][0]
    return sizes[0][1], margin, margin < min_margin or margin == 0


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred, score (relative margin,
    0 to 1) and rejected."""
    kept = [c for c in keep if c not in ADDED]
    # The text comes last under a name of its own, for kept columns may hold it as well.
    name = "text__"
    while name in kept:
        name += "_"
    source = docs.select(*kept, F.col("text").alias(name))
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def predict(batches):
        by_lang = compressors(dictionaries)
        for batch in batches:
            for part in slices(batch, name):
                found = [classify(t, by_lang, min_margin) for t in letters_only(part.column(len(kept)))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                    names=[*kept, *ADDED])

    return source.mapInArrow(predict, schema)
