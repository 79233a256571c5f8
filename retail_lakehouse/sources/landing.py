"""Landing area (daily CSV folders): SS-1 … SS-5, SS-7, IN-4, IN-9.

Layout: ``<landing>/<YYYY-MM-DD>/<dataset file>`` where the dataset file is a
CSV file or a folder of CSV part files (what ``write_daily_slice`` writes).
"""

from __future__ import annotations

import csv
import hashlib
import io
import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retail_lakehouse.schemas import BY_FILE, BY_TABLE, DATASETS, Dataset
from retail_lakehouse.session import prepare

BATCH_DATE_PATTERN = r"/(\d{4}-\d{2}-\d{2})/"

# Quoted fields may hold newlines and doubled quotes (RFC 4180).
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "encoding": "UTF-8"}
HASH_BLOCK = 4 * 1024 * 1024
FILE_FACTS = "source_file string, sha256 string, bytes long, header array<string>, multiline boolean"


def _dataset(d: Dataset | str) -> Dataset:
    if isinstance(d, Dataset):
        return d
    return BY_TABLE.get(d) or BY_FILE[d]


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def line_end_in_quotes(block: bytes, quotes: int) -> tuple[bool, int]:
    """Whether a line ends inside a quoted field of ``block`` (a doubled quote counts
    twice and changes nothing), given the quotes before it; and the quotes up to its end."""
    if b'"' not in block:
        return quotes % 2 == 1 and (b"\n" in block or b"\r" in block), quotes
    data = np.frombuffer(block, dtype=np.uint8)
    before = quotes + np.cumsum(data == ord('"'))
    ends = (data == ord("\n")) | (data == ord("\r"))
    return bool((before[ends] % 2 == 1).any()), int(before[-1])


def unzipped(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The contents of a gzip file's blocks, by blocks of at most ``HASH_BLOCK``."""
    z = zlib.decompressobj(31)
    for block in blocks:
        while block:
            if z.eof:  # a further member of the file
                z = zlib.decompressobj(31)
            if out := z.decompress(block, HASH_BLOCK):
                yield out
            block = z.unused_data if z.eof else z.unconsumed_tail
    while not z.eof and (out := z.decompress(b"", HASH_BLOCK)):
        yield out


def file_facts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file under ``path`` (file, folder, glob or several): its name
    as the CSV reader reports it, the sha256 of its bytes, its size, the CSV
    header and whether a quoted field goes over a line's end (of a ``.gz`` file's contents). The listing reads no contents; each file is then read in blocks by
    the task that hashes it, so no file is ever held whole."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_paths(path)) \
        .select(F.col("_metadata.file_path").alias("source_file"), "path", "length")

    def read(batches):
        for batch in batches:
            rows = []
            for name, place, length in zip(*(c.to_pylist() for c in batch.columns)):
                place = place.replace("file:/", "file:///", 1) if place.startswith("file:/") and not place.startswith("file://") else place
                fs, inside = pafs.FileSystem.from_uri(place) if "://" in place else (pafs.LocalFileSystem(), place)
                digest, head, quotes, spans = hashlib.sha256(), b"", 0, False
                with fs.open_input_stream(inside, compression=None) as stream:
                    def stored(stream=stream, digest=digest):
                        while block := stream.read(HASH_BLOCK):
                            digest.update(block)
                            yield block

                    for block in unzipped(stored()) if place.endswith(".gz") else stored():
                        head = head or block
                        if not spans:
                            spans, quotes = line_end_in_quotes(block, quotes)
                header = next(csv.reader(io.StringIO(head.decode("utf-8-sig", "ignore"), newline="")), [])
                rows.append((name, digest.hexdigest(), length, header, spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.bool_()))],
                names=["source_file", "sha256", "bytes", "header", "multiline"])

    return files.mapInArrow(read, FILE_FACTS)


def read_landing_csv(spark: SparkSession, path: str | Sequence[str], dataset: Dataset | str,
                     facts: DataFrame | None = None) -> DataFrame:
    """Read landing CSV as the dataset's all-string columns, bound by each
    file's own header: order does not matter, further columns are ignored, and
    a column the file lacks is blank. A blank value is the empty string,
    whichever way it is written. ``_source_file`` names the row's file.

    ``facts`` are the ``file_facts`` of the files under ``path`` (found if not
    given). Files of one header, the usual case, are read without a join; the
    distinct headers that come to the driver are few. A file's first line is its
    header. Files are read in splits, unless a quoted field of one goes over a line's end: then
    a file is one task.
    """
    ds = _dataset(dataset)
    facts = facts if facts is not None else file_facts(spark, path)
    found = facts.groupBy("header").agg(F.bool_or("multiline").alias("multiline")).collect()
    kinds = [list(r["header"]) for r in found]
    width = max([len(h) for h in kinds], default=0)
    if not width:
        return spark.createDataFrame([], ds.schema.add("_source_file", "string"))
    reader = spark.read.schema(", ".join(f"_c{i} string" for i in range(width))).option("recursiveFileLookup", "true")
    for k, v in (CSV_OPTIONS | {"multiLine": str(any(r["multiline"] for r in found)).lower()}).items():
        reader = reader.option(k, v)
    raw = reader.csv(_paths(path)).select(F.col("_metadata.file_path").alias("_source_file"),
                                          F.array(*[F.coalesce(f"_c{i}", F.lit("")) for i in range(width)]).alias("_v"))
    if len(kinds) == 1:
        bound = raw.withColumn("_h", F.array(*[F.lit(n) for n in kinds[0]]))
    else:
        bound = raw.join(facts.select(F.col("source_file").alias("_source_file"), F.col("header").alias("_h")), "_source_file")
    return bound.select(
        *[F.coalesce(F.get("_v", F.array_position("_h", n).cast("int") - 1), F.lit("")).alias(n) for n in ds.columns], "_source_file")


def with_provenance(df: DataFrame) -> DataFrame:
    """``_source_file`` (full path, as read), ``_batch_date`` (the day folder)
    and ``_ingested_at``."""
    return (
        df.withColumn("_batch_date", F.regexp_extract("_source_file", BATCH_DATE_PATTERN, 1).try_cast("date"))
        .withColumn("_ingested_at", F.current_timestamp())
    )


def read_landing(spark: SparkSession, landing_root: str, dataset: Dataset | str,
                 batch_date: date | str | None = None) -> DataFrame:
    """One dataset over every day folder (or one day), with provenance."""
    prepare(spark)
    ds = _dataset(dataset)
    day = "*" if batch_date is None else str(batch_date)
    return with_provenance(read_landing_csv(spark, f"{landing_root}/{day}/{ds.filename}", ds))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def drop_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def missing_files(spark: SparkSession, batch_dir: str) -> list[str]:
    """Dataset files absent from one day folder (nine lookups on the file
    system; no data is read)."""
    return [d.filename for d in DATASETS if not path_exists(spark, f"{batch_dir}/{d.filename}")]


def source_summary(spark: SparkSession, source_dir: str) -> dict:
    """Orders count, first and last purchase date and missing files of a
    source folder. Raises when the orders file is missing or empty, or when any
    purchase timestamp is blank or malformed."""
    from retail_lakehouse.operators.slice import SourceDataError, bad_purchase_times, orders_summary

    orders_file = f"{source_dir}/{BY_TABLE['olist_orders'].filename}"
    if not path_exists(spark, orders_file):
        raise SourceDataError(f"Missing source file: {orders_file}")
    orders = read_landing_csv(spark, orders_file, "olist_orders")
    bad = Observation()
    row = orders_summary(orders.observe(bad, bad_purchase_times().alias("bad")), strict=False).first()
    if bad.get["bad"]:
        raise SourceDataError(f"Orders contain {bad.get['bad']} invalid purchase timestamps.")
    if row is None or row["orders"] == 0:
        raise SourceDataError("The orders source file is empty.")
    return {
        "orders": row["orders"],
        "first_order_date": row["first_order_date"],
        "last_order_date": row["last_order_date"],
        "missing_files": missing_files(spark, source_dir),
    }


# Rows of a part of a compressed landing file, which is read by one task.
ROWS_PER_PART = 1_000_000


def write_csv_counted(df: DataFrame, path: str, compression: str | None = None) -> int:
    """Write CSV with header (quotes doubled) and return the row count from
    the same job (``observe``), not a second pass. ``compression``: of the part files, ``gzip``."""
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    for k, v in CSV_OPTIONS.items():
        if k != "multiLine":
            writer = writer.option(k, v)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", str(ROWS_PER_PART))
    writer.csv(path)
    return int(obs.get["rows"])


def write_daily_slice(tables: Mapping[str, DataFrame], landing_root: str, batch_date: date | str) -> dict[str, int]:
    """Write the nine slice tables under ``<landing>/<date>/<file>``; return
    rows written per file. A day without orders is an error and leaves no day
    folder; the other eight tables are written as concurrent jobs."""
    from retail_lakehouse.operators.slice import ORDERS, SourceDataError

    day_dir = f"{landing_root}/{batch_date}"
    by_table = {ds.table_name: ds for ds in DATASETS}

    def write(ds: Dataset) -> int:
        return write_csv_counted(tables[ds.table_name].select(*ds.columns), f"{day_dir}/{ds.filename}")

    spark = tables[ORDERS].sparkSession
    existed = path_exists(spark, day_dir)
    counts = {by_table[ORDERS].filename: write(by_table[ORDERS])}
    if not counts[by_table[ORDERS].filename]:
        fs, folder = _fs(spark, day_dir if not existed else f"{day_dir}/{by_table[ORDERS].filename}")
        fs.delete(folder, True)
        raise SourceDataError(f"No orders found for {batch_date}.")
    rest = [ds for ds in DATASETS if ds.table_name != ORDERS]
    with ThreadPoolExecutor(max_workers=4) as pool:
        counts |= dict(zip([ds.filename for ds in rest], pool.map(write, rest)))
    return counts


# --- layers ----------------------------------------------------------------------

def ensure_layers(spark: SparkSession, *schemas: str) -> None:
    for s in schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{s.replace('`', '``')}`")
