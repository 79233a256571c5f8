"""Incremental bronze load with Structured Streaming (SM-1).

Each dataset is a stream of new files under ``<landing>/*/<file>``; the stream's
checkpoint remembers which files were seen, so a run reads only new ones. A
micro-batch names its files (at most ``max_files`` of them), which are loaded
like any other batch: columns bound by each file's header, rows hashed,
deduplicated, merged insert-only, recorded in the file ledger and committed through
the run ledger; a later scan does not parse them again, nor does the stream parse what a scan has loaded.
Deduplication state is the bronze table itself (no watermark: content seen once
is never inserted again).

The batch id follows from the epoch. If the process dies after the ledger's
commit row but before the stream's own commit, the epoch is replayed: its batch
id is found committed and nothing is touched. If it dies before the commit row,
the replay overwrites the invisible partition.

``trigger(availableNow=True)`` processes everything present and stops, which
suits a daily job; with a processing-time trigger the same code runs
continuously. A day file overwritten in place is not read again by the stream;
use the batch scan (``ingest_bronze``) for replays that rewrite folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from retail_lakehouse.plans import ingest as I
from retail_lakehouse.schemas import DATASETS, Dataset
from retail_lakehouse.session import prepare

FILES = "path string, modificationTime timestamp, length long, content binary"


def _file_stream(spark: SparkSession, landing_root: str, ds: Dataset, max_files: int) -> DataFrame:
    """New files of a dataset, by name only (contents are pruned)."""
    return (
        spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files)).load(f"{landing_root}/*/{ds.filename}").select("path")
    )


def merge_epoch(spark: SparkSession, bronze_root: str, ds: Dataset, query_tag: str):
    def merge(batch: DataFrame, epoch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())
        I.ingest_files(spark, bronze_root, ds, paths, f"stream-{query_tag}-{ds.table_name}-{epoch_id}")
    return merge


def stream_bronze(spark: SparkSession, landing_root: str, bronze_root: str, checkpoint_root: str,
                  datasets: Sequence[Dataset] = DATASETS, query_tag: str = "landing", max_files: int = 1000) -> None:
    """Load the files not yet seen by the streams, then stop: one query per
    dataset, all started together. If one fails, the others end their epochs
    and its error is raised. The checkpoint must live on shared storage."""
    prepare(spark)
    queries = [
        _file_stream(spark, landing_root, ds, max_files)
        .writeStream.foreachBatch(merge_epoch(spark, bronze_root, ds, query_tag))
        .option("checkpointLocation", f"{checkpoint_root}/{ds.table_name}")
        .trigger(availableNow=True)
        .start()
        for ds in datasets
    ]
    failed = []
    for q in queries:
        try:
            q.awaitTermination()
        except StreamingQueryException as error:
            failed.append(error)
    if failed:
        raise failed[0]
