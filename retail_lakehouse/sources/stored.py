"""Stored layer tables (SS-4, SS-6): versions beside each other, one of them committed, bucketed on request.

A rebuild writes a new version folder and then one commit row; readers take the
version of the latest commit row. So a build that dies leaves the old table
readable, readers never see a half-written one, and a table may be rebuilt from itself.
Single writer per table assumed, as for the run ledger.

A bucketed version is dealt and sorted by its key, and read with that layout:
aggregations and joins on the key need no exchange. A key that holds much of a table
would sit in one bucket, so the largest bucket's size is taken when the table is
written; beyond ``SKEW`` times the mean the version is committed without
its layout, and is read in splits like any other files.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retail_lakehouse.sources.landing import _fs, path_exists

COMMIT_SCHEMA = "sequence long, version string, rows long, bucket_key string, buckets int, schema_ddl string"
CODEC = "zstd"  # half of most tables are hexadecimal hashes, which it stores at half their length
SKEW = 4.0
SMALLEST = 16 * 1024 * 1024  # buckets below this are never a skewed task


@dataclass(frozen=True)
class Commit:
    sequence: int
    version: str
    rows: int
    bucket_key: str | None
    buckets: int | None
    schema_ddl: str


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a table that names none: as many as there are shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _commits(path: str) -> str:
    return f"{path}/_commits"


def _data(path: str, version: str) -> str:
    return f"{path}/version-{version}"


def latest_commit(spark: SparkSession, path: str) -> Commit | None:
    if not path_exists(spark, _commits(path)):
        return None
    row = spark.read.schema(COMMIT_SCHEMA).parquet(_commits(path)).orderBy(F.desc("sequence")).first()
    return Commit(**row.asDict()) if row else None


def _table_name(version: str) -> str:
    return f"stored_{version}"


def bucket_sizes(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of each bucket file of a version."""
    fs, where = _fs(spark, folder)
    return [f.getLen() for f in fs.listStatus(where) if f.getPath().getName().startswith("part-")]


def even(sizes: list[int], buckets: int) -> bool:
    """Whether no bucket is a skewed task."""
    largest = max(sizes, default=0)
    return largest <= SMALLEST or largest <= SKEW * sum(sizes) / buckets


def write_layer(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), bucket_by: str | None = None,
                buckets: int | None = None, dealt: bool = False) -> int:
    """Full rebuild of a layer table: ``df`` (which may read the table itself) becomes the next
    version of the table at ``path``. Returns the rows written, counted in the same job.
    ``bucket_by``: deal by this column, into as many buckets as there are shuffle partitions;
    ``dealt``: the rows already lie so."""
    spark, version, obs = df.sparkSession, uuid.uuid4().hex, Observation()
    before = latest_commit(spark, path)
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    layout = False
    if bucket_by:
        n = buckets or bucket_count(spark)
        # Dealt by the buckets' own hash, so each task writes one bucket as one file.
        (counted if dealt else counted.repartition(n, F.col(bucket_by))).write.bucketBy(n, bucket_by).sortBy(bucket_by).option(
            "path", _data(path, version)).option("compression", CODEC).saveAsTable(_table_name(version))
        layout = even(bucket_sizes(spark, _data(path, version)), n)
    else:
        writer = counted.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(_data(path, version), compression=CODEC)
    rows = int(obs.get["rows"])
    commit = (before.sequence + 1 if before else 0, version, rows, bucket_by if layout else None, n if layout else None,
              df.schema.toDDL())
    spark.createDataFrame([commit], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(_commits(path))
    if before:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(before.version)}")
    return rows


def read_table(spark: SparkSession, layer_root: str, name: str) -> DataFrame:
    """The committed version of a layer table, with its layout."""
    path = f"{layer_root}/{name}"
    commit = latest_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no version of {path} has been committed")
    if commit.bucket_key is None:
        return spark.read.parquet(_data(path, commit.version))
    table, key = _table_name(commit.version), commit.bucket_key.replace("`", "``")
    # The catalog entry is the only place where Spark keeps a layout; another session makes its own.
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({commit.schema_ddl}) USING parquet CLUSTERED BY (`{key}`) "
              f"SORTED BY (`{key}`) INTO {commit.buckets} BUCKETS LOCATION '{_data(path, commit.version)}'")
    return spark.table(table)


def layout_of(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(key, buckets) that the committed version is dealt by, if any."""
    commit = latest_commit(spark, path)
    return (commit.bucket_key, commit.buckets) if commit and commit.bucket_key else None


def drop_layer(spark: SparkSession, path: str) -> None:
    """Take the committed version of a layer table, if any, out of the catalog; its files are the caller's."""
    commit = latest_commit(spark, path)
    if commit is not None and commit.bucket_key is not None:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(commit.version)}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all versions but the ``keep`` last committed ones, unfinished ones
    included; call it when no reader of them is left. Returns how many went."""
    if not path_exists(spark, _commits(path)):
        return 0
    rows = spark.read.schema(COMMIT_SCHEMA).parquet(_commits(path)).orderBy(F.desc("sequence")).limit(keep).collect()
    kept = {f"version-{r['version']}" for r in rows}
    fs, where = _fs(spark, path)
    old = [f.getPath() for f in fs.listStatus(where) if f.getPath().getName().startswith("version-") and f.getPath().getName() not in kept]
    for folder in old:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder.getName().removeprefix('version-'))}")
        fs.delete(folder, True)
    return len(old)
