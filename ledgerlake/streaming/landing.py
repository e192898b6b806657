"""Incremental bronze landing of scheduled CSV extracts (Structured Streaming).

Each dataset's landing folder is a streaming file source with the explicit
all-string schema. Every record is parsed in full: one with too many or too
few fields is kept as text, a file whose header names other columns, or in
another order, stops the stream. A micro-batch is stamped with lineage (batch
time, source file from the scan metadata) and written by one job to a folder
of its own number, accepted and rejected records side by side; a marker with
that number then commits both. A batch that is repeated after a crash
overwrites its folder, and readers see no batch without its marker, so every
line of every file is there exactly once, in one of the two outputs. The
checkpoint (under the shared folder) records which files were landed.

``trigger(availableNow=True)`` processes whatever has arrived and stops:
the streaming equivalent of the nightly batch load, without re-reading
files that were already landed.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import shared_dir
from ledgerlake.sources.csv_loader import ACCEPTED, REJECTED, judged, record_reader, stored_schema
from ledgerlake.sources.schemas import RAW_COLUMNS, SOURCE_FILES


def extract_stream(spark: SparkSession, dataset: str, landing_dir: str) -> DataFrame:
    """Streaming frame of all records in one dataset's landing folder, each with its outcome."""
    # Bound the work per micro-batch so a backlog is split into batches.
    reader = record_reader(spark.readStream, dataset).option("maxFilesPerTrigger", 1000)
    return judged(reader.csv(os.path.join(landing_dir, SOURCE_FILES[dataset])))


def _default_root(spark: SparkSession, bronze_dir: str) -> str:
    """Progress folder of the streams into ``bronze_dir``: the same in every
    application, so that a restarted driver goes on where the last one was."""
    return os.path.join(shared_dir(spark), "landing", hashlib.sha256(bronze_dir.rstrip("/").encode()).hexdigest()[:16])


def _batch_dir(bronze_dir: str, dataset: str) -> str:
    return os.path.join(bronze_dir, dataset, "batches")


def _marker(spark: SparkSession, bronze_dir: str, dataset: str, batch: str = ""):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(bronze_dir, dataset, "committed", batch).rstrip("/"))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _commit(bronze_dir: str, dataset: str):
    def write(rows: DataFrame, batch: int) -> None:
        folder = os.path.join(_batch_dir(bronze_dir, dataset), f"batch={batch}")
        rows.write.mode("overwrite").partitionBy("outcome").parquet(folder)
        fs, path = _marker(rows.sparkSession, bronze_dir, dataset, str(batch))
        fs.create(path, True).close()

    return write


def land_dataset(spark: SparkSession, dataset: str, landing_dir: str, bronze_dir: str,
                 checkpoint: str | None = None):
    """Start an availableNow stream landing one dataset; returns the query."""
    ckpt = checkpoint or os.path.join(_default_root(spark, bronze_dir), dataset)
    return (
        extract_stream(spark, dataset, landing_dir)
        .writeStream.foreachBatch(_commit(bronze_dir, dataset))
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )


def land_all(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_root: str | None = None) -> dict:
    """Land every dataset (one stream each, run concurrently) and wait."""
    root = checkpoint_root or _default_root(spark, bronze_dir)
    queries = {
        ds: land_dataset(spark, ds, landing_dir, bronze_dir, os.path.join(root, ds)) for ds in RAW_COLUMNS
    }
    for q in queries.values():
        q.awaitTermination()
    return queries


def committed_batches(spark: SparkSession, bronze_dir: str, dataset: str) -> list[int]:
    fs, path = _marker(spark, bronze_dir, dataset)
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path)) if fs.exists(path) else []


def _landed(spark: SparkSession, bronze_dir: str, dataset: str, outcome: str) -> DataFrame:
    schema = T.StructType([*stored_schema(dataset).fields, T.StructField("batch", T.LongType())])
    done = committed_batches(spark, bronze_dir, dataset)
    if not done:
        return spark.createDataFrame([], schema).drop("batch", "outcome")
    # Batches are numbered in order; each starts when the one before it is committed.
    rows = spark.read.schema(schema).parquet(_batch_dir(bronze_dir, dataset))
    return rows.filter((F.col("batch") <= done[-1]) & (F.col("outcome") == outcome)).drop("batch", "outcome")


def read_bronze(spark: SparkSession, bronze_dir: str, dataset: str) -> DataFrame:
    """Accepted records of the committed batches: all-string columns and lineage."""
    return _landed(spark, bronze_dir, dataset, ACCEPTED).drop("record")


def read_rejects(spark: SparkSession, bronze_dir: str, dataset: str) -> DataFrame:
    """Malformed records of the committed batches: table name, file, load time and the record's text."""
    rows = _landed(spark, bronze_dir, dataset, REJECTED)
    return rows.select(F.lit(dataset).alias("table_name"), "source_file", "load_timestamp", "record")
