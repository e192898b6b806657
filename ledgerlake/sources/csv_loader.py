"""Bronze ingestion: scheduled CSV extracts -> all-string raw frames.

``load_raw_csv`` reads one extract with an explicit all-string schema (no
inference), header skipped, empty fields kept as NULL. Unlike the
reference's plain comma split, quoted fields are honoured, so an address
such as ``"1 King St, Toronto"`` stays in its column (deliberate deviation:
the plain split shifts every later column).

``lineage_enrich`` appends ``load_timestamp`` and ``source_file``.

``replace_raw`` is the load proper: each extract becomes a stored table
(``TableStore``) that replaces the one before it as a whole. One pass parses
the extract, writes the well-formed records beside the malformed ones and
counts both.
``write_extracts`` is the matching sink (used to land test extracts).
"""

from __future__ import annotations

import os

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.schemas import RAW_COLUMNS, SOURCE_FILES, raw_schema
from ledgerlake.sources.stored import TableStore

CSV_READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "multiLine": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # KEEPNULLS: an empty field is NULL.
    "nullValue": "",
    "emptyValue": "",
}


CORRUPT = "_corrupt_record"


def record_reader(reader, dataset: str):
    """A batch or stream reader set to parse every record of an extract; one
    with too many or too few fields, or with unbalanced quotes, has its text
    in ``_corrupt_record``."""
    reader = reader.schema(T.StructType([*raw_schema(dataset).fields, T.StructField(CORRUPT, T.StringType())]))
    for k, v in CSV_READ_OPTIONS.items():
        reader = reader.option(k, v)
    # Every field is parsed, whatever a query selects, so that a record is
    # judged as a whole.
    reader = reader.option("columnPruning", "false")
    # A file whose header names other columns, or in another order, is an error.
    return reader.option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", "false")


def _read(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    return record_reader(spark.read, dataset).csv(path)


def _fields(dataset: str):
    """Always true. Spark refuses a query on the corrupt column alone (a bare
    count, say), so the fields go along."""
    return F.length(F.concat_ws("", *RAW_COLUMNS[dataset])) >= 0


def load_raw_csv(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """Load one raw extract (file or folder of part files) as all-string:
    the well-formed records. ``rejected_records`` has all others."""
    df = _read(spark, dataset, path)
    return df.filter(F.col(CORRUPT).isNull() & _fields(dataset)).drop(CORRUPT)


def rejected_records(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """The malformed records of an extract: table name, file, the record's text."""
    df = _read(spark, dataset, path).select("*", F.col("_metadata.file_path").alias("source_path"))
    df = df.filter(F.col(CORRUPT).isNotNull() & _fields(dataset))
    return df.select(F.lit(dataset).alias("table_name"), "source_path", F.col(CORRUPT).alias("record"))


def lineage_enrich(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Append load time and source file name (from the scan's file metadata
    when no literal name is given)."""
    if source_file is None:
        # The extract's name: the file itself, or the folder of part files
        # a distributed writer produced for it.
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.csv)(/[^/]*)?$", 1)
    else:
        name = F.lit(source_file)
    return df.withColumn("load_timestamp", F.current_timestamp()).withColumn("source_file", name)


ACCEPTED, REJECTED = "accepted", "rejected"


def judged(records: DataFrame) -> DataFrame:
    """Parsed records with lineage, ``record`` (the text of a malformed one)
    and ``outcome``: every line of the extract, accepted or rejected."""
    out = lineage_enrich(records)
    outcome = F.when(F.col("record").isNull(), ACCEPTED).otherwise(REJECTED)
    return out.withColumnRenamed(CORRUPT, "record").withColumn("outcome", outcome)


def stored_schema(dataset: str) -> T.StructType:
    return T.StructType([*raw_schema(dataset).fields, T.StructField("record", T.StringType()),
                         T.StructField("load_timestamp", T.TimestampType()), T.StructField("source_file", T.StringType()),
                         T.StructField("outcome", T.StringType())])


def replace_raw(store: TableStore, base_path: str, datasets: list[str] | None = None, parallel: int = 8) -> dict[str, dict]:
    """Load extracts into stored raw tables, each replacing its last load;
    returns the lines, accepted and rejected records of each.

    The counts are observed while the records are written, so they are those
    of the rows that are stored, and no second pass parses the extract.
    """
    def load(ds: str) -> dict:
        seen = Observation()
        rows = judged(_read(store.spark, ds, extract_path(base_path, ds)))
        counted = [F.count_if(F.col("outcome") == o).alias(f"{o}_rows") for o in (ACCEPTED, REJECTED)]
        rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), *counted)
        version = store.replace(ds, rows, ("outcome",))
        return {**seen.get, "version": version}

    names = list(datasets or RAW_COLUMNS)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(zip(names, pool.map(load, names)))


def stored_raw(store: TableStore, dataset: str, version: str | None = None) -> DataFrame:
    """The accepted records of a stored raw table: all-string columns and lineage."""
    rows = store.read(dataset, stored_schema(dataset), version)
    return rows.filter(F.col("outcome") == ACCEPTED).drop("record", "outcome")


def stored_rejects(store: TableStore, dataset: str, version: str | None = None) -> DataFrame:
    """The malformed records of a stored raw table: its name, the file, the record's text."""
    rows = store.read(dataset, stored_schema(dataset), version).filter(F.col("outcome") == REJECTED)
    return rows.select(F.lit(dataset).alias("table_name"), "source_file", "load_timestamp", "record")


def extract_path(base_path: str, dataset: str) -> str:
    return os.path.join(base_path, SOURCE_FILES[dataset])


def load_all_raw(spark: SparkSession, base_path: str, with_lineage: bool = True) -> dict[str, DataFrame]:
    """Run the loader for all eight datasets (dataset -> extract file map)."""
    out = {}
    for ds in RAW_COLUMNS:
        df = load_raw_csv(spark, ds, extract_path(base_path, ds))
        out[ds] = lineage_enrich(df) if with_lineage else df
    return out


def write_extracts(frames: dict[str, DataFrame], base_path: str, compression: str = "none") -> dict[str, str]:
    """Write raw frames as CSV extracts (one folder per extract file name).

    Values are written verbatim: blanks are not trimmed, empty text and NULL
    both become an empty field (the loader reads them back as NULL), and
    fields containing the separator are quoted. ``compression`` is one that
    the CSV reader knows by the file's name (gzip, say).
    """
    paths = {}
    for ds, df in frames.items():
        p = extract_path(base_path, ds)
        (
            df.select(*RAW_COLUMNS[ds])
            .write.mode("overwrite")
            .option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .option("nullValue", "")
            .option("emptyValue", "")
            .option("quoteAll", "false")
            .option("compression", compression)
            .csv(p)
        )
        paths[ds] = p
    return paths
