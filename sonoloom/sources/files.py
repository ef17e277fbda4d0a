"""The files of a stored corpus: which can be read in full, and what each holds.

All is read by Spark's own readers, so any store will do: a listing that opens nothing, the row counts of the
footers, and the sizes column. A file counts wholly or not at all.
"""

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from sonoloom.sources import scans

#: Why a file is passed over.
UNREADABLE, DAMAGED, WITHOUT_SIZES = "no readable footer", "damaged data", "no audio_size"


def file_states(spark: SparkSession, root: str, version: int = 0) -> DataFrame:
    """(`file`, `bytes`, `rows`, `corpus`, `language`, `split`, `samples`, `reason`), one row for each file. [S5, S6]

    `rows` is what the footer promises, `samples` the sum of the sizes. `reason` is NULL for a file that counts.
    A file is damaged if fewer rows of its sizes can be read than it promises. Where
    several tasks read one file, their parts are added up before it is judged. Files of no bytes are none: Spark
    lists them nowhere.
    """
    where = f"{root}/version={version}"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    )
    stored = scans.read_corpus(spark, root, skip_corrupt=True, version=version)
    named = stored.select(F.col("_metadata.file_path").alias("file"), "corpus", "language", "split", "audio_size")
    promised = named.groupBy("file").agg(F.count("*").alias("promised"))
    read = named.groupBy("file", "corpus", "language", "split").agg(
        F.count(F.struct("audio_size")).alias("read"), F.count("audio_size").alias("known"), F.sum("audio_size").alias("samples")
    )
    parts = listed.unionByName(promised, allowMissingColumns=True).unionByName(read, allowMissingColumns=True)
    rows = parts.groupBy("file").agg(*(F.max(c).alias(c) for c in parts.columns if c != "file"))
    reason = (
        F.when(F.col("promised").isNull(), UNREADABLE)
        .when(F.coalesce("read", F.lit(0)) < F.col("promised"), DAMAGED)
        .when(F.col("known") == 0, WITHOUT_SIZES)
    )
    return rows.select(
        "file", "bytes", F.col("promised").alias("rows"), "corpus", "language", "split", "samples", reason.alias("reason")
    )


def skipped_files(spark: SparkSession, root: str, version: int = 0) -> DataFrame:
    """(`file`, `reason`, `rows`) of the files that a report with `skip_corrupt` passes over. [S5]"""
    return file_states(spark, root, version).where("reason is not null").select("file", "reason", "rows")


def _row_of(store: fs.FileSystem, name: str, row: int, column: str) -> pa.Array:
    """One cell of a Parquet file: the footer tells the row group, of which one column is read."""
    with store.open_input_file(name) as handle:
        file = pq.ParquetFile(handle)
        if column not in file.schema_arrow.names:
            raise ValueError(f"no column {column!r} in {name}")
        first = 0
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            if row < first + rows:
                return file.read_row_group(group, columns=[column]).column(0).slice(row - first, 1).combine_chunks()
            first += rows
        raise IndexError(f"no row {row} in {name}, which has {first}")


def lookup_row(spark: SparkSession, path: str, row: int, column: str) -> DataFrame:
    """(`row`, `column`): the cell at a position of one Parquet file, from 0. [P5]

    A task reads the footer, then one column of the one row group that holds the row. An unknown
    column, or a row that the file does not have, is an error.
    """
    if row < 0:
        raise IndexError("rows are counted from 0")
    kind = next((f.dataType.simpleString() for f in spark.read.parquet(path).schema if f.name == column), None)
    if kind is None:
        raise ValueError(f"no column {column!r} in {path}")

    def read(batches):
        for batch in batches:
            for place, at in zip(batch.column("path").to_pylist(), batch.column("row").to_pylist()):
                store, name = fs.FileSystem.from_uri("/" + place.removeprefix("file:").lstrip("/") if place.startswith("file:") else place)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), _row_of(store, name, at, column)], ["row", column])

    wanted = spark.range(1).select(F.lit(path).alias("path"), F.lit(row).cast("long").alias("row"))
    return wanted.mapInArrow(read, f"row bigint, `{column}` {kind}")
