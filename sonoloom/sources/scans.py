"""Reading: raw tables, the stored corpus, audio files by path."""

import itertools
import math
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sonoloom.functions import payload
from sonoloom.schema import NO_VALUE, PARTITIONS, RAW_TRANSCRIPTS, STORED

#: A task of `_by_file` reads so many bytes, each file counted with `_OPEN_BYTES` more, and hands on batches of `_BATCH_BYTES`.
_TASK_BYTES, _OPEN_BYTES, _BATCH_BYTES = 1 << 26, 1 << 14, 1 << 24


def read_split(
    spark: SparkSession,
    path: str,
    split: str,
    config: str | None = None,
    schema: StructType = RAW_TRANSCRIPTS,
    split_column: str = "split",
) -> DataFrame:
    """One named split of a landed table with a `split=` directory level. [S1]

    `config` names a subset, a folder of its own below `path`.
    """
    path = f"{path}/{config}" if config else path
    whole = StructType(list(schema.fields))
    if split_column not in whole.names:
        whole = whole.add(split_column, "string")
    return spark.read.schema(whole).parquet(path).filter(F.col(split_column) == split)


def mounted(spark: SparkSession, root: str) -> str | None:
    """The plain path of `root`, if it is a file system that driver and executors have mounted; None for all other stores."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    named = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return payload.file_uri(named) if named.startswith("file:") else None


def read_corpus(
    spark: SparkSession, root: str, skip_corrupt: bool = False, file_column: str | None = None, **partition: str | int
) -> DataFrame:
    """A stored corpus with its partition values; keyword values prune directories. [S2, S4, S5]

    The schema is given, never inferred: no file is opened to plan the read, partition
    values stay text, and a file without a column gives NULL there [S6]. With
    `skip_corrupt`, rows read from a file before its damage are kept. With `file_column` each row
    names its file, and the corpus may have very many files, see `_by_file`.
    """
    folders = _folders(spark, root) if file_column and not skip_corrupt else None
    if folders is not None:
        df = _by_file(spark, folders, file_column, partition)
    else:
        df = (
            spark.read.schema(STORED)
            .option("ignoreCorruptFiles", str(skip_corrupt).lower())
            .parquet(root)
        )
        if file_column:
            df = df.withColumn(file_column, F.col("_metadata.file_path"))
    for name, value in partition.items():
        df = df.filter(F.col(name) == value)
    return df


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _folders(spark: SparkSession, root: str) -> list[tuple[str, tuple]] | None:
    """Path and values of each partition; None if `root` is not `mounted` or if anything else lies between."""
    top = mounted(spark, root)
    if top is None:
        return None
    level: list[tuple[str, tuple]] = [(top, ())]
    for name in PARTITIONS:
        below = []
        for path, values in level:
            for found in os.scandir(path):
                if _hidden(found.name):
                    continue
                if not found.is_dir() or not found.name.startswith(f"{name}="):
                    return None
                value = found.name.removeprefix(f"{name}=")
                plain = re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)
                below.append((found.path, (*values, None if value == NO_VALUE else plain)))
        level = below
    return level


def _by_file(spark: SparkSession, folders: list[tuple[str, tuple]], file_column: str, partition: dict) -> DataFrame:
    """The rows of these partitions, each with the path of its file, for a corpus of any number of small files.

    Directories are listed, and files dealt out and opened, in tasks: the driver holds a line for each directory, not
    for each file, and a task has thousands of small files. All columns are read, a file by one task.
    """
    for name, value in partition.items():
        at = PARTITIONS.index(name)
        if isinstance(value, str) and STORED[name].dataType.typeName() == "string":
            folders = [f for f in folders if f[1][at] == value]
    data = [f.name for f in STORED if f.name not in PARTITIONS]
    schema = StructType([STORED[c] for c in (*data, *PARTITIONS)]).add(file_column, "string")
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "integer": pa.int32()}
    types = {f.name: types[f.dataType.typeName()] for f in STORED}

    def listed(batches):
        for batch in batches:
            for folder in batch.column("id").to_pylist():
                found = ((f.path, f.stat().st_size) for f in os.scandir(folders[folder][0]) if f.is_file() and not _hidden(f.name))
                files = ((folder, path, size) for path, size in found if size)
                for some in itertools.batched(files, 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some, strict=True)], ["folder", "file", "bytes"])

    def group(file, number: int):
        """The data columns of a row group."""
        table, rows = file.read_row_group(number, data, use_threads=False), file.metadata.row_group(number).num_rows
        return pa.table({c: table[c].cast(types[c]) if c in table.column_names else pa.nulls(rows, types[c]) for c in data})

    def batches_of(held):
        """Batches of the tables of `held`, (folder, path, table), with the values of the folder and the path."""
        row = np.repeat(np.arange(len(held)), [table.num_rows for _, _, table in held])
        columns = dict(zip(data, pa.concat_tables([table for _, _, table in held]).combine_chunks().columns, strict=True))
        for at, name in enumerate(PARTITIONS):
            values = [folders[folder][1][at] for folder, _, _ in held]
            columns[name] = pa.array(values, pa.string()).cast(types[name]).take(pa.array(row))
        columns[file_column] = pa.array([path for _, path, _ in held], pa.string()).take(pa.array(row))
        return pa.table(columns).to_batches()

    def read(batches):
        held, size = [], 0
        for batch in batches:
            for folder, path in zip(batch.column("folder").to_pylist(), batch.column("file").to_pylist(), strict=True):
                with pq.ParquetFile(path) as file:
                    for number in range(file.num_row_groups):
                        held.append((folder, path, group(file, number)))
                        size += held[-1][2].nbytes
                        if size >= _BATCH_BYTES:
                            yield from batches_of(held)
                            held, size = [], 0
        if held:
            yield from batches_of(held)

    least = 4 * spark.sparkContext.defaultParallelism
    numbers = spark.range(0, len(folders), 1, max(1, min(len(folders), least)))
    found = numbers.mapInArrow(listed, "folder bigint, file string, bytes bigint")
    count, size = found.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(count, max(least, math.ceil((size + count * _OPEN_BYTES) / _TASK_BYTES))))
    return found.select("folder", "file").repartition(tasks, "file").mapInArrow(read, schema)


def _store(path):
    """Scheme and authority of a path, if it names them; the forms of `file:` are one."""
    return F.regexp_replace(F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)", 1), r"^file:.*", "file:")


def _plain(path):
    """The path within its file system."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def with_payloads(
    df: DataFrame, root: str, column: str = "audio", pattern: str | None = None
) -> DataFrame:
    """Fill `bytes` of audio cells that have only a path from the files under `root`. [S3]

    Only those rows take part in the join, so no row is shuffled for a NULL key. The files
    are never broadcast; a path that names no file system is one of that of `root`; a path shared by very many rows is split by adaptive skew handling.
    Every file under `root` that fits `pattern` is read: name the narrowest folder.
    """
    spark = df.sparkSession
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root).select(
        _plain(F.col("path")).alias("_file"), _store(F.col("path")).alias("_store"), F.col("content")
    )

    cell = F.col(column)
    by_path = cell["bytes"].isNull() & (F.length(cell["path"]) > 0)
    if "array" in df.schema[column].dataType.names:  # samples with a rate need no file
        by_path = by_path & (cell["array"].isNull() | cell["sampling_rate"].isNull())
    same_file = (F.col("_path") == F.col("_file")) & ((F.col("_named") == "") | (F.col("_named") == F.col("_store")))
    fetched = (
        df.filter(by_path)
        .withColumns({"_path": _plain(cell["path"]), "_named": _store(cell["path"])})
        .join(files.hint("merge"), same_file, "left")
        .withColumn(column, cell.withField("bytes", F.col("content")))
        .drop("_path", "_named", "_file", "_store", "content")
    )
    return df.filter(~F.coalesce(by_path, F.lit(False))).unionByName(fetched)
