"""Writing the prepared corpus, and the folder for written tables."""

import bisect
import itertools
import math
import os
import posixpath
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sonoloom import fixed_values as V
from sonoloom.functions import payload
from sonoloom.schema import NO_VALUE, PARTITIONS
from sonoloom.sources import scans

#: Files smaller than this share a task, up to so many bytes of them.
_TASK_BYTES = 1 << 27

#: So many partitions at most are sent to all executors.
_BROADCAST_ROWS = 1 << 16

#: A row group with so many bytes ends before it has all its rows.
_GROUP_BYTES = 1 << 27

#: What Spark writes as %XX in the name of a partition.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

#: Sub-folders of `file_name`: Spark lists them in parallel.
_FOLDERS = 64


def cell_bytes(cell: Column) -> Column:
    """What an audio cell of all forms weighs before it is processed: its bytes, else its samples; a file not read yet counts 1."""
    samples = F.when(cell["array"].isNotNull(), 4 * F.size(cell["array"]))
    return F.coalesce(F.octet_length(cell["bytes"]), samples, F.lit(1))


def _numbered(
    df: DataFrame, weight: Column, file_bytes: int, by: Sequence[str]
) -> tuple[DataFrame, list[tuple[int, int, list[str | None]]]]:
    """`df` with the number of the `_file` of each row, and what is planned: (first, files, values) of each partition.

    A first pass over `by` and `weight` alone adds up what each partition of the corpus weighs; a partition gets as many
    files of `file_bytes` as its weight fills, the last one in part. Rows are dealt among the files of their
    partition at random.
    """
    sums = df.select(*by, weight.alias("_weight")).groupBy(*by).agg(F.sum("_weight").alias("_weight"))
    number = F.greatest(F.ceil(F.col("_weight") / file_bytes), F.lit(1)).alias("_files")
    sums = sums.select(*by, number, F.array(*(F.col(c).cast("string") for c in by)))
    before, known, plan = 0, [], []
    for *row, values in sums.collect():  # one row for each directory that will be written
        known.append((*row, before))
        plan.append((before, row[-1], values))
        before += row[-1]
    schema = ", ".join([*(f"_{c} {df.schema[c].dataType.simpleString()}" for c in by), "_files bigint", "_first bigint"])
    files = df.sparkSession.createDataFrame(known, schema)
    if len(known) <= _BROADCAST_ROWS:  # Spark does not know the size and would shuffle `df` to join it
        files = F.broadcast(files)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_files"))
    return df.join(files, same).select(*df.columns, (F.col("_first") + dealt).alias("_file")), plan


def _sent(rows: DataFrame, plan: list, file_bytes: int, least: int = 1) -> DataFrame:
    """Each row in the task that writes its file; a task has as many files as make `_TASK_BYTES`."""
    total = sum(number for _, number, _ in plan)
    filled = math.ceil(total * file_bytes / _TASK_BYTES)
    tasks = max(1, min(total, max(least, filled, 4 * rows.sparkSession.sparkContext.defaultParallelism)))
    return rows.repartitionById(tasks, (F.col("_file") % tasks).cast("int"))


def placed(
    df: DataFrame, weight: Column, file_bytes: int, by: Sequence[str] = PARTITIONS[1:]
) -> DataFrame:
    """The rows of `df`, each sent once to the task that will write its file. [K1]

    Each partition has the files of `_numbered`. A task writes one file of each of several partitions, as many as make
    `_TASK_BYTES`, so that small files do not cost a task each. Place rows before their audio is read and the audio is
    never shuffled.
    """
    rows, plan = _numbered(df, weight, file_bytes, by)
    most = max((number for _, number, _ in plan), default=1)  # files of one partition are in different tasks
    return _sent(rows, plan, file_bytes, most).select(*df.columns)


def write_corpus(
    df: DataFrame,
    root: str,
    version: int = 0,
    dictionary: bool = True,
    rows_per_group: int = V.ROWS_PER_GROUP,
    rows_per_file: int = 0,
    rebalance: bool = False,
    file_bytes: int = 0,
) -> None:
    """Write under version=/corpus=/split=/language=; partitions with new rows are replaced. [K1-K5]

    Partitions without new rows are left as they are, so an empty result writes nothing.
    Every task writes its own file into every partition it meets, so the audio is not shuffled; the
    split size of the scan bounds the number of tasks, and `rows_per_file` the length of files.
    `rebalance` shuffles all rows instead and gathers each partition into files of the advisory size:
    small partitions share a task, and one that holds most of the rows is divided among many.
    `file_bytes` shuffles them once as well, into files of that size before compression; `placed` does that before
    the audio is there. In a mounted file system such files are written by `_write_numbered`, any number of them in a task.
    """
    if file_bytes:
        weight = F.octet_length("audio_bytes") + F.octet_length("text")
        top = scans.mounted(df.sparkSession, root)
        if top and not rows_per_file and not rebalance:
            rows, plan = _numbered(df.drop("version"), weight, file_bytes, PARTITIONS[1:])
            return _write_numbered(_sent(rows, plan, file_bytes), plan, top, version, dictionary, rows_per_group)
        df = placed(df, weight, file_bytes)
    df = df.withColumn("version", F.lit(version))
    if rebalance:
        df = df.hint("rebalance", *PARTITIONS)
    (
        df.write.mode("overwrite")
        .partitionBy(*PARTITIONS)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", str(rows_per_group))
        .option("parquet.enable.dictionary", str(dictionary).lower())
        .option("maxRecordsPerFile", str(rows_per_file))
        .parquet(root)
    )


def _folder(version: int, values: Sequence[str | None]) -> str:
    """The directory of a partition below its root, as Spark names it."""
    named = zip(PARTITIONS, (str(version), *values), strict=True)
    return "/".join(f"{c}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', v) if v else NO_VALUE}" for c, v in named)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one number that follow each other, with the number."""
    for batch in batches:
        numbers = batch.column("_file").to_numpy()
        ends = [*(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        rows = batch.drop_columns(["_file"])
        for start, end in itertools.pairwise([0, *ends]):
            if end > start:
                yield int(numbers[start]), rows.slice(start, end - start)


def _row_groups(runs: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows anew in tables of `most` rows; one ends after the run that fills `_GROUP_BYTES`, the last has what is left."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for run in runs:
        while run.num_rows:
            part = run.slice(0, most - rows)
            run = run.slice(part.num_rows)
            held.append(part)
            rows, size = rows + part.num_rows, size + part.nbytes
            if rows == most or size >= _GROUP_BYTES:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _write_numbered(
    rows: DataFrame, plan: list, top: str, version: int, dictionary: bool, rows_per_group: int
) -> None:
    """The files of `_numbered`, whose rows are in one task each, in the layout and by the rules of `write_corpus`.

    A task sorts its rows by file and writes one file after the other, so one is open at a time, with no checksum file
    or permission call for each. A file is written aside and renamed once whole, into a folder that readers pass over;
    a task that is run again makes the same names. When all are there, whole partitions are renamed.
    """
    data = [c for c in rows.columns if c not in PARTITIONS]
    job = uuid.uuid4().hex
    staged = f"{top}/.sonoloom-{job}"
    firsts, folders = [first for first, _, _ in plan], [_folder(version, values) for _, _, values in plan]
    about = {
        "org.apache.spark.version": rows.sparkSession.version,
        "org.apache.spark.sql.parquet.row.metadata": rows.select(*(c for c in data if c != "_file")).schema.json(),
    }

    def write(batches):
        aside = f"{staged}/attempt-{TaskContext.get().taskAttemptId()}"
        made, files = set(), 0
        for number, runs in itertools.groupby(_runs(batches), lambda run: run[0]):
            folder = folders[bisect.bisect_right(firsts, number) - 1]
            groups = _row_groups((run for _, run in runs), rows_per_group)
            first = next(groups)
            options = {
                "compression": "zstd", "compression_level": 3, "use_dictionary": dictionary, "store_schema": False,
                # the least and greatest text of a page would be written out twice, uncompressed
                "write_statistics": [f.name for f in first.schema if pa.types.is_primitive(f.type)],
            }
            with open(aside, "wb") as out, pq.ParquetWriter(out, first.schema.with_metadata(about), **options) as writer:
                for group in itertools.chain([first], groups):
                    writer.write_table(group, row_group_size=rows_per_group)
            if folder not in made:
                os.makedirs(f"{staged}/{folder}", exist_ok=True)
                made.add(folder)
            os.replace(aside, f"{staged}/{folder}/part-{number:05d}-{job}.zstd.parquet")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    os.makedirs(staged)
    try:
        rows.select(*data).sortWithinPartitions("_file").mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
        for folder in dict.fromkeys(folders):
            if not os.path.exists(f"{staged}/{folder}"):  # its rows were gone when they were read again
                continue
            if os.path.exists(f"{top}/{folder}"):
                shutil.rmtree(f"{top}/{folder}")
            os.makedirs(posixpath.dirname(f"{top}/{folder}"), exist_ok=True)
            os.replace(f"{staged}/{folder}", f"{top}/{folder}")
    finally:
        shutil.rmtree(staged, ignore_errors=True)


def file_name(number: Column, suffix: str) -> Column:
    """A name for `write_files`, from a whole number: one of `_FOLDERS` sub-folders and the number itself."""
    return F.concat(F.pmod(number, F.lit(_FOLDERS)).cast("string"), F.lit("/"), number.cast("string"), F.lit(suffix))


def write_files(df: DataFrame, root: str, name: Column, content: Column) -> None:
    """One file below `root` for each row: its `content`, under its `name`; rows of one name are one file.

    A task opens and closes its files one after the other, with no checksum file, permission call or commit for each.
    A task that is run again writes the same names. The store must be one that pyarrow can open.
    """
    store, top = fs.FileSystem.from_uri(payload.file_uri(root))
    store.create_dir(top)

    def write(batches):
        store, top = fs.FileSystem.from_uri(payload.file_uri(root))
        made = set()
        for batch in batches:
            for file, data in zip(batch.column("name").to_pylist(), batch.column("content")):
                path = f"{top}/{file}"
                folder = posixpath.dirname(path)
                if folder not in made:
                    store.create_dir(folder)
                    made.add(folder)
                with store.open_output_stream(path) as out:
                    out.write(data.as_buffer())
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    named = df.select(name.alias("name"), content.cast("binary").alias("content"))
    named.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the shared folder of the session.

    That is `spark.checkpoint.dir`. Where it is unset, a local session (as in tests) falls
    back to a temporary folder; on a cluster that would not be shared, so it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/sonoloom-{uuid.uuid4().hex}"
