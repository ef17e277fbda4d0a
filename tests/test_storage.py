import struct
import wave
from glob import glob
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from sonoloom.plans import ingest
from sonoloom.schema import AUDIO_CELL, RAW_TRANSCRIPTS
from sonoloom.sources import files as stored_files, scans, sink


def prepared(spark, n=1000, split="train", corpus="c", size=160):
    return spark.range(n).select(
        F.concat(F.lit("text "), "id").alias("text"),
        F.lit(b"\x00\xff").alias("audio_bytes"),
        F.lit(size).cast("long").alias("audio_size"),
        F.lit(corpus).alias("corpus"),
        F.lit(split).alias("split"),
        F.lit("gom_Deva").alias("language"),
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "corpus")


def files(root, level="**"):
    return sorted(glob(f"{root}/version=0/{level}/*.parquet", recursive=True))


def test_layout_row_groups_and_compression(spark, root):
    sink.write_corpus(prepared(spark).coalesce(1), root, dictionary=False)
    (path,) = files(root, "corpus=c/split=train/language=gom_Deva")
    footer = pq.ParquetFile(path).metadata
    assert [footer.row_group(i).num_rows for i in range(footer.num_row_groups)] == [100] * 10
    chunk = footer.row_group(0).column(0)
    assert chunk.compression == "ZSTD"
    assert not any("DICTIONARY" in e for e in chunk.encodings)


def test_dictionary_encoding(spark, root):
    repeated = prepared(spark).withColumn("text", F.lit("same")).coalesce(1)
    sink.write_corpus(repeated, root)
    (path,) = files(root)
    assert any("DICTIONARY" in e for e in pq.ParquetFile(path).metadata.row_group(0).column(0).encodings)


def test_second_run_replaces_its_partitions_only(spark, root):
    sink.write_corpus(prepared(spark, split="train"), root)
    sink.write_corpus(prepared(spark, split="test"), root)
    before = files(root, "corpus=c/split=train/*")
    sink.write_corpus(prepared(spark, n=3, split="test"), root)
    assert files(root, "corpus=c/split=train/*") == before
    counts = {r.split: r["count"] for r in scans.read_corpus(spark, root).groupBy("split").count().collect()}
    assert counts == {"train": 1000, "test": 3}


def test_empty_result_writes_nothing(spark, root):
    sink.write_corpus(prepared(spark), root)
    before = files(root)
    sink.write_corpus(prepared(spark).filter("false"), root)
    assert files(root) == before


def test_rows_per_file(spark, root):
    sink.write_corpus(prepared(spark).coalesce(1), root, rows_per_file=300)
    assert sorted(pq.ParquetFile(f).metadata.num_rows for f in files(root)) == [100, 300, 300, 300]


def test_partition_values_stay_text(spark, root):
    sink.write_corpus(prepared(spark, n=2, corpus="007"), root)
    assert {r.corpus for r in scans.read_corpus(spark, root).collect()} == {"007"}
    assert scans.read_corpus(spark, root, corpus="007", version=0).count() == 2
    assert scans.read_corpus(spark, root, version=1).count() == 0


def test_unreadable_files_are_skipped_on_request(spark, root):
    sink.write_corpus(prepared(spark, n=10), root)
    damaged = f"{root}/version=0/corpus=c/split=train/language=gom_Deva/damaged.parquet"
    with open(damaged, "wb") as out:
        out.write(b"not parquet")
    assert scans.read_corpus(spark, root, skip_corrupt=True).count() == 10
    with pytest.raises(Exception):
        scans.read_corpus(spark, root).select("text").collect()


def test_a_file_counts_wholly_or_not_at_all(spark, root):
    """Not Parquet, empty, cut short, damaged in the last of its row groups: all are named, none counts in part."""
    rows = prepared(spark, n=1000).withColumn("audio_size", F.xxhash64("text") % 1000 + 1000)
    sink.write_corpus(rows.coalesce(1), root, dictionary=False)
    (whole,) = files(root)
    folder = whole.rsplit("/", 1)[0]
    data = open(whole, "rb").read()
    chunk = pq.ParquetFile(whole).metadata.row_group(9).column(2)
    assert chunk.path_in_schema == "audio_size"
    at = chunk.data_page_offset + chunk.total_compressed_size - 200
    contents = {"a b%20c": b"not parquet", "nothing": b"", "short": data[: len(data) // 2], "bad": data[:at] + bytes(150) + data[at + 150 :]}
    for name, content in contents.items():
        with open(f"{folder}/{name}.parquet", "wb") as out:
            out.write(content)
    found = {r.file.rsplit("/", 1)[1]: (r.reason, r.rows) for r in stored_files.skipped_files(spark, root).collect()}
    assert found == {
        "a%20b%2520c.parquet": ("no readable footer", None),
        "short.parquet": ("no readable footer", None), "bad.parquet": ("damaged data", 1000),
    }
    total = rows.agg(F.sum("audio_size")).first()[0]
    report = ingest.stored_report(spark, root, skip_corrupt=True).collect()
    assert [(r.num_samples, r.duration_hours) for r in report] == [(1000, total / 16000 / 3600)] * 2


def test_a_cell_by_its_place_reads_one_row_group(spark, root, monkeypatch):
    sink.write_corpus(prepared(spark, n=1000).coalesce(1), root)
    (path,) = files(root)
    order = pq.read_table(path, columns=["text"]).column(0).to_pylist()
    for row in (0, 99, 100, 777, 999):
        assert stored_files.lookup_row(spark, path, row, "text").collect() == [(row, order[row])]
    assert bytes(stored_files.lookup_row(spark, f"file://{path}", 5, "audio_bytes").first()[1]) == b"\x00\xff"
    read, real = [], pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda f, i, columns: read.append((i, columns)) or real(f, i, columns=columns))
    assert stored_files._row_of(fs.LocalFileSystem(), path, 777, "text").to_pylist() == [order[777]]
    assert read == [(7, ["text"])]
    with pytest.raises(ValueError, match="no column 'speech'"):
        stored_files.lookup_row(spark, path, 0, "speech")
    with pytest.raises(Exception, match="no row 1000"):
        stored_files.lookup_row(spark, path, 1000, "text").collect()


def odd(spark):
    """Partition values that Spark writes otherwise than they are, each with two rows."""
    values = [*("".join(map(chr, range(c, min(c + 16, 128)))) for c in range(1, 128, 16)), "é%C3ß", " ", "..", "", None]
    return spark.createDataFrame([(f"{v!r} {i}", v) for v in values for i in (0, 1)], "text string, corpus string").select(
        "text", F.encode("text", "utf-8").alias("audio_bytes"), F.lit(7).cast("long").alias("audio_size"), "corpus",
        F.lit("train").alias("split"), F.lit("en").alias("language"),
    )


def test_numbered_files_lie_where_sparks_writer_puts_them(spark, tmp_path):
    plain, small = tmp_path / "plain a%20b", tmp_path / "small a%20b"
    sink.write_corpus(odd(spark), str(plain))
    sink.write_corpus(odd(spark), f"file://{small}", file_bytes=1 << 20)
    folders = [{str(p.relative_to(top)) for p in top.rglob("*") if p.is_dir()} for top in (plain, small)]
    assert folders[0] == folders[1] and len(folders[0]) == 37
    read = [scans.read_corpus(spark, str(top)) for top in (plain, small)]
    assert read[0].exceptAll(read[1]).count() == read[1].exceptAll(read[0]).count() == 0
    by_file = scans.read_corpus(spark, str(plain), file_column="file")
    assert by_file.drop("file").schema == read[0].schema
    assert by_file.drop("file").exceptAll(read[0]).count() == read[0].exceptAll(by_file.drop("file")).count() == 0
    assert by_file.where("corpus is null").count() == 4


def test_numbered_files_follow_the_options_of_the_sink(spark, root):
    rows = prepared(spark).withColumn("text", F.lit("same"))
    sink.write_corpus(rows, root, version=3, dictionary=False, file_bytes=1 << 20)
    (path,) = glob(f"{root}/version=3/corpus=c/split=train/language=gom_Deva/*.parquet")
    footer = pq.ParquetFile(path).metadata
    assert [footer.row_group(i).num_rows for i in range(footer.num_row_groups)] == [100] * 10
    assert footer.row_group(0).column(0).compression == "ZSTD"
    assert not any("DICTIONARY" in e for e in footer.row_group(0).column(0).encodings)
    assert spark.read.parquet(path).dtypes == [("text", "string"), ("audio_bytes", "binary"), ("audio_size", "bigint")]
    sink.write_corpus(rows, root, version=4, rows_per_group=30, file_bytes=1 << 20)
    (path,) = glob(f"{root}/version=4/**/*.parquet", recursive=True)
    footer = pq.ParquetFile(path).metadata
    assert [footer.row_group(i).num_rows for i in range(footer.num_row_groups)] == [30] * 33 + [10]
    assert any("DICTIONARY" in e for e in footer.row_group(0).column(0).encodings)
    sink.write_corpus(rows, root, version=5, rows_per_file=300, file_bytes=1 << 20)
    counts = [pq.ParquetFile(f).metadata.num_rows for f in glob(f"{root}/version=5/**/*.parquet", recursive=True)]
    assert sorted(counts) == [100, 300, 300, 300]


def test_numbered_files_replace_their_partitions_only(spark, root):
    sink.write_corpus(prepared(spark, split="train"), root, file_bytes=4000)
    sink.write_corpus(prepared(spark, split="test"), root, file_bytes=4000)
    before = files(root, "corpus=c/split=train/*")
    assert len(before) > 2
    sink.write_corpus(prepared(spark, n=3, split="test"), root, file_bytes=4000)
    sink.write_corpus(prepared(spark).filter("false"), root, file_bytes=4000)
    assert files(root, "corpus=c/split=train/*") == before
    assert {r.split: r["count"] for r in scans.read_corpus(spark, root).groupBy("split").count().collect()} == {"train": 1000, "test": 3}
    broken = prepared(spark, n=3, split="test").withColumn("audio_size", F.raise_error(F.lit("no size")).cast("long"))
    with pytest.raises(Exception, match="no size"):
        sink.write_corpus(broken, root, file_bytes=4000)
    assert scans.read_corpus(spark, root).count() == 1003
    assert [p.rsplit("/", 1)[1] for p in glob(f"{root}/*") + glob(f"{root}/.*")] == ["version=0"]


def test_large_rows_end_a_row_group(monkeypatch):
    rows = pa.RecordBatch.from_pydict({"n": range(40), "audio_bytes": [b"x" * 1500] * 40})
    assert [t.num_rows for t in sink._row_groups([rows.slice(0, 7), rows.slice(7)], 30)] == [30, 10]
    monkeypatch.setattr(sink, "_GROUP_BYTES", 5000)
    groups = list(sink._row_groups([rows.slice(i, 4) for i in range(0, 40, 4)], 30))
    assert [t.num_rows for t in groups] == [4] * 10 and pa.concat_tables(groups)["n"].to_pylist() == list(range(40))


def test_rows_with_their_file(spark, root):
    """Hidden and empty files are none, a column that is not there is NULL, other layouts are left to Spark."""
    sink.write_corpus(prepared(spark, n=10, corpus="007"), root)
    sink.write_corpus(prepared(spark, n=5, split="test").drop("audio_size"), root)
    sink.write_corpus(prepared(spark, n=2), root, version=1)
    folder = f"{root}/version=0/corpus=007/split=train/language=gom_Deva"
    for name in ("nothing.parquet", "_hidden.parquet", ".x.parquet"):
        with open(f"{folder}/{name}", "wb") as out:
            out.write(b"no Parquet" * (name != "nothing.parquet"))
    stored = scans.read_corpus(spark, root, file_column="file", version=0)
    assert {(r.corpus, r.split, r.version, r.audio_size): r["count"] for r in stored.groupBy("corpus", "split", "version", "audio_size").count().collect()} == {
        ("007", "train", 0, 160): 10, ("c", "test", 0, None): 5
    }
    assert {r.file for r in stored.collect()} <= set(files(root))
    assert scans.read_corpus(spark, root, file_column="file", corpus="c").count() == 7
    assert scans.read_corpus(spark, root, file_column="file", corpus="d").count() == 0
    with open(f"{folder}/damaged.parquet", "wb") as out:
        out.write(b"not parquet")
    with pytest.raises(Exception):
        scans.read_corpus(spark, root, file_column="file").collect()
    whole = scans.read_corpus(spark, root, skip_corrupt=True, file_column="file", version=0)
    assert whole.count() == 15 and "damaged" not in {r.file for r in whole.collect()}
    flat = scans.read_corpus(spark, f"{root}/version=0/corpus=007", file_column="file", split="train", skip_corrupt=True)
    assert flat.count() == 10


def test_read_split(spark, root):
    rows = spark.range(4).select(
        F.struct(F.lit(b"x").alias("bytes"), F.lit("p").alias("path")).alias("audio"),
        F.lit("Konkani").alias("language"),
        F.when(F.col("id") > 2, "test").otherwise("train").alias("split"),
        F.lit("t").alias("transcript"),
    )
    rows.write.partitionBy("split").parquet(root)
    df = scans.read_split(spark, root, "train")
    assert df.columns == RAW_TRANSCRIPTS.names + ["split"]
    assert df.count() == 3 and df.filter("state is null").count() == 3


def test_payloads_by_path(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.wav").write_bytes(b"AAA")
    (tmp_path / "deep" / "b.wav").write_bytes(b"BBB")
    (tmp_path / "c.txt").write_bytes(b"CCC")
    cells = [
        (None, None, None, f"{tmp_path}/a.wav"),
        (None, None, None, f"file://{tmp_path}/deep/b.wav"),
        (None, None, b"own", f"{tmp_path}/a.wav"),
        (None, None, None, f"{tmp_path}/c.txt"),
        (None, None, None, None),
        ([0.5], 16000, None, f"{tmp_path}/a.wav"),
        None,
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, audio " + AUDIO_CELL.simpleString())
    out = scans.with_payloads(df, str(tmp_path), pattern="*.wav")
    got = {r.i: r.b and bytes(r.b) for r in out.select("i", F.col("audio.bytes").alias("b")).collect()}
    assert got == {0: b"AAA", 1: b"BBB", 2: b"own", 3: None, 4: None, 5: None, 6: None}


def test_prepare_corpus_reports_what_it_wrote(spark, root):
    report = ingest.prepare_corpus(prepared(spark, n=20, size=16000), root).collect()
    assert sorted((r.split, r.num_samples, r.duration_hours) for r in report if not r.is_total) == [
        ("train", 20, 20 / 3600)
    ]
    assert [(r.num_samples, r.duration_hours) for r in report if r.is_total] == [(20, 20 / 3600)]


def session(shared, master):
    settings = {"spark.checkpoint.dir": shared} if shared else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master)
    )


def test_scratch_folder_follows_the_session():
    shared = session("hdfs://shared/", "yarn")
    assert sink.scratch_folder(shared).startswith("hdfs://shared/sonoloom-")
    assert sink.scratch_folder(shared) != sink.scratch_folder(shared)
    assert sink.scratch_folder(session(None, "local[2]"))
    with pytest.raises(ValueError):
        sink.scratch_folder(session(None, "yarn"))


def test_paths_match_with_and_without_their_file_system(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"content")
    cells = [(None, p) for p in (f"{tmp_path}/a.wav", f"file:{tmp_path}/a.wav", f"file://{tmp_path}/a.wav", f"hdfs://nn:1{tmp_path}/a.wav")]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, audio struct<bytes:binary,path:string>")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        rows = scans.with_payloads(df, root).sort("i").collect()
        assert [r.audio.bytes and bytes(r.audio.bytes) for r in rows] == [b"content"] * 3 + [None]


def wav(path, values):
    with wave.open(str(path), "wb") as out:
        out.setnchannels(1)
        out.setsampwidth(2)
        out.setframerate(16000)
        out.writeframes(struct.pack(f"<{len(values)}h", *values))


def test_ingest_reads_the_files_of_the_rows_it_keeps(spark, tmp_path):
    """Paths are followed after limit and text, without a join or a shuffle; missing and damaged files give silence."""
    (tmp_path / "deep").mkdir()
    for i in range(4):
        wav(tmp_path / "deep" / f"{i}.wav", range(i, i + 10 + i))
    (tmp_path / "bad.wav").write_bytes(b"no audio")
    paths = [f"{tmp_path}/deep/0.wav", f"file:{tmp_path}/deep/1.wav", f"file://{tmp_path}/deep/2.wav", "deep/3.wav",
             f"{tmp_path}/none.wav", f"{tmp_path}/bad.wav", "odd://x/y"]
    rows = [(i, f"text {i}", "train", (None, p)) for i, p in enumerate([*paths, f"{tmp_path}", f"{tmp_path}"])]
    rows[7] = (7, "12", *rows[7][2:])  # a folder is no file; both rows are gone before it is opened
    df = spark.createDataFrame(rows, "id int, transcription string, split string, audio struct<bytes:binary,path:string>")
    out = ingest.ingest(df, "c", "en", "id", max_samples=8, audio_root=str(tmp_path))
    got = sorted((r.text, r.audio_size, len(r.audio_bytes)) for r in out.collect())
    sizes = [10, 11, 12, 13, 0, 0, 0]
    assert got == [(f"text {i}", n, 44 + 2 * n if n else 0) for i, n in enumerate(sizes)]
    first = out.filter("audio_size = 11").first()
    assert struct.unpack("<11h", first.audio_bytes[44:]) == tuple(range(1, 12))
    main = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Join" not in main and "Exchange" not in main
