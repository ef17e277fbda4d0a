"""WARC archives: a writer with revisit records, and a reader whose tasks take byte ranges of the files."""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import written

_MAGIC = b"\x1f\x8b\x08"
_BLOCK = 1 << 18
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MANIFEST = "file string, bytes long, records long"
_RECORD = (
    "file string, offset long, record_type string, record_id string, target_uri string, digest string, "
    "refers_to string, payload binary"
)


def with_record_types(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(`page_id`, `url`, `payload`, `digest`, `record_type`, `refers_to`) for every page.

    Of equal payloads of at least `least_bytes` bytes that with the largest page_id is the response, the
    others revisit it. A null html is an empty payload. A null page_id is smaller than any other; rows
    that share the largest page_id and the payload are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"key": F.unhex(F.sha2("payload", 256)), "digest": F.sha1("payload")}
    )
    last = written(  # a table, no aggregation, in the join: a payload of very many pages can then be split
        pages.select("page_id", payload.alias("payload"))
        .where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.unhex(F.sha2("payload", 256)).alias("k"))
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1")
    )
    again = F.col("k").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(last, F.col("key") == F.col("k"), "left").select(
        "page_id", "url", "payload", "digest",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("last")).alias("refers_to"),
    )


def _member(row: dict) -> bytes:
    """One record as one gzip member. Line ends in a url are percent-encoded, so headers stay one line each."""
    revisit = row["record_type"] == "revisit"
    block = _HTTP if revisit else _HTTP + row["payload"]
    url = (row["url"] or "").encode("utf-8", "surrogatepass").replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + row["record_type"].encode(),
        b"WARC-Record-ID: <urn:page:%s>" % str(row["page_id"]).encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Target-URI: " + url,
        b"WARC-Payload-Digest: sha1:" + row["digest"].encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if revisit:
        head += [
            b"WARC-Refers-To: <urn:page:%s>" % str(row["refers_to"]).encode(),
            b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return gzip.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write `records` as archives of some `archive_bytes` below `folder`; return the manifest.

    The manifest (`file`, `bytes`, `records`) is a table that Spark commits. A task that is repeated writes
    under new names, and only the files of the attempt that succeeded are in the manifest.
    """
    target = f"{folder}/archives"

    def write(batches):
        system, root = fs.FileSystem.from_uri(target)
        system.create_dir(root, recursive=True)
        out, done, name, count = None, [], "", 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                out.write(_member(row))
                count += 1
                if out.tell() >= archive_bytes:
                    done.append((name, out.tell(), count))
                    out.close()
                    out = None
        if out is not None:
            done.append((name, out.tell(), count))
            out.close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{target}/{n}" for n, *_ in done], pa.string()),
                pa.array([b for _, b, _ in done], pa.int64()),
                pa.array([c for *_, c in done], pa.int64()),
            ],
            ["file", "bytes", "records"],
        )

    return written(records.mapInArrow(write, _MANIFEST), f"{folder}/manifest")


def _find(handle, at: int, stop: int, size: int) -> int | None:
    """The first gzip magic that starts in [at, stop), read block by block."""
    while at < stop:
        block = handle.read_at(min(_BLOCK, size - at), at)
        hit = block.find(_MAGIC)
        if hit >= 0:
            return at + hit if at + hit < stop else None
        if not block or at + len(block) >= size:
            return None
        at += len(block) - len(_MAGIC) + 1  # a magic may lie across two blocks
    return None


def _read_member(handle, at: int, size: int) -> tuple[bytes, int] | None:
    """(content, end) of the record that is a gzip member at `at`; None if there is no such record there.

    The first decoded bytes must be a WARC version line; the member's checksum is then checked by decoding.
    """
    inflate, parts, position = zlib.decompressobj(31), [], at
    try:
        while not inflate.eof:
            block = handle.read_at(min(_BLOCK, size - position), position)
            if not block:
                return None
            position += len(block)
            parts.append(inflate.decompress(block))
            if len(parts) == 1 and not parts[0].startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    return b"".join(parts), position - len(inflate.unused_data)


def _parsed(content: bytes) -> dict | None:
    """The record's fields; None if it lacks its length, type or id."""
    head, _, block = content.partition(b"\r\n\r\n")
    lines = [line.partition(b":") for line in head.split(b"\r\n")[1:]]
    fields = {k.strip().lower(): v.strip().decode("utf-8", "replace") for k, _, v in lines}
    length = fields.get(b"content-length", "")
    if not (length.isascii() and length.isdigit() and b"warc-type" in fields and b"warc-record-id" in fields):
        return None
    block = block[: int(length)]
    revisit = fields[b"warc-type"] == "revisit"
    return {
        "record_type": fields[b"warc-type"],
        "record_id": fields[b"warc-record-id"].strip("<>"),
        "target_uri": fields.get(b"warc-target-uri"),
        "digest": fields.get(b"warc-payload-digest", "").removeprefix("sha1:"),
        "refers_to": fields.get(b"warc-refers-to", "").strip("<>") or None,
        "payload": None if revisit else block.partition(b"\r\n\r\n")[2],
    }


def read_archives(
    files: DataFrame, split_bytes: int = 8 << 20, batch_bytes: int = 16 << 20, most_tasks: int = 100_000
) -> DataFrame:
    """The records of the archives (`file`, `bytes`), whatever wrote them, read in ranges of `split_bytes`.

    Each range is a task's row: it looks for gzip magic, takes a candidate for a member if its first bytes
    decode to a WARC version line and it decodes to its end, and owns the records that start inside; the
    last one may end beyond. Damaged bytes are skipped up to the next good member, and so are records that lack
    their length, type or id. A revisit has no payload. There is a task for each range, up to `most_tasks`.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.where("bytes > 0").select("file", "bytes", starts.alias("start"))
    # Ranges are small rows, which adaptive execution would put into one task if it were free to.
    tasks = files.where("bytes > 0").agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0]
    ranges = ranges.repartition(max(1, min(tasks or 1, most_tasks)))
    names = [part.split()[0] for part in _RECORD.split(", ")]

    def read(batches):
        for batch in batches:
            for task in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(task["file"])
                size, at = task["bytes"], task["start"]
                stop, rows, held = min(at + split_bytes, size), [], 0
                with system.open_input_file(path) as handle:
                    while (hit := _find(handle, at, stop, size)) is not None:
                        member = _read_member(handle, hit, size)
                        if member is None:
                            at = hit + 1
                            continue
                        if (record := _parsed(member[0])) is not None:
                            rows.append({"file": task["file"], "offset": hit, **record})
                        at, held = member[1], held + len(member[0])
                        if held >= batch_bytes:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        kinds = {"offset": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names
        )

    return ranges.mapInArrow(read, _RECORD)


def page_of(record_id: Column) -> Column:
    """The page_id in a record id of `write_archives`; null if the page had none."""
    return F.regexp_extract(record_id, r"^urn:page:(-?\d+)$", 1).try_cast("long")


def resolved(records: DataFrame) -> DataFrame:
    """`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to` of every record.

    Length and digest of a response are those of the payload read back; a revisit takes the length from
    the response with its digest.
    """
    rows = records.select(
        page_of(F.col("record_id")).alias("page_id"), "record_type", page_of(F.col("refers_to")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("own_bytes"),
        F.when(F.col("payload").isNull(), F.col("digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
    )
    table = written(rows)
    lengths = written(
        table.where("record_type = 'response'")
        .groupBy(F.col("payload_digest").alias("d"))
        .agg(F.max("own_bytes").alias("full_bytes"))
    )
    revisits = table.where("record_type <> 'response'")
    return table.where("record_type = 'response'").select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    ).union(
        revisits.join(lengths, F.col("payload_digest") == F.col("d"), "left").select(
            "page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
        )
    )
