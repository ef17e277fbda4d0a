"""Functions over encoded audio: numpy inside Arrow batches, one audio column shipped.

Spark cuts the batches by bytes as well as by rows, so long recordings do not pile up in
one batch. A payload that cannot be read gives NULL (or the empty fallback), never an error.
"""

import io
import logging
import struct
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from sonoloom import fixed_values as V
from sonoloom.schema import AUDIO_CELL, DECODED_AUDIO, PROCESSED_AUDIO

_LOG = logging.getLogger(__name__)

# Sample kinds of the WAV format, and the widths in bytes that are read.
_PCM, _FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE
_READABLE = {(_PCM, 1), (_PCM, 2), (_PCM, 3), (_PCM, 4), (_FLOAT, 4), (_FLOAT, 8)}

#: A damaged rate can ask for any length. More samples than this are made only of a recording that grows by
#: no more than `_MOST_GROWTH`, which a rate of 1 kHz does at 16 kHz: a long recording has its own bytes.
_MOST_SAMPLES = 1 << 28
_MOST_GROWTH = 16

#: Samples that are resampled or quantised at once.
_BLOCK_SAMPLES = 1 << 22

#: Processed audio is passed on in batches of about this size.
_BATCH_BYTES = 1 << 26


def _waves(column: pa.Array) -> list[np.ndarray | None]:
    """The float32 arrays of a list column, without a Python object per sample."""
    return [
        s.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False) if s.is_valid else None
        for s in column
    ]


def _wav_parts(payload: bytes) -> tuple[int, int, int, int, bytes]:
    """Sample kind, channels, rate, bytes a sample and the whole samples of a RIFF file.

    Sizes in chunk headers are taken as far as there are bytes: writers of streams leave them open.
    """
    if payload[:4] != b"RIFF" or payload[8:12] != b"WAVE":
        raise ValueError("no RIFF file")
    at, form = 12, None
    while at + 8 <= len(payload):
        name, size = payload[at : at + 4], int.from_bytes(payload[at + 4 : at + 8], "little")
        body = payload[at + 8 : at + 8 + size]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", body)
            if kind == _EXTENSIBLE:
                kind = int.from_bytes(body[24:26], "little")
            form = kind, channels, rate, bits // 8
        elif name == b"data" and form:
            kind, channels, rate, width = form
            if channels < 1 or (kind, width) not in _READABLE:
                raise ValueError(f"samples of kind {kind} with {width} bytes")
            return kind, channels, rate, width, body[: len(body) // (width * channels) * width * channels]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _read_wav(payload: bytes) -> tuple[np.ndarray, int, int]:
    """Interleaved float32 samples, in [-1, 1) if they are integers, channel count, rate."""
    kind, channels, rate, width, raw = _wav_parts(payload)
    if kind == _FLOAT:
        return np.frombuffer(raw, f"<f{width}").astype(np.float32), channels, rate
    if width == 1:  # the one unsigned width
        values = np.frombuffer(raw, np.uint8).astype(np.int16) - 128
    elif width == 3:
        values = np.pad(np.frombuffer(raw, np.uint8).reshape(-1, 3), ((0, 0), (1, 0)))
        values, width = values.reshape(-1).view("<i4"), 4
    else:
        values = np.frombuffer(raw, f"<i{width}")
    # a power of two: scaling the single-precision value is exact
    return values.astype(np.float32) * np.float32(0.5 ** (8 * width - 1)), channels, rate


def _write_wav(pcm: np.ndarray, rate: int, channels: int = 1) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as sink:
        sink.setnchannels(channels)
        sink.setsampwidth(2)
        sink.setframerate(rate)
        sink.writeframes(pcm.astype("<i2").tobytes())
    return out.getvalue()


def _mono(samples: np.ndarray, channels: int) -> np.ndarray:
    if channels == 1:
        return samples
    frames = samples[: samples.size // channels * channels].reshape(-1, channels)
    total = frames[:, 0].copy()  # adding whole channels is far faster than a mean per frame
    for c in range(1, channels):
        total += frames[:, c]
    return total / np.float32(channels)


def _resampled(mono: np.ndarray, rate: int, target: int, kind: type, stored=None) -> np.ndarray:
    """The samples at the target rate as `kind`, made block by block; `stored` is applied to each block."""
    if mono.size == 0 or rate <= 0:
        raise ValueError("nothing to resample")
    last, count = mono.size - 1, int(mono.size / rate * target)
    if count > max(_MOST_SAMPLES, _MOST_GROWTH * mono.size):
        raise ValueError(f"{count} samples at the target rate")
    step = last / (count - 1) if count > 1 else 0.0
    out = np.empty(count, kind)
    for start in range(0, count, _BLOCK_SAMPLES):
        position = np.arange(start, min(start + _BLOCK_SAMPLES, count)) * step
        left = np.minimum(position.astype(np.int64), last)
        first = left[0]
        samples = mono[first : left[-1] + 2].astype(np.float64)
        here, ahead = samples[left - first], samples[np.minimum(left + 1, last) - first]
        block = here + (position - left) * (ahead - here)
        if count > 1 and start + len(block) == count:
            block[-1] = mono[last]
        out[start : start + len(block)] = stored(block) if stored else block
    return out


def _at_rate(mono: np.ndarray, rate: int, target: int) -> np.ndarray:
    """The numpy form of `functions.audio.resample`."""
    return mono if rate == target else _resampled(mono, rate, target, np.float64)


def _pcm16(mono: np.ndarray) -> np.ndarray:
    """Values to store: the inverse of reading, so PCM16 that is only decoded comes back bit for bit."""
    scaled = np.rint(np.nan_to_num(mono, nan=0.0) * mono.dtype.type(V.PCM16_READ_SCALE))
    return np.clip(scaled, -V.PCM16_READ_SCALE, V.PCM16_READ_SCALE - 1).astype(np.int16)


def _pcm16_at_rate(mono: np.ndarray, rate: int, target: int) -> np.ndarray:
    """`_pcm16` of `_at_rate`, without either as a whole in double precision."""
    return _pcm16(mono) if rate == target else _resampled(mono, rate, target, np.int16, _pcm16)


def _each(payloads: pa.Array, read) -> list:
    """`read` over every payload; None for a missing or unreadable one, one log line a batch."""
    rows, failed = [], None
    for payload in payloads:
        try:
            rows.append(read(payload.as_py()) if payload.is_valid else None)
        except Exception as error:  # any damage in the file: the row goes on without audio
            rows.append(None)
            failed = error
    if failed is not None:
        _LOG.info("unreadable audio payloads in this batch, the last: %s", failed)
    return rows


def decode(payload: Column) -> Column:
    """WAV bytes -> struct of interleaved samples, channels and rate; NULL if unreadable. [A2]"""

    @F.arrow_udf(DECODED_AUDIO)
    def run(payloads: pa.Array) -> pa.Array:
        rows = _each(payloads, _read_wav)
        parts = [[None if r is None else r[i] for r in rows] for i in range(3)]
        kinds = (pa.list_(pa.float32()), pa.int32(), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(part, kind) for part, kind in zip(parts, kinds)],
            names=DECODED_AUDIO.names,
            mask=pa.array([r is None for r in rows], pa.bool_()),
        )

    return run(payload)


def waveform(payload: Column, target: int = V.TARGET_RATE) -> Column:
    """WAV bytes -> mono samples at the target rate; NULL if unreadable. [A6]"""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(payloads: pa.Array) -> pa.Array:
        def one(raw: bytes) -> np.ndarray:
            samples, channels, rate = _read_wav(raw)
            return _at_rate(_mono(samples, channels), rate, target).astype(np.float64)

        return pa.array(_each(payloads, one), pa.list_(pa.float64()))

    return run(payload)


def encode(pcm: Column, rate: Column, channels: int = 1) -> Column:
    """PCM16 values (interleaved) -> WAV bytes."""

    @F.arrow_udf(T.BinaryType())
    def run(values: pa.Array, rates: pa.Array) -> pa.Array:
        return pa.array(
            [
                _write_wav(v.values.to_numpy(zero_copy_only=False), r, channels) if v.is_valid else None
                for v, r in zip(values, rates.to_pylist())
            ],
            pa.binary(),
        )

    return run(pcm, rate)


def resample(samples: Column, rate: Column, target: int = V.TARGET_RATE) -> Column:
    """`functions.audio.resample` for recorded audio. [A4]"""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(waves: pa.Array, rates: pa.Array) -> pa.Array:
        rows = []
        for mono, r in zip(_waves(waves), rates.to_pylist()):
            try:
                rows.append(_at_rate(mono, r, target).astype(np.float64))
            except Exception:  # no samples, no usable rate: the row goes on without audio
                rows.append(None)
        return pa.array(rows, pa.list_(pa.float64()))

    return run(samples, rate)


def file_uri(path: str, root: str | None = None) -> str:
    """A path as a URI or absolute path; `root` is put before relative ones."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if root and not path.startswith("/") and "://" not in path:
        return file_uri(f"{root.rstrip('/')}/{path}", None)
    return path


def _fetch(path: str, root: str | None) -> bytes:
    """The content of the file that a cell names. A store that fails raises OSError."""
    store, name = fs.FileSystem.from_uri(file_uri(path, root))
    with store.open_input_stream(name) as stream:
        return stream.read()


def _samples(cell: dict, samples: np.ndarray | None, target: int, root: str | None):
    """(samples, channels, rate) of the form that counts, see `functions.audio.audio_form`; None for none."""
    if samples is not None and cell["sampling_rate"] is not None:
        return samples, 1, cell["sampling_rate"]
    if cell["bytes"] is not None:
        return _read_wav(cell["bytes"])
    if cell["path"]:
        return _read_wav(_fetch(cell["path"], root))
    return None if samples is None else (samples, 1, target)


def process(cell: Column, target: int = V.TARGET_RATE, root: str | None = None) -> Column:
    """An audio cell -> (WAV bytes at the target rate, size in samples). [A1-A5, A7, A8]

    A cell that has only a path is read from there, one file at a time, when its row is processed; the
    path names its file system, or is local, or is below `root` if it is relative. A row that fails is
    kept, with empty bytes and size 0, and so is one whose file does not exist. A store that cannot be
    reached is an error, so that Spark tries again. Results leave in batches of bounded size.
    """

    @F.arrow_udf(PROCESSED_AUDIO)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def made(audio: list, sizes: list) -> pa.Array:
            return pa.StructArray.from_arrays(
                [pa.array(audio, pa.binary()), pa.array(sizes, pa.int64())], names=PROCESSED_AUDIO.names
            )

        for cells in batches:
            fields = {f.name: pc.struct_field(cells, f.name) for f in AUDIO_CELL.fields}
            audio, sizes, held, failed = [], [], 0, None
            for i, samples in enumerate(_waves(fields["array"])):
                data, size = b"", 0
                try:
                    given = {name: fields[name][i].as_py() for name in ("sampling_rate", "bytes", "path")}
                    found = _samples(given, samples, target, root)
                    if found is not None:
                        pcm = _pcm16_at_rate(_mono(*found[:2]), found[2], target)
                        data, size = _write_wav(pcm, target), pcm.size
                except OSError as error:
                    if not isinstance(error, FileNotFoundError):
                        raise
                    failed = error
                except Exception as error:  # whatever is wrong with the audio: the row goes on without it
                    failed = error
                audio.append(data)
                sizes.append(size)
                held += len(data)
                if held >= _BATCH_BYTES:
                    yield made(audio, sizes)
                    audio, sizes, held = [], [], 0
            if failed is not None:
                _LOG.info("audio that cannot be processed in this batch, the last: %s", failed)
            if audio or not len(cells):
                yield made(audio, sizes)

    return run(cell)


def at_one_rate(cell: Column, target: int = V.TARGET_RATE) -> Column:
    """An audio cell of any form -> a cell with mono samples at the target rate. [A12]

    Samples without a rate are at the target already. A cell with a path alone, or with bytes that
    cannot be read, stays as it is.
    """
    kind = T.StructType(
        [T.StructField("array", T.ArrayType(T.DoubleType())), *(f for f in AUDIO_CELL.fields if f.name != "array")]
    )

    @F.arrow_udf(kind)
    def run(cells: pa.Array) -> pa.Array:
        arrays, rates, payloads, paths = (pc.struct_field(cells, f.name) for f in AUDIO_CELL.fields)
        sampled = pc.and_(arrays.is_valid(), pc.or_(rates.is_valid(), payloads.is_null()))
        encoded = _each(pc.if_else(sampled, pa.scalar(None, payloads.type), payloads), _read_wav)
        waves = []
        for samples, rate, read, own in zip(_waves(arrays), rates.to_pylist(), encoded, sampled.to_pylist()):
            try:
                if read is not None:
                    waves.append(_at_rate(_mono(*read[:2]), read[2], target).astype(np.float64))
                elif own:
                    waves.append(_at_rate(samples, target if rate is None else rate, target).astype(np.float64))
                else:
                    waves.append(None)
            except Exception:
                waves.append(None)
        made = pa.array(waves, pa.list_(pa.float64()))
        return pa.StructArray.from_arrays(
            [
                made,
                pc.if_else(made.is_valid(), pa.scalar(target, pa.int32()), pa.scalar(None, pa.int32())),
                pc.if_else(made.is_valid(), pa.scalar(None, payloads.type), payloads),
                paths,
            ],
            names=kind.names,
        )

    return run(cell)


@F.arrow_udf(T.ArrayType(T.ByteType()))
def bytes_to_int8(payload: pa.Array) -> pa.Array:
    """Bytes as signed 8-bit values, two's complement. [A9]"""
    return pa.array(
        [np.frombuffer(p.as_py(), np.int8) if p.is_valid else None for p in payload],
        pa.list_(pa.int8()),
    )


@F.arrow_udf(T.BinaryType())
def int8_to_bytes(values: pa.Array) -> pa.Array:
    """The inverse of `bytes_to_int8`. [A10]"""
    return pa.array(
        [
            v.values.to_numpy(zero_copy_only=False).astype(np.int8).tobytes() if v.is_valid else None
            for v in values
        ],
        pa.binary(),
    )

