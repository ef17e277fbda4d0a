import io
import math
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoloom.functions import audio, payload
from sonoloom.operators import tables
from sonoloom.schema import AUDIO_CELL


def sine(seconds=0.25, rate=16000):
    t = np.arange(int(rate * seconds)) / rate
    return (0.1 * np.sin(2 * np.pi * 440 * t)).astype(np.float32)


def wav(samples, rate=16000, width=2, channels=1):
    """Encoded sample by sample, apart from the library's own writer."""
    out = io.BytesIO()
    with wave.open(out, "wb") as sink:
        sink.setnchannels(channels)
        sink.setsampwidth(width)
        sink.setframerate(rate)
        top = 2 ** (8 * width - 1) - 1
        for s in samples:
            value = int(float(s) * top) + (128 if width == 1 else 0)
            sink.writeframes(value.to_bytes(width, "little", signed=width > 1))
    return out.getvalue()


def table(spark, **columns):
    names, types = zip(*(k.split("__") for k in columns))
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))
    return spark.createDataFrame(list(zip(*columns.values())), schema)


def one(df, column):
    return df.select(column.alias("o")).first().o


def test_all_forms_of_an_audio_cell(spark):
    samples = sine(0.2)
    floats = [float(x) for x in samples]
    cells = [
        (floats, 16000, None, None),
        (None, None, wav(samples), None),
        (None, None, wav(samples), "unused.wav"),
        (floats, None, None, None),
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, audio " + AUDIO_CELL.simpleString())
    rows = sorted(tables.process_audio(df).collect())
    assert [r.audio_size for r in rows] == [3200] * 4
    for row in rows:
        with wave.open(io.BytesIO(bytes(row.audio_bytes))) as back:
            assert (back.getnchannels(), back.getframerate(), back.getnframes()) == (1, 16000, 3200)
            values = np.frombuffer(back.readframes(3200), "<i2") / 32768
        assert np.abs(values - samples).max() < 2 / 32768


def test_audio_columns_of_other_types(spark):
    samples = sine(0.1)
    floats = [float(x) for x in samples]
    stereo = [[x, 0.0] for x in floats]
    columns = {
        "binary": wav(samples),
        "struct<bytes:binary,path:string>": (wav(samples), None),
        "array<float>": floats,
        "array<double>": floats,
        "struct<array:array<double>,sampling_rate:int>": (floats, 8000),
        "array<array<float>>": stereo,
        "struct<array:array<array<float>>,sampling_rate:int>": (stereo, 48000),
    }
    sizes = []
    for kind, value in columns.items():
        df = spark.createDataFrame([(value,), (None,)], f"audio {kind}")
        rows = sorted(tables.process_audio(df).collect(), key=lambda r: r.audio_size)
        assert rows[0].audio_size == 0 and bytes(rows[0].audio_bytes) == b""
        sizes.append(rows[1].audio_size)
    assert sizes == [1600, 1600, 1600, 1600, 3200, 1600, 533]


def test_failed_audio_is_kept_empty(spark):
    cells = [
        None,
        (None, None, None, None),
        (None, None, b"", None),
        (None, None, b"RIFFxxxxWAVEjunk", None),
        (None, None, None, "missing.wav"),
        ([], 8000, None, None),
        ([0.5], 0, None, None),
        ([], 16000, None, None),
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, audio " + AUDIO_CELL.simpleString())
    rows = sorted(tables.process_audio(df).collect())
    assert [r.audio_size for r in rows] == [0] * 8
    assert [len(r.audio_bytes) for r in rows] == [0] * 7 + [44]


@pytest.mark.parametrize("width, tolerance", [(1, 2 / 127), (2, 2 / 32767), (3, 1e-6), (4, 1e-6)])
def test_decoding_sample_widths(spark, width, tolerance):
    samples = sine(0.05)
    got = one(table(spark, w__binary=[wav(samples, width=width)]), payload.decode(F.col("w")))
    assert (got.channels, got.rate) == (1, 16000)
    assert np.abs(np.array(got.samples) - samples).max() < tolerance


def test_stereo_and_resampling_of_a_file(spark):
    left, right = sine(0.1, 8000), -0.5 * sine(0.1, 8000)
    frames = np.stack([left, right], 1).reshape(-1)
    df = table(spark, w__binary=[wav(frames, 8000, channels=2)])
    got = np.array(one(df, payload.waveform(F.col("w"))))
    assert len(got) == 1600
    decoded = np.array(one(df, payload.decode(F.col("w"))).samples, np.float32).reshape(-1, 2)
    mono = decoded.mean(axis=1)
    assert got[0] == mono[0] and got[-1] == mono[-1]
    assert np.abs(got - sine(0.1, 16000) * 0.25).max() < 0.01


def by_hand(samples, rate, target):
    """Interpolation point by point."""
    m, n = len(samples), int(len(samples) / rate * target)
    step = (m - 1) / (n - 1) if n > 1 else 0.0
    out = []
    for i in range(n):
        if n > 1 and i == n - 1:
            out.append(samples[-1])
        else:
            j = math.floor(i * step)
            out.append(samples[j] + (i * step - j) * (samples[min(j + 1, m - 1)] - samples[j]))
    return out


def test_resampling_forms_agree(spark):
    cases = []
    for rate in (8000, 11025, 16000, 22050, 44100, 48000):
        for size in (1, 2, 3, 64, 1000):
            wave_ = np.random.default_rng(size).uniform(-1, 1, size).astype(np.float32)
            cases.append((len(cases), [float(x) for x in wave_], rate))
    df = spark.createDataFrame(cases, "i int, w array<float>, r int")
    rows = df.select(
        "i",
        audio.resample(F.col("w"), F.col("r")).alias("a"),
        payload.resample(F.col("w"), F.col("r")).alias("b"),
        audio.resampled_size(F.size("w"), F.col("r")).alias("n"),
    ).collect()
    for row in rows:
        _, samples, rate = cases[row.i]
        expected = samples if rate == 16000 else by_hand(samples, rate, 16000)
        assert row.a == expected and row.b == expected and row.n == len(expected)


def test_resampling_edges(spark):
    df = spark.createDataFrame(
        [
            (0, [], 8000),
            (1, [], 16000),
            (2, [0.5], 48000),
            (3, None, 8000),
            (4, [0.5], 0),
            (5, [0.5], None),
            (6, [0.5], -8000),
        ],
        "i int, w array<float>, r int",
    )
    rows = sorted(
        df.select(
            "i",
            audio.resample(F.col("w"), F.col("r")).alias("a"),
            payload.resample(F.col("w"), F.col("r")).alias("b"),
        ).collect()
    )
    assert [r.a for r in rows] == [None, [], [], None, None, None, None]
    assert [r.b for r in rows] == [None, [], [], None, None, None, None]


def test_downmix_equals_single_precision_mean(spark):
    rng = np.random.default_rng(5)
    for channels in (1, 2, 3, 6):
        frames = rng.uniform(-1, 1, (50, channels)).astype(np.float32)
        df = spark.createDataFrame([([float(x) for x in frames.reshape(-1)],)], "w array<float>")
        got = one(df, audio.downmix(audio.deinterleave(F.col("w"), channels)))
        assert np.array_equal(np.array(got, np.float32), frames.mean(axis=1))


@pytest.mark.parametrize("channels", [1, 2, 3, 7, 8, 11])
def test_channels_of_a_file(spark, channels):
    frames = np.random.default_rng(channels).uniform(-0.9, 0.9, (200, channels))
    df = table(spark, w__binary=[wav(frames.reshape(-1), 16000, channels=channels)])
    decoded = np.array(one(df, payload.decode(F.col("w"))).samples, np.float32).reshape(-1, channels)
    assert one(df, payload.waveform(F.col("w"))) == decoded.mean(axis=1).tolist()


def test_quantise(spark):
    df = spark.createDataFrame([([0.0, 1.0, -1.0, 2.0, -2.0, 0.5, -0.5, float("nan")],)], "w array<float>")
    expected = [0, 32767, -32767, 32767, -32767, 16383, -16383, 0]
    assert one(df, audio.quantise(F.col("w"))) == expected
    rng = np.random.default_rng(6)
    samples = rng.uniform(-1.2, 1.2, 2000)
    for kind, dtype in (("float", np.float32), ("double", np.float64)):
        values = samples.astype(dtype)
        df = spark.createDataFrame([([float(x) for x in values],)], f"w array<{kind}>")
        by_numpy = (np.clip(values, -1, 1) * 32767).astype(np.int16)
        assert one(df, audio.quantise(F.col("w"))) == by_numpy.tolist()


def test_int8_round_trip(spark):
    every = bytes(range(256))
    df = spark.createDataFrame([(0, every), (1, b""), (2, None)], "i int, b binary")
    signed = payload.bytes_to_int8(F.col("b"))
    rows = sorted(df.select("i", signed.alias("v"), payload.int8_to_bytes(signed).alias("b")).collect())
    assert rows[0].v == [x - 256 if x > 127 else x for x in range(256)]
    assert [r.v for r in rows[1:]] == [[], None]
    assert [r.b if r.b is None else bytes(r.b) for r in rows] == [every, b"", None]


def test_encode_then_decode(spark):
    values = [0, 1, -1, 32767, -32768]
    df = spark.createDataFrame([(values, 8000)], "v array<smallint>, r int")
    got = one(df, payload.decode(payload.encode(F.col("v"), F.col("r"))))
    assert got.rate == 8000 and got.samples == [v / 32768 for v in values]


def test_cast_audio_rate(spark):
    cells = [([0.0, 1.0], 8000, None, None), (None, 8000, None, None)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, audio " + AUDIO_CELL.simpleString())
    rows = sorted(tables.cast_audio_rate(df).collect())
    assert rows[0].audio.sampling_rate == 16000 and len(rows[0].audio.array) == 4
    assert rows[1].audio.array is None


def test_pcm16_at_the_target_rate_passes_bit_for_bit(spark):
    values = np.random.default_rng(3).integers(-32768, 32768, 16000).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as sink:
        sink.setnchannels(1)
        sink.setsampwidth(2)
        sink.setframerate(16000)
        sink.writeframes(values.tobytes())
    row = tables.process_audio(table(spark, audio__binary=[out.getvalue()])).first()
    assert bytes(row.audio_bytes)[44:] == values.tobytes()


def float_wav(samples, rate, open_sizes=False):
    data = np.asarray(samples, "<f4").tobytes()
    size = 2**32 - 1 if open_sizes else len(data)
    head = (3).to_bytes(2, "little") + (1).to_bytes(2, "little") + rate.to_bytes(4, "little")
    head += (4 * rate).to_bytes(4, "little") + (4).to_bytes(2, "little") + (32).to_bytes(2, "little")
    body = b"WAVEfmt " + (16).to_bytes(4, "little") + head + b"data" + size.to_bytes(4, "little") + data
    return b"RIFF" + min(len(body), 2**32 - 1).to_bytes(4, "little") + body


def test_float_samples_and_open_sizes_are_read(spark):
    samples = sine(0.1)
    df = table(spark, audio__binary=[float_wav(samples, 16000), float_wav(samples, 16000, open_sizes=True)])
    for row in df.select(payload.decode(F.col("audio")).alias("o")).collect():
        assert row.o.rate == 16000 and np.array_equal(np.array(row.o.samples, np.float32), samples)


def test_any_failure_keeps_the_row(spark):
    """A damaged rate asks for more samples than can be made; other rows of the batch are processed."""
    long = float_wav(np.zeros(20_000), 1)
    rows = tables.process_audio(table(spark, i__int=[0, 1], audio__binary=[long, wav(sine())])).sort("i").collect()
    assert [(r.audio_size, len(r.audio_bytes)) for r in rows] == [(0, 0), (4000, 8044)]


def test_rate_cast_takes_every_form(spark):
    floats = [float(x) for x in sine(0.1, 8000)]
    cells = [
        (floats, 8000, None, None),
        (None, None, wav(sine(0.1, 8000), 8000), "a.wav"),
        (floats, None, None, None),
        (None, None, None, "a.wav"),
        (None, None, b"damaged", None),
        None,
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, audio " + AUDIO_CELL.simpleString())
    got = [r.audio for r in tables.cast_audio_rate(df).sort("i").collect()]
    assert [c.array and len(c.array) for c in got] == [1600, 1600, 800, None, None, None]
    assert [c.sampling_rate for c in got] == [16000] * 3 + [None] * 3
    assert got[3].path == "a.wav" and bytes(got[4].bytes) == b"damaged"


def test_long_recordings_are_resampled_in_blocks(monkeypatch):
    """A recording over the limit of damaged rates keeps its audio; blocks change no sample."""
    given = sine(seconds=1.0, rate=44100)
    whole = payload._at_rate(given, 44100, 16000)
    monkeypatch.setattr(payload, "_MOST_SAMPLES", 1000)
    assert np.array_equal(payload._at_rate(given, 44100, 16000), whole)
    for block in (1, 77, 16000):
        monkeypatch.setattr(payload, "_BLOCK_SAMPLES", block)
        assert np.array_equal(payload._at_rate(given, 44100, 16000), whole)
        assert np.array_equal(payload._pcm16_at_rate(given, 44100, 16000), payload._pcm16(whole))
    with pytest.raises(ValueError):
        payload._at_rate(given, 1, 16000)
