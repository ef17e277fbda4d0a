"""Waveform functions, Column -> Column, as plain Spark expressions.

These define the results. Spark interprets array lambdas element by element, so for
recorded audio use `sonoloom.functions.payload`, which computes the same values with
numpy inside Arrow batches; the tests hold the two to equality.
"""

from pyspark.sql import Column, functions as F

from sonoloom import fixed_values as V


def _column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once.

    A lambda evaluates the columns it mentions anew for every element; for a computed
    waveform that would be quadratic work. Passed in as an element, the value is at hand.
    """
    return F.get(F.transform(F.array(value), body), 0)


def audio_form(cell: Column) -> Column:
    """Which form of an audio cell is used: 'array', 'bytes', 'path', 'bare', or NULL for none. [A1]

    Samples with a rate come first, then encoded bytes, then a path, then bare samples.
    """
    has = lambda field: cell[field].isNotNull()
    return (
        F.when(has("array") & has("sampling_rate"), "array")
        .when(has("bytes"), "bytes")
        .when(F.length(cell["path"]) > 0, "path")
        .when(has("array"), "bare")
    )


def downmix(frames: Column) -> Column:
    """Mean over the channels of every frame, in single precision. [A3]"""
    zero = F.lit(0).cast("float")
    return F.transform(
        frames,
        lambda frame: F.try_divide(F.aggregate(frame, zero, lambda a, x: a + x), F.size(frame)).cast(
            "float"
        ),
    )


def deinterleave(samples: Column, channels: Column | int) -> Column:
    """Interleaved samples as frames of `channels` values."""
    channels = _column(channels)

    def frames(s: Column) -> Column:
        count = F.floor(F.size(s) / channels).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
            lambda i: F.slice(s, i * channels + 1, channels),
        )
        return F.when(count > 0, cut).when(count == 0, F.array().cast("array<array<float>>"))

    return _bound(samples, frames)


def resampled_size(size: Column, rate: Column | int, target: int = V.TARGET_RATE) -> Column:
    """Number of samples after resampling; unchanged when the rate matches already. [A5]"""
    rate = _column(rate)
    return F.when(rate == target, size).otherwise(F.floor(F.try_divide(size, rate) * target)).cast("bigint")


def resample(wave: Column, rate: Column | int, target: int = V.TARGET_RATE) -> Column:
    """Linear interpolation between the same end points, in double precision. [A4]

    Samples already at the target rate pass through. Otherwise a waveform without samples,
    or without a positive rate, has nothing to interpolate and gives NULL.
    """
    rate = _column(rate)
    count = resampled_size(F.size(wave), rate, target).cast("int")
    frame = F.struct(
        wave.alias("wave"),
        (F.size(wave) - 1).alias("last"),
        count.alias("count"),
        F.coalesce(F.try_divide(F.size(wave) - 1, count - 1), F.lit(0.0)).alias("step"),
    )

    def interpolated(f: Column) -> Column:
        at = lambda j: F.get(f["wave"], j).cast("double")

        def sample(i: Column) -> Column:
            position = i * f["step"]
            left = F.floor(position).cast("int")
            between = at(left) + (position - left) * (at(F.least(left + 1, f["last"])) - at(left))
            return F.when((i == f["count"] - 1) & (i > 0), at(f["last"])).otherwise(between)

        points = F.transform(F.sequence(F.lit(0), F.greatest(f["count"] - 1, F.lit(0))), sample)
        return F.when(f["count"] > 0, points).otherwise(F.array().cast("array<double>"))

    return F.when(rate == target, wave.cast("array<double>")).when(
        (F.size(wave) > 0) & (rate > 0), _bound(frame, interpolated)
    )


def quantise(wave: Column) -> Column:
    """PCM16 values: clip to [-1, 1], scale, truncate; the precision is that of the samples. [A7]"""
    return F.transform(
        wave,
        lambda x: F.when(F.isnan(x), 0)
        .when(x >= 1, V.PCM16_WRITE_SCALE)
        .when(x <= -1, -V.PCM16_WRITE_SCALE)
        .otherwise(x * F.lit(V.PCM16_WRITE_SCALE).cast("float"))
        .cast("smallint"),
    )


def duration_seconds(audio_size: Column, rate: int = V.TARGET_RATE) -> Column:
    """Length of a processed row in seconds. [P4]"""
    return audio_size / rate


def or_empty_audio(payload: Column, size: Column) -> tuple[Column, Column]:
    """Rows whose audio failed stay, with an empty payload of size 0. [A8]"""
    return F.coalesce(payload, F.lit(b"")), F.coalesce(size, F.lit(0)).cast("bigint")
