"""Waveform and payload functions over all vectors."""

from pyspark.sql import functions as F

from catalogue.stand_ins import SPEECH_SQL, audio_cell, documents, resampled_sql, speech, table
from sonoloom.functions import audio, payload
from sonoloom.operators import tables

STEREO_RATE = 8000


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def _points(df, key, wave):
    return df.select(key, F.posexplode_outer(wave).alias("pos", "value"))


def _recordings(spark, sf_dir):
    """Vectors as stereo WAV files at 8 kHz; every tenth is damaged."""
    pcm = audio.quantise(F.col("embedding"))
    wav = payload.encode(pcm, F.lit(STEREO_RATE), channels=2)
    damaged = F.encode(F.concat(F.lit("not audio "), F.col("vec_id").cast("string")), "utf-8")
    return vectors(spark, sf_dir).select(
        "vec_id", F.when(F.col("vec_id") % 10 == 9, damaged).otherwise(wav).alias("wav")
    )


_PCM_SQL = "CAST(trunc(greatest(-1::FLOAT, least(1::FLOAT, {x})) * 32767::FLOAT) AS INTEGER)"

_READ_SQL = f"""
decoded AS (
  SELECT vec_id, list_transform(embedding,
           lambda x: CAST({_PCM_SQL.format(x="x")} / 32768 AS FLOAT)) AS samples
  FROM embeddings WHERE vec_id % 10 <> 9)"""

_MONO_SQL = """
mono AS (
  SELECT vec_id, list_transform(range(len({s}) // 2),
           lambda i: CAST(CAST({s}[2 * i + 1] + {s}[2 * i + 2] AS FLOAT) / 2 AS FLOAT)) AS wave
  FROM {source})"""


def _decoded(spark, sf_dir):
    read = _recordings(spark, sf_dir).select("vec_id", payload.decode(F.col("wav")).alias("d"))
    return read.select(
        "vec_id",
        F.col("d.channels").alias("channels"),
        F.col("d.rate").alias("rate"),
        F.posexplode_outer("d.samples").alias("pos", "sample"),
    )


def _forms(spark, sf_dir):
    kind = F.col("vec_id") % 7
    wave = F.when(kind.isin(0, 1, 2, 3), F.col("embedding"))
    cell = audio_cell(
        array=wave,
        sampling_rate=F.when(kind.isin(0, 1), 16000),
        bytes=F.when(kind.isin(1, 2, 4), F.lit(b"x")),
        path=F.when(kind.isin(2, 4, 5), "a.wav").when(kind == 6, ""),
    )
    return vectors(spark, sf_dir).select("vec_id", audio.audio_form(cell).alias("form"))


def _speech_sizes(spark, sf_dir):
    cell = F.col("audio")
    size = audio.resampled_size(F.size(cell["array"]), cell["sampling_rate"])
    return speech(spark, sf_dir).select("doc_id", size.alias("audio_size"))


def _fallback(spark, sf_dir):
    read = payload.decode(F.col("wav"))
    data, size = audio.or_empty_audio(
        F.when(read.isNotNull(), F.col("wav")), F.size(read["samples"])
    )
    return _recordings(spark, sf_dir).select(
        "vec_id", F.length(data).cast("bigint").alias("n_bytes"), size.alias("audio_size")
    )


def _text_bytes(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.encode("text", "utf-8").alias("payload"))


def _int8(spark, sf_dir):
    values = _text_bytes(spark, sf_dir).select("doc_id", payload.bytes_to_int8(F.col("payload")).alias("v"))
    total = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x)
    least = F.array_min("v").cast("int")
    return values.select(
        "doc_id", F.size("v").cast("bigint").alias("n"), total.alias("total"), least.alias("least")
    )


def _int8_back(spark, sf_dir):
    back = payload.int8_to_bytes(payload.bytes_to_int8(F.col("payload")))
    return _text_bytes(spark, sf_dir).select("doc_id", F.md5(back).alias("digest"))


def _processed(spark, sf_dir):
    pcm = F.lower(F.hex(F.substring("audio_bytes", 45, 2**31 - 1)))  # behind the WAV header
    return tables.process_audio(speech(spark, sf_dir)).select("doc_id", "audio_size", pcm.alias("pcm"))


_PROCESSED_SQL = f"""
WITH {SPEECH_SQL}, {resampled_sql("speech", "doc_id", "wave", "rate")},
quantised AS (
  SELECT key, pos, CASE WHEN rate = 16000
           THEN CAST(greatest(-32768, least(32767, round_even(CAST(value AS FLOAT) * 32768::DOUBLE, 0))) AS INTEGER)
           ELSE CAST(greatest(-32768, least(32767, round_even(value * 32768::DOUBLE, 0))) AS INTEGER) END AS v
  FROM points),
packed AS (
  SELECT key, string_agg(lower(printf('%02X%02X', (v + 65536) % 256, (v + 65536) // 256 % 256)), '' ORDER BY pos) AS pcm
  FROM quantised GROUP BY key)
SELECT doc_id, audio_size, coalesce(pcm, '') AS pcm FROM sized LEFT JOIN packed ON doc_id = key"""


QUERIES = {
    "audio_resolve": (
        _forms,
        "SELECT vec_id, CASE vec_id % 7 WHEN 0 THEN 'array' WHEN 1 THEN 'array' WHEN 2 THEN 'bytes'"
        " WHEN 3 THEN 'bare' WHEN 4 THEN 'bytes' WHEN 5 THEN 'path' END AS form FROM embeddings",
    ),
    "decode_wav": (
        _decoded,
        f"""WITH {_READ_SQL}
SELECT vec_id, 2 AS channels, {STEREO_RATE} AS rate, CAST(unnest(range(len(samples))) AS INTEGER) AS pos,
       unnest(samples) AS sample FROM decoded
UNION ALL SELECT vec_id, NULL, NULL, NULL, NULL FROM embeddings WHERE vec_id % 10 = 9""",
    ),
    "downmix": (
        lambda spark, sf_dir: _points(
            vectors(spark, sf_dir), "vec_id", audio.downmix(audio.deinterleave(F.col("embedding"), 2))
        ),
        f"""WITH {_MONO_SQL.format(s="embedding", source="embeddings")}
SELECT vec_id, CAST(unnest(range(len(wave))) AS INTEGER) AS pos, unnest(wave) AS value FROM mono""",
    ),
    "resample_8k": (
        lambda spark, sf_dir: _points(
            vectors(spark, sf_dir), "vec_id", audio.resample(F.col("embedding"), 8000)
        ),
        f"WITH {resampled_sql('embeddings', 'vec_id', 'embedding', '8000')}"
        " SELECT key AS vec_id, CAST(pos AS INTEGER) AS pos, value FROM points",
    ),
    "resample_48k": (
        lambda spark, sf_dir: _points(
            vectors(spark, sf_dir), "vec_id", payload.resample(F.col("embedding"), F.lit(48000))
        ),
        f"WITH {resampled_sql('embeddings', 'vec_id', 'embedding', '48000')}"
        " SELECT key AS vec_id, CAST(pos AS INTEGER) AS pos, value FROM points",
    ),
    "audio_size": (
        _speech_sizes,
        f"WITH {SPEECH_SQL} SELECT doc_id, CASE WHEN wave IS NOT NULL THEN audio_size END AS audio_size FROM sized",
    ),
    "bytes_to_waveform": (
        lambda spark, sf_dir: _points(
            _recordings(spark, sf_dir), "vec_id", payload.waveform(F.col("wav"))
        ),
        f"""WITH {_READ_SQL}, {_MONO_SQL.format(s="samples", source="decoded")},
{resampled_sql("mono", "vec_id", "wave", str(STEREO_RATE))}
SELECT key AS vec_id, CAST(pos AS INTEGER) AS pos, value FROM points
UNION ALL SELECT vec_id, NULL, NULL FROM embeddings WHERE vec_id % 10 = 9""",
    ),
    "pcm16_quantise": (
        lambda spark, sf_dir: _points(
            vectors(spark, sf_dir),
            "vec_id",
            audio.quantise(F.transform("embedding", lambda x: (x * F.lit(3).cast("float")))),
        ).withColumn("value", F.col("value").cast("int")),
        f"""SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos,
unnest(list_transform(embedding, lambda x: {_PCM_SQL.format(x="(x * 3::FLOAT)")})) AS value FROM embeddings""",
    ),
    "audio_fallback": (
        _fallback,
        "SELECT vec_id, CASE WHEN vec_id % 10 = 9 THEN 0 ELSE 44 + 2 * len(embedding) END AS n_bytes,"
        " CASE WHEN vec_id % 10 = 9 THEN 0 ELSE len(embedding) END AS audio_size FROM embeddings",
    ),
    "bytes_to_int8": (
        _int8,
        """WITH bytes AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(text)), '..'),
           lambda h: CAST('0x' || h AS INTEGER)) AS b FROM documents),
signed AS (SELECT doc_id, list_transform(b, lambda v: CASE WHEN v > 127 THEN v - 256 ELSE v END) AS v FROM bytes)
SELECT doc_id, len(v) AS n, CAST(list_sum(v) AS BIGINT) AS total, list_min(v) AS least FROM signed""",
    ),
    "int8_to_bytes": (_int8_back, "SELECT doc_id, md5(text) AS digest FROM documents"),
    "process_audio": (_processed, _PROCESSED_SQL),
    "cast_audio_rate": (
        lambda spark, sf_dir: _points(
            tables.cast_audio_rate(speech(spark, sf_dir)), "doc_id", F.col("audio.array")
        ),
        f"WITH {SPEECH_SQL}, {resampled_sql('speech', 'doc_id', 'wave', 'rate')}"
        " SELECT key AS doc_id, CAST(pos AS INTEGER) AS pos, value FROM points"
        " UNION ALL SELECT doc_id, NULL, NULL FROM speech WHERE wave IS NULL",
    ),
}
