"""Tables derived from the given ones, once in Spark and once in SQL.

The given tables hold no recordings, so documents stand in for transcripts and embeddings
for short waveforms. Every row of both is used.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sonoloom.functions import audio, payload
from sonoloom.schema import AUDIO_CELL
from sonoloom.sources import sink


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(key: str = "doc_id"):
    turn = F.floor(F.col(key) / 20) % 10
    return F.when(turn == 0, "test").when(turn == 1, "validation").otherwise("train")


SPLIT_SQL = """CASE doc_id // 20 % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END"""


#: Ids of rows that are added to the documents start here.
ADDED = 1_000_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents."""
    return table(spark, sf_dir, "documents")


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with spoken annotations, and more rows that hold nothing else or only digits."""
    doc, turn = F.col("doc_id"), F.floor(F.col("doc_id") / 20)
    transcript = F.when(doc >= ADDED, F.col("text")).when(
        doc % 3 == 0, F.concat("text", F.lit(" {side} <pause> --</pause>"))
    )
    transcript = transcript.otherwise(F.col("text"))
    rows = documents(spark, sf_dir)
    bare = F.when(turn % 7 == 3, "{only}").when(turn % 11 == 5, "12 34")
    added = rows.withColumns({"text": bare, "doc_id": doc + ADDED}).where("text is not null")
    return rows.union(added).select(
        "doc_id",
        transcript.alias("transcript"),
        F.col("lang").alias("state"),
        F.col("lang").alias("language"),
        F.col("source").alias("corpus"),
        split_of().alias("split"),
    )


ANNOTATED_SQL = f"""
spoken AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' {{side}} <pause> --</pause>' ELSE text END AS transcript,
         lang, source FROM documents
  UNION ALL
  SELECT doc_id + {ADDED}, CASE WHEN doc_id // 20 % 7 = 3 THEN '{{only}}' ELSE '12 34' END, lang, source FROM documents
  WHERE doc_id // 20 % 7 = 3 OR doc_id // 20 % 11 = 5),
annotated AS (
  SELECT doc_id, transcript, lang AS state, lang AS language, source AS corpus, {SPLIT_SQL} AS split FROM spoken)"""


def audio_cell(**fields):
    """An audio cell from the fields that are given; the others are NULL."""
    return F.struct(
        *(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIO_CELL.fields)
    )


def speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated documents, each with a waveform, at three rates; some have no audio."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    count = vectors.agg(F.max("vec_id") + 1).first()[0]  # a subquery here would be nested in those of limits
    turn = F.floor(F.col("doc_id") / 20)
    rate = F.element_at(F.array(F.lit(8000), F.lit(16000), F.lit(48000)), (F.col("doc_id") % 3 + 1).cast("int"))
    return (
        annotated(spark, sf_dir)
        .withColumn("vec_id", F.col("doc_id") % F.lit(count))
        .join(vectors, "vec_id", "left")
        .withColumn(
            "audio", audio_cell(array=F.when(turn % 9 != 4, F.col("embedding")), sampling_rate=rate)
        )
        .drop("vec_id", "embedding")
    )


SPEECH_SQL = (
    ANNOTATED_SQL
    + """,
speech AS (
  SELECT a.*, CASE a.doc_id % 3 WHEN 0 THEN 8000 WHEN 1 THEN 16000 ELSE 48000 END AS rate,
         CASE WHEN a.doc_id // 20 % 9 <> 4 THEN e.embedding END AS wave
  FROM annotated a
  LEFT JOIN embeddings e ON a.doc_id % (SELECT max(vec_id) + 1 FROM embeddings) = e.vec_id),
sized AS (
  SELECT *, CASE WHEN wave IS NULL THEN 0
                 WHEN rate = 16000 THEN len(wave)
                 ELSE CAST(trunc(len(wave) / rate * 16000) AS BIGINT) END AS audio_size
  FROM speech)"""
)


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speech rows with audio cells of all forms in one column.

    By turns: samples with a rate, mono and stereo WAV bytes, bare samples, damaged bytes, nothing, and the
    path of a WAV file, which the query writes for itself. Rows without a waveform have none in any form.
    """
    rows, kind = speech(spark, sf_dir), F.col("doc_id") % 7
    wave, rate = F.col("audio.array"), F.col("audio.sampling_rate")
    pcm = audio.quantise(wave)
    folder = sink.scratch_folder(spark)
    name, filed = sink.file_name(F.col("doc_id"), ".wav"), (kind == 6) & wave.isNotNull()
    sink.write_files(rows.where(filed), folder, name, payload.encode(pcm, rate))
    data = F.when(kind == 1, payload.encode(pcm, rate)).when(kind == 2, payload.encode(pcm, rate, 2))
    cell = audio_cell(
        array=F.when(kind.isin(0, 3), wave),
        sampling_rate=F.when(kind == 0, rate),
        bytes=data.when(kind == 4, F.encode(F.concat(F.lit("RIFF no audio "), F.col("doc_id").cast("string")), "utf-8")),
        path=F.when(filed, F.concat(F.lit(f"{folder}/"), name)),
    )
    return rows.withColumn("audio", cell)


#: What the cells of `recorded` hold once they are read: `heard`, with `wave` (mono) and `rate`.
RECORDED_SQL = (
    SPEECH_SQL
    + """,
read_back AS (
  SELECT * REPLACE (CASE doc_id % 7 WHEN 3 THEN 16000 ELSE rate END AS rate),
    list_transform(wave, lambda x: CAST(CAST(trunc(greatest(-1::FLOAT, least(1::FLOAT, x)) * 32767::FLOAT) AS INTEGER) / 32768 AS FLOAT)) AS stored
  FROM speech),
heard AS (
  SELECT * REPLACE (CASE WHEN doc_id % 7 IN (0, 3) THEN wave WHEN doc_id % 7 IN (1, 6) THEN stored
    WHEN doc_id % 7 = 2 THEN list_transform(range(len(stored) // 2),
      lambda i: CAST(CAST(stored[2 * i + 1] + stored[2 * i + 2] AS FLOAT) / 2 AS FLOAT)) END AS wave)
  FROM read_back)"""
)


def wav_sql(source: str) -> str:
    """CTE text: `wavs`(doc_id, audio_size, audio_bytes in hex), the WAV file of every waveform of `source` at 16 kHz."""

    def little(value: str, size: int) -> str:
        return " || ".join(f"printf('%02X', ({value}) // {256 ** i} % 256)" for i in range(size))

    header = (
        f"hex('RIFF') || {little('36 + 2 * n', 4)} || hex('WAVEfmt ') || '10000000' || '01000100' || {little('16000', 4)}"
        f" || {little('32000', 4)} || '02001000' || hex('data') || {little('2 * n', 4)}"
    )
    return f"""{resampled_sql(source, "doc_id", "wave", "rate")},
quantised AS (
  SELECT key, pos, CASE WHEN rate = 16000
           THEN CAST(greatest(-32768, least(32767, round_even(CAST(value AS FLOAT) * 32768::DOUBLE, 0))) AS INTEGER)
           ELSE CAST(greatest(-32768, least(32767, round_even(value * 32768::DOUBLE, 0))) AS INTEGER) END AS v
  FROM points),
packed AS (
  SELECT key, count(*) AS n, string_agg(printf('%02X%02X', (v + 65536) % 256, (v + 65536) // 256 % 256), '' ORDER BY pos) AS pcm
  FROM quantised GROUP BY key),
wavs AS (SELECT key AS doc_id, n AS audio_size, {header} || pcm AS audio_bytes FROM packed)"""


def resampled_sql(source: str, key: str, wave: str, rate: str) -> str:
    """CTE text: `points`(key, pos, value), the waveform of every row brought to 16 kHz."""
    return f"""
measured AS (
  SELECT {key} AS key, {wave} AS w, {rate} AS rate, len({wave}) AS m,
         CASE WHEN {rate} = 16000 THEN len({wave})
              ELSE CAST(trunc(len({wave}) / {rate} * 16000) AS BIGINT) END AS n
  FROM {source} WHERE {wave} IS NOT NULL),
positions AS (
  SELECT *, unnest(range(n)) AS pos,
         CASE WHEN n > 1 THEN (m - 1) / (n - 1) ELSE 0.0::DOUBLE END AS step FROM measured),
placed AS (
  SELECT *, pos * step AS x, CAST(floor(pos * step) AS BIGINT) AS j FROM positions),
points AS (
  SELECT key, pos, rate,
         CASE WHEN rate = 16000 THEN CAST(w[pos + 1] AS DOUBLE)
              WHEN pos = n - 1 AND n > 1 THEN CAST(w[m] AS DOUBLE)
              ELSE CAST(w[j + 1] AS DOUBLE)
                   + (x - j) * (CAST(w[least(j + 1, m - 1) + 1] AS DOUBLE) - CAST(w[j + 1] AS DOUBLE))
         END AS value
  FROM placed)"""
