"""Schemas of the raw table, the audio cell and the prepared corpus."""

from pyspark.sql import types as T

# An audio cell in any of its forms: samples with a rate, encoded bytes, a file path, or
# bare samples that are at the target rate already.
AUDIO_CELL = T.StructType(
    [
        T.StructField("array", T.ArrayType(T.FloatType())),
        T.StructField("sampling_rate", T.IntegerType()),
        T.StructField("bytes", T.BinaryType()),
        T.StructField("path", T.StringType()),
    ]
)

# A raw transcript table as it is landed.
RAW_TRANSCRIPTS = T.StructType(
    [
        T.StructField(
            "audio",
            T.StructType(
                [T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())]
            ),
        ),
        T.StructField("language", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("referenceImage", T.StringType()),
    ]
)

# The prepared corpus.
TARGET = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("audio_bytes", T.BinaryType()),
        T.StructField("audio_size", T.LongType()),
        T.StructField("corpus", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

# Directory levels of the stored corpus, outermost first.
PARTITIONS = ("version", "corpus", "split", "language")

# The name of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# The prepared corpus as read back: partition values stay text, so corpus=123 is '123'.
STORED = T.StructType(TARGET.fields + [T.StructField("version", T.IntegerType())])

PROCESSED_AUDIO = T.StructType(
    [T.StructField("audio_bytes", T.BinaryType()), T.StructField("audio_size", T.LongType())]
)
DECODED_AUDIO = T.StructType(
    [
        T.StructField("samples", T.ArrayType(T.FloatType())),
        T.StructField("channels", T.IntegerType()),
        T.StructField("rate", T.IntegerType()),
    ]
)
