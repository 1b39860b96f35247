"""Table layouts shared by all jobs."""

from pyspark.sql import types as T

SAMPLE_RATE = 16_000

TEXT = T.StringType()

AUDIO = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", TEXT)])

UTTERANCE = T.StructType(
    [
        T.StructField("text", TEXT),
        T.StructField("audio_bytes", T.BinaryType()),
        T.StructField("language", TEXT),
        T.StructField("split", TEXT),
        T.StructField("corpus", TEXT),
        T.StructField("audio_size", T.LongType()),
    ]
)
LAKE_COLUMNS = UTTERANCE.fieldNames()
CLIP_KEY = "clip_key"  # kept beside the clips that jobs land: names a clip in its source, so no rerun lands it twice
LAKE_PARTITIONS = ["corpus", "split", "language"]

CLIP = T.StructType(
    [
        T.StructField("transcription", TEXT),
        T.StructField("language", TEXT),
        T.StructField("split", TEXT),
        T.StructField("audio", AUDIO),
    ]
)

MANIFEST_LINE = T.StructType(
    [
        T.StructField("audio_filepath", TEXT),
        T.StructField("transcription", TEXT),
        T.StructField("locale", TEXT),
        T.StructField("_corrupt", TEXT),
    ]
)

ARCHIVE_MEMBER = T.StructType(
    [
        T.StructField("path", TEXT),
        T.StructField("member", TEXT),
        T.StructField("raw", T.BinaryType()),
        T.StructField("archive_error", TEXT),
    ]
)

LANGUAGE_STATS = T.StructType(
    [
        T.StructField("corpus", TEXT),
        T.StructField("language", TEXT),
        T.StructField("hours", T.DoubleType()),
    ]
)

SUBMISSION = T.StructType(
    [
        T.StructField("id", TEXT),
        T.StructField("language", TEXT),
        T.StructField("transcription", TEXT),
    ]
)
